"""Set operations (U1-U5): tagged unions, unions with missing columns, split-and-treat, name differences."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Append by column name; with ``allow_missing`` absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def tagged_union(frames: Mapping[str, DataFrame], col: str, allow_missing: bool = False) -> DataFrame:
    """Tag each frame with its label in ``col``, then append."""
    return union_all([df.withColumn(col, F.lit(label)) for label, df in frames.items()], allow_missing)


def split_union(df: DataFrame, cond: Column, when_true: Mapping[str, Column], when_false: Mapping[str, Column]) -> DataFrame:
    """Rows where ``cond`` is true get the columns of ``when_true``, the others (null counts as false) those of
    ``when_false``; a column that only one side has is null on the other. One projection, one pass over ``df``."""
    c = F.coalesce(cond, F.lit(False))
    names = dict.fromkeys([*when_true, *when_false])
    return df.select(*[F.when(c, when_true.get(n, F.lit(None))).otherwise(when_false.get(n, F.lit(None))).alias(n) for n in names])


def name_difference(a: DataFrame, b: DataFrame, col: str, b_col: str | None = None,
                    distinct: bool = False) -> DataFrame:
    """U4: values of ``a.col`` absent from ``b`` (left anti join keeps repeats; ``distinct`` = EXCEPT)."""
    other = b.select(F.col(b_col or col).alias(col))
    out = a.join(other, col, "left_anti")
    return out.select(col).distinct() if distinct else out
