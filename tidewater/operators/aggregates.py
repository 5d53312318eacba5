"""Grouped aggregates, numeric sums, table profiles.

All aggregates are built-in functions, so Spark aggregates map-side before the
shuffle (partial + final); a hot group costs one row per input partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

_FUNCS = {
    "sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "mean": F.avg,
    "count": F.count, "count_distinct": F.count_distinct, "first": F.first,
    "any": F.bool_or, "all": F.bool_and, "stddev": F.stddev,
}


def _agg_expr(fn, col) -> Column:
    if isinstance(fn, str):
        if fn == "count" and col in ("*", None):
            return F.count(F.lit(1))
        return _FUNCS[fn](F.col(col) if isinstance(col, str) else col)
    return fn(F.col(col) if isinstance(col, str) else col)


def group_agg(df: DataFrame, keys: Sequence[str | Column], aggs: Mapping[str, tuple], having: Column | None = None,
              zero_sum: bool = False, drop_null_keys: bool = False) -> DataFrame:
    """``GROUP BY keys`` with named aggregates ``{out: (fn, col)}``.

    ``fn`` is a name (sum, max, min, avg, count, count_distinct, first, any, all, stddev) or a
    callable. ``count`` of ``"*"`` counts rows (A4); of a column counts non-nulls (A5).
    ``zero_sum`` turns all-null sums into 0 (pandas origin, N6); ``drop_null_keys`` drops
    null group keys first (pandas origin, N5). ``keys`` may be expressions (A11).
    """
    if drop_null_keys:
        for k in keys:
            df = df.where((F.col(k) if isinstance(k, str) else k).isNotNull())
    exprs = []
    for out, (fn, col) in aggs.items():
        e = _agg_expr(fn, col)
        if zero_sum and fn == "sum":
            e = F.coalesce(e, F.lit(0))
        exprs.append(e.alias(out))
    res = df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)
    return res.where(having) if having is not None else res


def numeric_sums(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A3: sum of every numeric column by key (pandas ``groupby().sum()``: null keys dropped, empty sums 0)."""
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in keys]
    return group_agg(df, keys, {c: ("sum", c) for c in nums}, zero_sum=True, drop_null_keys=True)


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows, non-null count, distinct-free stats.

    Numeric columns also get min, max, mean and sample standard deviation (as double).
    One pass over the data: all statistics are aggregates of a single ``agg``.
    """
    fields = df.schema.fields
    exprs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        exprs.append(F.count(c).alias(f"__nn{i}"))
        if isinstance(f.dataType, NumericType):
            d = c.cast("double")
            exprs += [F.min(d).alias(f"__mn{i}"), F.max(d).alias(f"__mx{i}"),
                      F.avg(d).alias(f"__av{i}"), F.stddev_samp(d).alias(f"__sd{i}")]
    wide = df.agg(*exprs)
    rows = []
    for i, f in enumerate(fields):
        numeric = isinstance(f.dataType, NumericType)
        nul = F.lit(None).cast("double")
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("n_rows"), F.col(f"__nn{i}").alias("n_non_null"),
            (F.col(f"__mn{i}") if numeric else nul).alias("min_value"),
            (F.col(f"__mx{i}") if numeric else nul).alias("max_value"),
            (F.col(f"__av{i}") if numeric else nul).alias("mean_value"),
            (F.col(f"__sd{i}") if numeric else nul).alias("stddev_value")))
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """D4."""
    return df.select(col).distinct()


def distinct_counts(df: DataFrame, keys: Sequence[str], values: Sequence[str], drop_null_keys: bool = False) -> DataFrame:
    """Exact numbers of different non-null ``values`` per key, one column ``n_<value>`` each.

    In two levels: rows are dealt out by key *and* value and become one per pair, so the values of a hot key are spread over all
    tasks; the pairs are then counted where they are, and one number per key and task goes on to the final sum. Several columns take one
    pass: a row becomes one pair per column. A key whose values are all null has 0."""
    if drop_null_keys:
        for k in keys:
            df = df.where(F.col(k).isNotNull())
    types = dict(df.dtypes)
    pair = [F.struct(F.lit(i).alias("c"), *[(F.col(v) if i == j else F.lit(None).cast(types[v])).alias(f"v{j}") for j, v in enumerate(values)])
            for i in range(len(values))]
    pairs = df.select(*keys, F.explode(F.array(*pair)).alias("__pair")).select(*keys, "__pair.*")
    once = pairs.distinct()
    return once.groupBy(*keys).agg(*[F.count_if((F.col("c") == i) & F.col(f"v{i}").isNotNull()).alias(f"n_{v}") for i, v in enumerate(values)])


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)
