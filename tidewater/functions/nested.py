"""JSON, arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidewater.functions.text import ColumnOrName, _c


def json_text(c: ColumnOrName, path: str) -> Column:
    """G1: a JSON path as text; missing path or malformed JSON -> null."""
    return F.get_json_object(_c(c), path)


def inner_names(c: ColumnOrName, schema: DataType | str, array_field: str, name_path: str) -> Column:
    """Parse JSON and map each element of ``array_field`` to the nested ``name_path``.

    ``inner_names(col, schema, "types", "type.name")`` turns
    ``{"types": [{"type": {"name": "a"}}, ...]}`` into ``["a", ...]``.
    Malformed JSON -> null; missing array -> null.
    """
    parsed = F.from_json(_c(c), schema)
    parts = name_path.split(".")

    def pick(x: Column) -> Column:
        for p in parts:
            x = x.getField(p)
        return x

    return F.transform(parsed.getField(array_field), pick)


def literal_map(mapping: dict) -> Column:
    """A literal MapType column from a small, fixed dict."""
    items = []
    for k, v in mapping.items():
        items.extend([F.lit(k), F.lit(v)])
    return F.create_map(*items)


def map_lookup(c: ColumnOrName, mapping: dict) -> Column:
    """Value for the key in a fixed dict; unmatched (or null key) -> null."""
    return F.when(_c(c).isNotNull(), F.try_element_at(literal_map(mapping), _c(c)))


def map_column(df: DataFrame, col: str, mapping: dict, out: str) -> DataFrame:
    """J19 as a frame operator."""
    return df.withColumn(out, map_lookup(col, mapping))


def explode_groups(df_or_spark, mapping: dict[str, list[str]], key: str, value: str) -> DataFrame:
    """A literal ``{group: [members]}`` map as (group, member) rows.

    Built from a literal ``map<string, array<string>>`` exploded twice, all JVM side.
    """
    spark = df_or_spark if not isinstance(df_or_spark, DataFrame) else df_or_spark.sparkSession
    m = F.create_map(*[x for k, vs in mapping.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))])
    return (spark.range(1).select(F.explode(m).alias(key, "__members"))
            .select(key, F.explode("__members").alias(value)))
