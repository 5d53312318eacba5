"""Reshapes: attribute pivots, densified sums, roll-up rows, key batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.dates import month_spine  # noqa: F401  (T14, re-exported)
from tidewater.operators.versions import _as_list


def attribute_pivot(df: DataFrame, entity, attribute: str, value: str, attributes: Sequence[str],
                    dedup_order=None, tie_break=None) -> tuple[DataFrame, DataFrame]:
    """Rows of (entity, attribute, value) -> one column per listed attribute.

    The attribute list is fixed, so the output schema is fixed (an attribute absent from
    the data still gets its all-null column) and Spark needs no extra job to find values.
    One grouped aggregation by entity, partially aggregated:

    - without ``dedup_order``: ``max(value)`` per attribute (a repeated pair keeps the
      greatest value; the repeat is reported in the second output, N14);
    - with ``dedup_order``: the value of the first row per (entity, attribute) by
      ``dedup_order`` then ``tie_break`` (D2 then pivot, fused into one aggregation as
      ``min(struct(order, value))`` per attribute).

    Returns ``(wide, duplicate_keys)``; ``duplicate_keys`` lists (entity, attribute, n) with n > 1.
    """
    ents = _as_list(entity)
    rows = df.where(F.col(attribute).isin(list(attributes)))
    if dedup_order is None:
        wide = rows.groupBy(*ents).pivot(attribute, list(attributes)).agg(F.max(value))
    else:
        order = _as_list(dedup_order) + _as_list(tie_break)
        exprs = []
        for a in attributes:
            ranked = F.when(F.col(attribute) == F.lit(a),
                            F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
                                     F.col(value).alias("v")))
            exprs.append(F.min(ranked).getField("v").alias(a))
        wide = rows.groupBy(*ents).agg(*exprs)
    dupes = (rows.groupBy(*ents, attribute).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1))
    return wide, dupes


SMALL_VALUES = 2048          # a dimension of at most so many values ...
SMALL_BYTES = 1 << 18        # ... and bytes of them is held as one array by every task of the grid
CHUNK = 8192                 # grid rows that are made from one run of stored rows


def densify_sum(df: DataFrame, dims: Sequence[str], year_col: str, measures: Sequence[str] | str) -> DataFrame:
    """Every combination of the distinct dimension values x every year in [min, max];
    gaps get 0; measures summed (pandas ``groupby().sum()``: null keys dropped).

    The grid is never shuffled and never joined. Its rows are numbered: dimensions are digits, the year is the last one. The input is
    aggregated by all keys (null ones kept) into a written table, the one place where it is read, and every stored
    combination gets its number. The numbers are cut into chunks of ``CHUNK``; the stored rows of a chunk, and one start row
    per chunk, are sorted, and each row makes itself and the empty combinations up to the next one. Empty rows take their values from
    arrays of the distinct values, which reach the tasks as scalars of a checked size; a dimension beyond ``SMALL_VALUES`` or
    ``SMALL_BYTES`` is numbered by ``index_values`` and gives every chunk a value of its own, so it needs no array. Only sizes and
    the year range reach the driver.
    """
    from tidewater.session import written

    measures = _as_list(measures)
    keys = list(dims) + [year_col]
    spark = df.sparkSession
    once = written(df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]), "densify")
    summed = once
    for k in keys:
        summed = summed.where(F.col(k).isNotNull())
    facts = [F.min(year_col).alias("y0"), F.max(year_col).alias("y1")]
    for i, d in enumerate(dims):
        facts += [F.count_distinct(d).alias(f"n{i}"), F.max(F.octet_length(F.col(d).cast("string"))).alias(f"b{i}")]
    span = once.agg(*facts).first()
    sizes = {d: span[f"n{i}"] for i, d in enumerate(dims)}
    if span["y0"] is None or any(n == 0 for n in sizes.values()):
        empty = summed.limit(0)
        return empty.select(*keys, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])
    y0, years = int(span["y0"]), int(span["y1"]) - int(span["y0"]) + 1
    small = [d for i, d in enumerate(dims) if sizes[d] <= SMALL_VALUES and sizes[d] * (span[f"b{i}"] or 0) <= SMALL_BYTES]
    large = [d for d in dims if d not in small]
    within = years
    for d in small:
        within *= sizes[d]
    # of checked size: one row with the values of every small dimension in order
    arrays = written(once.agg(F.lit(1).alias("one"), *[F.array_sort(F.collect_set(d)).alias(d) for d in small]), "densify-values")
    indexed = {d: arrays.select(F.posexplode(d).alias("__idx", d)).withColumn("__idx", F.col("__idx").cast("bigint")) for d in small}
    indexed |= {d: written(index_values(once, d), "densify-values") for d in large}

    # the place of every stored combination: numbers of the large dimensions, and one number for the rest
    stored = summed
    for d in dims:
        values = indexed[d].withColumnRenamed("__idx", f"__i_{d}")
        stored = stored.join(F.broadcast(values) if d in small else values, d)
    at = F.lit(0).cast("bigint")
    for d in small:
        at = at * F.lit(sizes[d]) + F.col(f"__i_{d}")
    at = at * F.lit(years) + (F.col(year_col).cast("bigint") - F.lit(y0))
    numbers = [f"__i_{d}" for d in large]
    stored = stored.select(*large, *numbers, at.alias("__at"), F.struct(*[F.col(m).alias(f"m{i}") for i, m in enumerate(measures)]).alias("__sums"))
    n_chunks = -(-within // CHUNK)
    starts = _combinations(spark, large, indexed, sizes, n_chunks)
    none = F.lit(None).cast(stored.schema["__sums"].dataType)
    rows = stored.select(*large, *numbers, "__at", "__sums").union(starts.select(*large, *numbers, (F.col("__chunk") * CHUNK).alias("__at"), none.alias("__sums")))
    rows = rows.withColumn("__chunk", _div(F.col("__at"), CHUNK))
    chunk = Window.partitionBy(*numbers, "__chunk").orderBy("__at", F.col("__sums").isNull())
    end = F.least((F.col("__chunk") + 1) * CHUNK, F.lit(within).cast("bigint"))
    # a start row whose place is stored goes; it is the row behind the stored one
    one, two = (F.lead("__at", k).over(chunk) for k in (1, 2))
    runs = (rows.withColumns({"__next": F.coalesce(F.when(one == F.col("__at"), two).otherwise(one), end), "__before": F.lag("__at").over(chunk)})
            .where(F.col("__sums").isNotNull() | F.col("__before").isNull() | (F.col("__before") != F.col("__at"))))
    grid = runs.select(*large, "__at", "__sums", F.explode(F.sequence(F.col("__at"), F.col("__next") - 1)).alias("__id"))
    here = F.col("__id") == F.col("__at")
    cols, rest = {year_col: (F.lit(y0) + F.col("__id") % years).cast(dict(once.dtypes)[year_col])}, _div(F.col("__id"), years)
    for d in reversed(small):
        cols[d] = F.get(arrays.select(d).scalar(), (rest % sizes[d]).cast("int"))
        rest = _div(rest, sizes[d])
    return grid.select(*[cols[k].alias(k) if k in cols else F.col(k) for k in keys],
                       *[F.coalesce(F.when(here, F.col(f"__sums.m{i}")), F.lit(0)).alias(m) for i, m in enumerate(measures)])


def _div(a, b: int):
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _combinations(spark, large: list[str], indexed: dict[str, DataFrame], sizes: dict[str, int], n_chunks: int) -> DataFrame:
    """One row per combination of the large dimensions' values and chunk number. Values come by joins on their numbers, each of which
    stands for one of very many values."""
    total = n_chunks
    for d in large:
        total *= sizes[d]
    out, rest = spark.range(total), F.col("id")
    cols = {"__chunk": rest % n_chunks}
    rest = _div(rest, n_chunks)
    for d in reversed(large):
        cols[f"__i_{d}"] = (rest % sizes[d]).cast("bigint")
        rest = _div(rest, sizes[d])
    out = out.select(*[c.cast("bigint").alias(k) for k, c in cols.items()])
    for d in large:
        out = out.join(indexed[d].withColumnRenamed("__idx", f"__i_{d}"), f"__i_{d}")
    return out


def index_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct non-null values of ``col`` with their 0-based position in ascending order
    (``col``, ``__idx``), computed without a single-partition sort.

    The values are range-partitioned and sorted within partitions, then checkpointed to the shared
    checkpoint folder so every later pass reads the same materialised order (and survives a lost
    executor). A value's position is its offset inside its partition plus the number of values in
    earlier partitions; the running offsets are computed over one row per partition.
    """
    from tidewater.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    ordered = (df.select(F.col(col).alias("__v")).where(F.col("__v").isNotNull()).distinct()
               .repartitionByRange("__v").sortWithinPartitions("__v")).checkpoint(eager=True)
    numbered = (ordered.withColumn("__p", F.spark_partition_id())
                .withColumn("__local", F.monotonically_increasing_id() - F.shiftleft(F.col("__p").cast("long"), 33)))
    counts = numbered.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__p", (F.sum("__n").over(_unbounded_before("__p")) - F.col("__n")).alias("__off"))
    return numbered.join(offsets, "__p").select(F.col("__v").alias(col), (F.col("__off") + F.col("__local")).alias("__idx"))


def rollup_rows(df: DataFrame, key: str, mins: Sequence[str], maxs: Sequence[str], done_col: str,
                label_col: str, label: str, cleared: Sequence[str], order_by, tie_break=None) -> DataFrame:
    """Append one summary row per key to the rows themselves.

    The summary row copies the key's first row (by ``order_by``, ``tie_break``), sets
    ``label_col`` to ``label``, the ``mins`` columns to their minimum and ``maxs`` to their
    maximum over the key, clears ``cleared`` to null, and sets ``done_col`` true unless some
    row of the key is explicitly false (null does not count as unfinished). Null keys get no
    summary row. One aggregation, partially combined, then a union.
    """
    order = _as_list(order_by) + _as_list(tie_break)
    others = [c for c in df.columns if c != key]
    first = F.min(F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                           F.struct(*[F.col(c) for c in others]).alias("__row")))
    agg = (df.where(F.col(key).isNotNull()).groupBy(key).agg(
        first.alias("__first"),
        *[F.min(c).alias(f"__min_{c}") for c in mins],
        *[F.max(c).alias(f"__max_{c}") for c in maxs],
        F.bool_or(F.coalesce(F.col(done_col) == F.lit(False), F.lit(False))).alias("__open")))
    types = dict(df.dtypes)
    cols = []
    for c in df.columns:
        if c == key:
            cols.append(F.col(key))
        elif c == label_col:
            cols.append(F.lit(label).cast(types[c]).alias(c))
        elif c == done_col:
            cols.append((~F.col("__open")).alias(c))
        elif c in mins:
            cols.append(F.col(f"__min_{c}").alias(c))
        elif c in maxs:
            cols.append(F.col(f"__max_{c}").alias(c))
        elif c in cleared:
            cols.append(F.lit(None).cast(types[c]).alias(c))
        else:
            cols.append(F.col(f"__first.__row.{c}").alias(c))
    return df.unionByName(agg.select(*cols))


def key_batches(df: DataFrame, key: str, size: int = 30, label: str = "grupo",
                out: str = "claves", sep: str = ",", keep_array: bool = False) -> DataFrame:
    """Distinct keys in ascending order, numbered, cut into groups of ``size``.

    Returns (``label`` = batch number from 0, ``out`` = the keys of the batch joined by
    ``sep`` in order, ``n_keys``). Positions come from ``index_values`` (range-partitioned sort,
    checkpointed, numbered from per-partition counts: no single-partition window over the keys).
    Each group holds at most ``size`` keys, so the final ``collect_list`` is bounded.
    """
    indexed = index_values(df, key).select(F.col(key).alias("k"), F.col("__idx").alias("__i"))
    batches = indexed.groupBy(F.floor(F.col("__i") / size).alias(label)).agg(
        F.array_sort(F.collect_list("k")).alias("keys"), F.count(F.lit(1)).alias("n_keys"))
    batches = batches.withColumn(out, F.array_join(F.transform("keys", lambda x: x.cast("string")), sep))
    return batches.select(label, out, "n_keys", *(["keys"] if keep_array else []))


def _unbounded_before(order_col: str):
    # one row per input partition: this window is over a tiny table
    return Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
