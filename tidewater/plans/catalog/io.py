"""Catalogue: write/read round trips (partitioned parquet, path columns, typed delimited text).

Each query writes a copy of a driver table into a fresh folder under the session's shared
checkpoint folder (never a machine-local one when the cluster names a shared folder) and
returns a lazy read of it, so the comparison checks what the reader gives back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidewater.session import shared_dir
from tidewater.sources.readers import read_table, typed_ingest, with_path_columns
from tidewater.sources.sinks import write_table
from tidewater.plans.catalog import Tables, register
from tidewater.streaming.incremental import years_to_reprocess

LOOKBACK_AS_OF = "2001-02-15"


@register("partition_lookback", f"""
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice
           FROM orders),
yrs AS (SELECT DISTINCT year FROM o WHERE make_date(year, month, 1) BETWEEN DATE '2000-11-01' AND DATE '{LOOKBACK_AS_OF}')
SELECT year, month, CAST(count(*) AS BIGINT) AS n_pedidos, round(sum(o_totalprice), 2) AS monto
FROM o WHERE year IN (SELECT year FROM yrs) GROUP BY 1, 2
""")
def partition_lookback(spark, d):
    """Orders written partitioned by year/month with dynamic partition overwrite,
    read back, and the whole years to reprocess at a February as_of selected (the months from
    November through as_of decide which years)."""
    path = shared_dir(spark, "orders_by_month")
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                                       F.month("o_orderdate").alias("month"))
    write_table(o, path, mode="overwrite_partitions", partition_by=["year", "month"])
    back = read_table(spark, path)
    chosen = years_to_reprocess(back, LOOKBACK_AS_OF)
    return (chosen.groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("n_pedidos"), F.round(F.sum("o_totalprice"), 2).alias("monto")))


@register("path_columns", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag AS escenario FROM lineitem
""")
def path_columns(spark, d):
    """A column taken from the file path (the ``l_returnflag=`` folder) after a partitioned write."""
    path = shared_dir(spark, "lines_by_flag")
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    write_table(li, path, mode="overwrite", partition_by=["l_returnflag"])
    back = spark.read.parquet(path).drop("l_returnflag")
    out = with_path_columns(back, {"escenario": -2}, strip_prefix={"escenario": "l_returnflag="})
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "escenario")


RAW_HEADERS = ["Código Cliente", "Nombre", "Nación", "Saldo ($)", "Segmento"]


@register("typed_ingest", """
SELECT c_custkey AS codigo_cliente, c_name AS nombre, c_nationkey AS nacion, c_acctbal AS saldo_, c_mktsegment AS segmento
FROM customer
""")
def typed_ingest_q(spark, d):
    """A ``;``-separated export with raw headers read back by declared schema,
    headers cleaned (accents folded, lowercased, non-alphanumerics to ``_``)."""
    path = shared_dir(spark, "customer_export")
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    write_table(c.toDF(*RAW_HEADERS), path, fmt="csv", sep=";", compression="none")
    schema = StructType([StructField(RAW_HEADERS[0], LongType()), StructField(RAW_HEADERS[1], StringType()),
                         StructField(RAW_HEADERS[2], IntegerType()), StructField(RAW_HEADERS[3], DoubleType()),
                         StructField(RAW_HEADERS[4], StringType())])
    return typed_ingest(spark, path, schema, sep=";")


@register("csv_roundtrip", """
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS fecha FROM orders
""")
def csv_roundtrip(spark, d):
    """K8: tab-separated export with a header (no index column) read back with its schema."""
    path = shared_dir(spark, "orders_tsv")
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("fecha"))
    write_table(o, path, fmt="csv", sep="\t", compression="gzip")
    return typed_ingest(spark, path, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, fecha DATE",
                        sep="\t", clean=False)


MTD_AS_OF = "2024-01-20"


@register("month_to_date", f"""
SELECT event_id, value, CAST(ts AS DATE) AS fecha FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '{MTD_AS_OF}'
""")
def month_to_date(spark, d):
    """B2 (S4, U1, K8) through ``plans.energy.month_to_date_export``: events written as daily
    ``fecha=yyyy-MM-dd`` partitions, the days of the month through as_of read back (pruned by the
    partition predicate) and exported as tab-separated text."""
    from tidewater.plans.energy import month_to_date_export
    base = shared_dir(spark, "events_by_day")
    ev = Tables(spark, d).events.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("fecha"))
    write_table(ev, base, partition_by=["fecha"])
    out = month_to_date_export(spark, base, MTD_AS_OF, tsv_path=shared_dir(spark, "events_mtd_tsv"))
    return out.select("event_id", "value", F.col("fecha").cast("date").alias("fecha"))


@register("layer_completeness", """
SELECT DISTINCT 'lang=' || lang || '/source=' || source AS carpeta FROM documents WHERE lang = 'de'
""")
def layer_completeness_q(spark, d):
    """B10 (S12, U4) through ``plans.energy.layer_completeness``: documents written as a raw layer
    partitioned by language and source, and as a staging layer without one language; the folders
    missing from staging come from the two file listings (no file content is read)."""
    from tidewater.plans.energy import layer_completeness
    raw, staging = shared_dir(spark, "docs_raw"), shared_dir(spark, "docs_staging")
    docs = Tables(spark, d).documents.select("doc_id", "lang", "source")
    write_table(docs, raw, partition_by=["lang", "source"])
    write_table(docs.where(F.col("lang") != "de"), staging, partition_by=["lang", "source"])
    return layer_completeness(spark, raw, staging)


BUDGET_HEADERS = ["Código Proyecto", "Año", "Comentario Presupuesto", "Monto Aprobado"]


@register("budget_comments", """
SELECT p_partkey AS codigo_proyecto, p_size AS ano, p_name || ' (' || p_type || ')' AS comentario_presupuesto,
       p_retailprice AS monto_aprobado
FROM part
""")
def budget_comments_q(spark, d):
    """B27 through ``plans.finance.budget_comments``: a ``;`` sheet export with raw headers (accents,
    spaces) loaded by declared schema with cleaned column names."""
    from tidewater.plans.finance import budget_comments
    path = shared_dir(spark, "budget_export")
    p = Tables(spark, d).part.select("p_partkey", "p_size",
                                     F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(")")),
                                     "p_retailprice")
    write_table(p.toDF(*BUDGET_HEADERS), path, fmt="csv", sep=";", compression="none")
    schema = StructType([StructField(BUDGET_HEADERS[0], LongType()), StructField(BUDGET_HEADERS[1], IntegerType()),
                         StructField(BUDGET_HEADERS[2], StringType()), StructField(BUDGET_HEADERS[3], DoubleType())])
    return budget_comments(spark, path, schema)
