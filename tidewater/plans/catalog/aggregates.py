"""Catalogue: grouped aggregates, rankings, profiles, audit rows, run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import period_number, seconds_between, truncate_to_date
from tidewater.functions.nested import map_lookup
from tidewater.functions.rules import yes_no_nonzero
from tidewater.functions.text import split_part
from tidewater.operators.aggregates import group_agg, numeric_sums, profile_table
from tidewater.operators.versions import latest_by
from tidewater.plans.catalog import AS_OF_ORDERS, Tables, register
from tidewater.sources.sinks import audit_row


@register("group_sum", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, CAST(count(*) AS BIGINT) AS n_lines
FROM lineitem GROUP BY 1, 2
""")
def group_sum(spark, d):
    """A1/A4 (B15): sum and row count by keys."""
    li = Tables(spark, d).lineitem
    out = group_agg(li, ["l_returnflag", "l_linestatus"], {"sum_qty": ("sum", "l_quantity"), "n_lines": ("count", "*")})
    return out.withColumn("sum_qty", F.round("sum_qty", 2))


@register("multi_agg", """
SELECT l_returnflag, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc,
       max(CAST(l_shipdate AS DATE)) AS last_ship, round(avg(l_quantity), 6) AS avg_qty
FROM lineitem GROUP BY 1
""")
def multi_agg(spark, d):
    """Sum, sum, max and mean together."""
    li = Tables(spark, d).lineitem
    out = group_agg(li, ["l_returnflag"], {
        "sum_base": ("sum", "l_extendedprice"),
        "sum_disc": ("sum", F.col("l_extendedprice") * (1 - F.col("l_discount"))),
        "last_ship": ("max", F.to_date("l_shipdate")),
        "avg_qty": ("avg", "l_quantity")})
    return out.select("l_returnflag", F.round("sum_base", 2).alias("sum_base"), F.round("sum_disc", 4).alias("sum_disc"),
                      "last_ship", F.round("avg_qty", 6).alias("avg_qty"))


@register("numeric_sums", """
SELECT o_orderpriority, CAST(sum(o_orderkey) AS BIGINT) AS o_orderkey, CAST(sum(o_custkey) AS BIGINT) AS o_custkey,
       round(sum(o_totalprice), 2) AS o_totalprice
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1
""")
def numeric_sums_q(spark, d):
    """A3 (B39): sum of every numeric column by key."""
    o = Tables(spark, d).orders.select("o_orderpriority", "o_orderkey", "o_custkey", "o_totalprice",
                                       "o_orderstatus", "o_orderdate")
    out = numeric_sums(o, ["o_orderpriority"])
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


@register("top_counts", """
SELECT l_suppkey, CAST(count(nullif(l_returnflag, 'N')) AS BIGINT) AS n_devoluciones
FROM lineitem GROUP BY 1 ORDER BY n_devoluciones DESC, l_suppkey LIMIT 10
""")
def top_counts(spark, d):
    """A5/O1/O2 (B40): non-null counts per key, sorted descending, top 10 (the limit is the report)."""
    li = Tables(spark, d).lineitem.select("l_suppkey", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"))
    out = group_agg(li, ["l_suppkey"], {"n_devoluciones": ("count", "flag")})
    return out.orderBy(F.desc("n_devoluciones"), F.asc("l_suppkey")).limit(10)


def _profile_sql() -> str:
    cols = [("l_orderkey", "bigint", True), ("l_partkey", "bigint", True), ("l_suppkey", "bigint", True),
            ("l_linenumber", "int", True), ("l_quantity", "double", True), ("l_extendedprice", "double", True),
            ("l_discount", "double", True), ("l_tax", "double", True), ("l_returnflag", "string", False),
            ("l_linestatus", "string", False), ("l_shipdate", "timestamp_ntz", False)]
    parts = []
    for name, typ, num in cols:
        if num:
            x = f"CAST({name} AS DOUBLE)"
            stats = (f"round(min({x}), 6) AS min_value, round(max({x}), 6) AS max_value, "
                     f"round(avg({x}), 4) AS mean_value, round(stddev_samp({x}), 2) AS stddev_value")
        else:
            stats = ("CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, "
                     "CAST(NULL AS DOUBLE) AS mean_value, CAST(NULL AS DOUBLE) AS stddev_value")
        parts.append(f"SELECT '{name}' AS column_name, '{typ}' AS data_type, CAST(count(*) AS BIGINT) AS n_rows, "
                     f"CAST(count({name}) AS BIGINT) AS n_non_null, {stats} FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("describe_stats", _profile_sql())
def describe_stats(spark, d):
    """A18/P10 (B43): one profile row per column of lineitem, computed in a single pass."""
    prof = profile_table(Tables(spark, d).lineitem)
    return prof.select("column_name", "data_type", "n_rows", "n_non_null",
                       F.round("min_value", 6).alias("min_value"), F.round("max_value", 6).alias("max_value"),
                       F.round("mean_value", 4).alias("mean_value"), F.round("stddev_value", 2).alias("stddev_value"))


@register("audit_counts", f"""
SELECT 'lineitem' AS table_name, 'analytics' AS stage, DATE '{AS_OF_ORDERS}' AS fecha, CAST(count(*) AS BIGINT) AS n_rows,
       CASE WHEN count(*) < 1 THEN 'ERROR' ELSE 'OK' END AS status,
       CASE WHEN count(*) < 1 THEN 'lineitem: no rows written' END AS error,
       max(CAST(l_shipdate AS DATE)) AS mark
FROM lineitem
""")
def audit_counts(spark, d):
    """The audit row of a write with its high-water mark, from one global aggregate."""
    li = Tables(spark, d).lineitem
    return audit_row(li, "lineitem", "analytics", AS_OF_ORDERS, mark=F.to_date("l_shipdate"))


@register("period_counts", """
SELECT CAST(year(o_orderdate) * 1000 + month(o_orderdate) AS INTEGER) AS periodo, o_orderpriority,
       CAST(count(*) AS BIGINT) AS n_pedidos, round(sum(o_totalprice), 2) AS monto
FROM orders GROUP BY 1, 2
""")
def period_counts(spark, d):
    """Group by the expression ``year * 1000 + month``."""
    o = Tables(spark, d).orders
    out = group_agg(o, [period_number("o_orderdate").alias("periodo"), "o_orderpriority"],
                    {"n_pedidos": ("count", "*"), "monto": ("sum", "o_totalprice")})
    return out.withColumn("monto", F.round("monto", 2))


@register("daily_errors", """
SELECT CAST(ts AS DATE) AS dia, round(sum(CASE WHEN event_type = 'error' THEN value ELSE 0 END), 2) AS errores,
       CAST(count(*) AS BIGINT) AS n_eventos,
       CASE WHEN sum(CASE WHEN event_type = 'error' THEN value ELSE 0 END) > 0 THEN 'Con errores' ELSE 'Sin errores' END AS estado
FROM events GROUP BY 1
""")
def daily_errors(spark, d):
    """B12 (A1, T6, C9): error sum per day and a flag from it."""
    ev = Tables(spark, d).events
    out = group_agg(ev, [truncate_to_date("ts").alias("dia")], {
        "errores": ("sum", F.when(F.col("event_type") == "error", F.col("value")).otherwise(0.0)),
        "n_eventos": ("count", "*")})
    return out.select("dia", F.round("errores", 2).alias("errores"), "n_eventos",
                      F.when(F.col("errores") > 0, "Con errores").otherwise("Sin errores").alias("estado"))


# Run states of the process log and their report symbols.
RUN_STATES = {"signup": "RUNNING", "purchase": "SUCCEEDED", "error": "FAILED", "click": "TIMED_OUT", "view": "ABORTED"}
RUN_SYMBOLS = {"SUCCEEDED": "OK", "FAILED": "ERROR", "RUNNING": "EN CURSO", "TIMED_OUT": "TIEMPO", "ABORTED": "ABORTADO"}


@register("run_monitor", """
WITH last AS (
  SELECT user_id, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),
span AS (SELECT user_id, min(ts) AS inicio, max(ts) AS fin FROM events GROUP BY user_id)
SELECT split_part('arn:proc:' || CAST(s.user_id AS VARCHAR), ':', 3) AS proceso, s.inicio, s.fin,
       round(CAST(date_diff('microsecond', s.inicio, s.fin) AS DOUBLE) / 1e6, 6) AS duracion_s,
       CASE l.event_type WHEN 'signup' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED'
            WHEN 'click' THEN 'TIMED_OUT' WHEN 'view' THEN 'ABORTED' END AS estado,
       CASE CASE l.event_type WHEN 'signup' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED'
            WHEN 'click' THEN 'TIMED_OUT' WHEN 'view' THEN 'ABORTED' END
            WHEN 'SUCCEEDED' THEN 'OK' WHEN 'FAILED' THEN 'ERROR' WHEN 'RUNNING' THEN 'EN CURSO'
            WHEN 'TIMED_OUT' THEN 'TIEMPO' WHEN 'ABORTED' THEN 'ABORTADO' END AS simbolo
FROM span s JOIN last l ON s.user_id = l.user_id
""")
def run_monitor(spark, d):
    """B11 (W3, J19, X6, T16, X4): events as a run log; per process the latest run's state and
    symbol, first start, last stop and the duration between them. Both sides are aggregations."""
    ev = Tables(spark, d).events.select("event_id", "ts", "user_id", "event_type")
    last = latest_by(ev.select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts", "event_id")
    span = ev.groupBy("user_id").agg(F.min("ts").alias("inicio"), F.max("ts").alias("fin"))
    out = span.join(last.select("user_id", "event_type"), "user_id")
    estado = map_lookup("event_type", RUN_STATES)
    return out.select(
        split_part(F.concat(F.lit("arn:proc:"), F.col("user_id").cast("string")), ":", 3).alias("proceso"),
        "inicio", "fin", F.round(seconds_between("fin", "inicio"), 6).alias("duracion_s"),
        estado.alias("estado"), map_lookup(estado, RUN_SYMBOLS).alias("simbolo"))


@register("match_outcomes", """
WITH m AS (
  SELECT c.c_mktsegment AS home_team, o.o_orderpriority AS away_team,
         CAST(floor(o.o_totalprice / 100000) AS INTEGER) AS home_score, CAST(floor(c.c_acctbal / 2000) AS INTEGER) AS away_score
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
sides AS (
  SELECT home_team AS team, CASE WHEN home_score > away_score THEN 1 ELSE 0 END AS wins,
         CASE WHEN home_score = away_score THEN 1 ELSE 0 END AS draws, home_score AS goals FROM m
  UNION ALL
  SELECT away_team, CASE WHEN away_score > home_score THEN 1 ELSE 0 END,
         CASE WHEN home_score = away_score THEN 1 ELSE 0 END, away_score FROM m)
SELECT team, CAST(sum(wins) AS BIGINT) AS wins, CAST(sum(draws) AS BIGINT) AS draws, CAST(sum(goals) AS BIGINT) AS goals,
       CAST(count(*) AS BIGINT) AS played
FROM sides GROUP BY team
""")
def match_outcomes(spark, d):
    """Each order is a match (customer segment at home, priority away); wins, draws (taken
    before filtering wins, the corrected order), goals and games per team (U1, A3)."""
    from tidewater.plans.sport import team_table
    t = Tables(spark, d)
    m = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("home_team"), F.col("o_orderpriority").alias("away_team"),
        F.floor(F.col("o_totalprice") / 100000).cast("int").alias("home_score"),
        F.floor(F.col("c_acctbal") / 2000).cast("int").alias("away_score"))
    return team_table(m)


@register("usage_label", """
WITH a AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
                  count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS n_p
           FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1)
SELECT c.c_custkey, CAST(a.n_f AS BIGINT) AS n_f, CAST(a.n_p AS BIGINT) AS n_p,
       CASE WHEN coalesce(a.n_f, 0) <> 0 OR coalesce(a.n_p, 0) <> 0 THEN 'Si' ELSE 'No' END AS uso
FROM customer c LEFT JOIN a ON c.c_custkey = a.o_custkey
""")
def usage_label(spark, d):
    """V1: 'Si' when either measure is non-zero, else 'No'; a missing measure counts as zero."""
    t = Tables(spark, d)
    hit = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    of = lambda c: F.when(F.count_if(hit) > 0, F.count_if(hit & c))  # noqa: E731  a customer without such orders has no measure
    a = t.orders.groupBy("o_custkey").agg(of(F.col("o_orderstatus") == "F").alias("n_f"),
                                          of((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")).alias("n_p"))
    out = t.customer.select("c_custkey").join(a, F.col("c_custkey") == F.col("o_custkey"), "left")
    return out.select("c_custkey", "n_f", "n_p", yes_no_nonzero("n_f", "n_p").alias("uso"))
