"""Catalogue: pivots, densified sums, roll-up rows, batches, spines, unions, literal tables, nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import MONTHS_ES
from tidewater.functions.nested import explode_groups, inner_names, json_text
from tidewater.functions.rules import first_rule, not_in_keep_null
from tidewater.operators.reshape import attribute_pivot, key_batches, rollup_rows
from tidewater.operators.sets import name_difference, split_union, tagged_union, union_all
from tidewater.plans.catalog import AS_OF_ORDERS, Tables, register
from tidewater.plans.employment import activity_by_month
from tidewater.plans.energy import projected_supply
from tidewater.plans.membership import CAPITAL_BRACKETS
from tidewater.sources.readers import literal_table

EVENT_ATTRIBUTES = ["click", "view", "error", "purchase", "signup", "refund"]

# Market segments of the driver tables grouped into sectors (a literal map of lists, G5).
SEGMENT_GROUPS = {"INDUSTRIA": ["MACHINERY", "AUTOMOBILE"], "HOGAR": ["HOUSEHOLD", "FURNITURE"],
                  "CONSTRUCCION": ["BUILDING"]}


@register("densify_sum", """
WITH w AS (
  SELECT o.o_orderpriority AS escenario, n.n_name AS region, c.c_mktsegment AS tecnologia,
         CAST(year(o.o_orderdate) AS INTEGER) AS ano, o.o_totalprice AS potencia,
         CASE WHEN o.o_orderstatus = 'F' THEN 'X' WHEN o.o_orderstatus = 'P' THEN 'P' END AS tipo_plp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
k AS (SELECT * FROM w WHERE tipo_plp IS DISTINCT FROM 'X'),
years AS (SELECT CAST(unnest(generate_series(min(ano), max(ano))) AS INTEGER) AS ano FROM k),
grid AS (SELECT e.escenario, r.region, t.tecnologia, y.ano
         FROM (SELECT DISTINCT escenario FROM k WHERE escenario IS NOT NULL) e
         CROSS JOIN (SELECT DISTINCT region FROM k WHERE region IS NOT NULL) r
         CROSS JOIN (SELECT DISTINCT tecnologia FROM k WHERE tecnologia IS NOT NULL) t
         CROSS JOIN years y),
s AS (SELECT escenario, region, tecnologia, ano, sum(potencia) AS potencia FROM k
      WHERE escenario IS NOT NULL AND region IS NOT NULL AND tecnologia IS NOT NULL AND ano IS NOT NULL
      GROUP BY 1, 2, 3, 4)
SELECT g.escenario, g.region, g.tecnologia, g.ano, round(coalesce(s.potencia, 0), 2) AS potencia, g.ano AS year
FROM grid g LEFT JOIN s ON g.escenario = s.escenario AND g.region = s.region AND g.tecnologia = s.tecnologia AND g.ano = s.ano
""")
def densify_sum_q(spark, d):
    """B5 (N3, A15, J13, D4): rows marked ``X`` dropped (null marks kept); every scenario x region x
    technology x year between min and max, gaps 0."""
    t = Tables(spark, d)
    works = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("o_orderpriority").alias("escenario"), F.col("n_name").alias("region"),
                     F.col("c_mktsegment").alias("tecnologia"), F.year("o_orderdate").alias("ano"),
                     F.col("o_totalprice").alias("potencia"),
                     first_rule([(F.col("o_orderstatus") == "F", "X"), (F.col("o_orderstatus") == "P", "P")],
                                F.lit(None).cast("string")).alias("tipo_plp")))
    out = projected_supply(works)
    return out.withColumn("potencia", F.round("potencia", 2))


def _pivot_sql(first: bool) -> str:
    cols = ",\n       ".join(
        f"max(CASE WHEN event_type = '{a}'{' AND rn = 1' if first else ''} THEN value END) AS {a}"
        for a in EVENT_ATTRIBUTES)
    inlist = ", ".join(f"'{a}'" for a in EVENT_ATTRIBUTES)
    src = ("(SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)"
           if first else "events")
    return (f"WITH w AS (SELECT user_id,\n       {cols}\n FROM {src} x WHERE event_type IN ({inlist}) GROUP BY user_id)\n"
            f"SELECT u.user_id, {', '.join('w.' + a for a in EVENT_ATTRIBUTES)}\n"
            f"FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN w ON u.user_id = w.user_id")


@register("attribute_pivot", _pivot_sql(False))
def attribute_pivot_q(spark, d):
    """(user, event type, value) rows to one column per listed type (``refund`` never
    occurs and still gets its column); joined back onto the distinct users."""
    ev = Tables(spark, d).events
    wide, _dupes = attribute_pivot(ev, "user_id", "event_type", "value", EVENT_ATTRIBUTES)
    return ev.select("user_id").distinct().join(wide, "user_id", "left").select("user_id", *EVENT_ATTRIBUTES)


@register("attribute_pivot_dedup", _pivot_sql(True))
def attribute_pivot_dedup_q(spark, d):
    """As ``attribute_pivot`` but each (user, type) keeps its first value by time,
    ties on event id, in the same single aggregation."""
    ev = Tables(spark, d).events
    wide, _dupes = attribute_pivot(ev, "user_id", "event_type", "value", EVENT_ATTRIBUTES,
                                   dedup_order="ts", tie_break="event_id")
    return ev.select("user_id").distinct().join(wide, "user_id", "left").select("user_id", *EVENT_ATTRIBUTES)


ROLLUP_BASE = """
WITH m AS (
  SELECT CAST(o_custkey AS VARCHAR) || '-' || substr(o_orderpriority, 1, 1) AS id_proyecto,
         CAST(o_orderkey AS VARCHAR) AS id_hito, nullif(o_orderpriority, '4-NOT SPECIFIED') AS nombre_hito,
         'lider-' || o_orderstatus AS nombre_lider_hito, o_orderstatus AS gerencia_hito,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_finalizado,
         CAST(o_orderdate AS DATE) AS fecha_planificada_inicio, CAST(o_orderdate AS DATE) + 30 AS fecha_planificada_fin,
         CAST(o_orderdate AS DATE) + 1 AS fecha_real_inicio,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 45 END AS fecha_real_fin,
         o_orderpriority AS tablero
  FROM orders),
f AS (SELECT * FROM m WHERE nombre_hito IS NULL OR nombre_hito NOT IN ('5-LOW'))
SELECT id_proyecto, id_hito, nombre_hito, nombre_lider_hito, gerencia_hito, is_finalizado, fecha_planificada_inicio,
       fecha_planificada_fin, fecha_real_inicio, fecha_real_fin, tablero FROM f
UNION ALL
SELECT id_proyecto, CAST(NULL AS VARCHAR), 'H0: Fecha Proyectos', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       NOT bool_or(coalesce(is_finalizado = false, false)), min(fecha_planificada_inicio), max(fecha_planificada_fin),
       min(fecha_real_inicio), max(fecha_real_fin), arg_min(tablero, fecha_planificada_inicio)
FROM f WHERE id_proyecto IS NOT NULL GROUP BY id_proyecto
"""


@register("rollup_rows", ROLLUP_BASE)
def rollup_rows_q(spark, d):
    """B37 (X17, F4, A16, U1): orders as project milestones; irrelevant milestone names dropped
    (nulls kept); one summary row appended per project."""
    o = Tables(spark, d).orders
    day = F.to_date("o_orderdate")
    m = o.select(
        F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("id_proyecto"),
        F.col("o_orderkey").cast("string").alias("id_hito"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("nombre_hito"),
        F.concat(F.lit("lider-"), F.col("o_orderstatus")).alias("nombre_lider_hito"),
        F.col("o_orderstatus").alias("gerencia_hito"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("is_finalizado"),
        day.alias("fecha_planificada_inicio"), F.date_add(day, 30).alias("fecha_planificada_fin"),
        F.date_add(day, 1).alias("fecha_real_inicio"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(day, 45)).alias("fecha_real_fin"),
        F.col("o_orderpriority").alias("tablero"))
    m = m.where(not_in_keep_null("nombre_hito", ["5-LOW"]))
    return rollup_rows(m, "id_proyecto", mins=["fecha_planificada_inicio", "fecha_real_inicio"],
                       maxs=["fecha_planificada_fin", "fecha_real_fin"], done_col="is_finalizado",
                       label_col="nombre_hito", label="H0: Fecha Proyectos",
                       cleared=["nombre_lider_hito", "gerencia_hito", "id_hito"],
                       order_by="fecha_planificada_inicio", tie_break="id_hito")


@register("key_batches", """
WITH k AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL),
i AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM k)
SELECT CAST(floor(i / 30) AS BIGINT) AS grupo, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS claves,
       CAST(count(*) AS BIGINT) AS n_keys
FROM i GROUP BY 1
""")
def key_batches_q(spark, d):
    """Ordering customers, distinct, ascending, numbered and cut into groups of 30."""
    return key_batches(Tables(spark, d).orders, "o_custkey", size=30, label="grupo", out="claves")


@register("activity_spine", f"""
WITH spine AS (
  SELECT CAST(year(f) AS INTEGER) AS year, CAST(month(f) AS INTEGER) AS month, CAST(f AS DATE) AS fecha,
         CAST(year(f) * 1000 + month(f) AS INTEGER) AS periodo
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS f)),
cv AS (SELECT o_custkey AS id_usuario, year(o_orderdate) * 1000 + month(o_orderdate) AS periodo, count(*) AS n
       FROM orders GROUP BY 1, 2),
inv AS (SELECT o.o_custkey AS id_usuario, year(l.l_shipdate) * 1000 + month(l.l_shipdate) AS periodo, count(*) AS n
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
lc AS (SELECT o_custkey AS id_usuario, year(o_orderdate) * 1000 + month(o_orderdate) AS periodo, count(*) AS n
       FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
lm AS (SELECT o.o_custkey AS id_usuario, year(l.l_shipdate) * 1000 + month(l.l_shipdate) AS periodo, count(*) AS n
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R' GROUP BY 1, 2),
uc AS (SELECT DISTINCT c_custkey AS id_usuario, c_name AS rut_empresa FROM customer)
SELECT s.year, s.month, s.fecha, s.periodo, cv.id_usuario, CAST(cv.n AS BIGINT) AS cvs_descargados,
       CAST(inv.n AS BIGINT) AS invitaciones, CAST(lc.n AS BIGINT) AS listas_creadas,
       CAST(lm.n AS BIGINT) AS listas_modificadas, true AS is_activo, uc.rut_empresa
FROM spine s JOIN cv ON s.periodo = cv.periodo
LEFT JOIN inv ON inv.periodo = s.periodo AND inv.id_usuario = cv.id_usuario
LEFT JOIN lc ON lc.periodo = s.periodo AND lc.id_usuario = cv.id_usuario
LEFT JOIN lm ON lm.periodo = s.periodo AND lm.id_usuario = cv.id_usuario
LEFT JOIN uc ON uc.id_usuario = cv.id_usuario
""")
def activity_spine(spark, d):
    """B17 (T14, T13, A4, A11, J4, C6): monthly spine Jan 1995 - Dec of the as_of year; orders as
    downloads, lines as invitations, finished orders as created lists, returned lines as modified lists."""
    t = Tables(spark, d)
    o = t.orders.select(F.col("o_custkey").alias("id_usuario"), F.col("o_orderdate").alias("fecha"),
                        "o_orderkey", "o_orderstatus")
    lines = t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "id_usuario", F.col("l_shipdate").alias("fecha"), "l_returnflag")
    companies = t.customer.select(F.col("c_custkey").alias("id_usuario"), F.col("c_name").alias("rut_empresa"))
    end = f"{AS_OF_ORDERS[:4]}-12-01"
    out = activity_by_month(spark, o, lines, (o, F.col("o_orderstatus") == "F"), (lines, F.col("l_returnflag") == "R"), companies, "1995-01-01", end)
    return out.select("year", "month", "fecha", "periodo", "id_usuario", "cvs_descargados", "invitaciones",
                      "listas_creadas", "listas_modificadas", "is_activo", "rut_empresa")


@register("tagged_union", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio, o_totalprice, 'base' AS escenario FROM orders
WHERE year(o_orderdate) <= 1998
UNION ALL
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio, o_totalprice, 'alto' AS escenario FROM orders
WHERE year(o_orderdate) >= 1998
""")
def tagged_union_q(spark, d):
    """Two scenarios read from the same table, each tagged, then appended."""
    o = Tables(spark, d).orders.select("o_orderkey", F.year("o_orderdate").alias("anio"), "o_totalprice")
    return tagged_union({"base": o.where(F.col("anio") <= 1998), "alto": o.where(F.col("anio") >= 1998)}, "escenario")


@register("union_missing", """
SELECT c_custkey AS id, c_name AS nombre, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS nombre, CAST(NULL AS VARCHAR) AS c_mktsegment, s_acctbal FROM supplier
""")
def union_missing(spark, d):
    """Append frames with different columns; absent columns are null."""
    t = Tables(spark, d)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), "c_mktsegment")
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"), "s_acctbal")
    return union_all([c, s], allow_missing=True)


@register("split_union", """
SELECT l_orderkey, l_linenumber, round(-l_extendedprice, 4) AS valor, 'devolucion' AS tipo, l_linestatus AS motivo
FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS valor, 'venta' AS tipo,
       CAST(NULL AS VARCHAR) AS motivo
FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R'
""")
def split_union_q(spark, d):
    """U5 (B14): split by a predicate (null counts as false), each branch with its own columns, in one pass."""
    li = Tables(spark, d).lineitem
    both = {c: F.col(c) for c in ("l_orderkey", "l_linenumber")}
    return split_union(
        li, F.col("l_returnflag") == "R",
        both | {"valor": F.round(-F.col("l_extendedprice"), 4), "tipo": F.lit("devolucion"), "motivo": F.col("l_linestatus")},
        both | {"valor": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4), "tipo": F.lit("venta")})


URL_HOST_LABEL = r"^https?://([^/.]+)"


@register("layer_diff", f"""
SELECT DISTINCT prefix FROM (SELECT regexp_extract(url, '{URL_HOST_LABEL}', 1) AS prefix FROM pages) p
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.source = p.prefix)
""")
def layer_diff(spark, d):
    """Source prefixes present in the raw layer (first host label of page URLs) and
    missing from the staging layer (document sources)."""
    t = Tables(spark, d)
    raw = t.pages.select(F.regexp_extract("url", URL_HOST_LABEL, 1).alias("prefix"))
    return name_difference(raw, t.documents, "prefix", b_col="source", distinct=True)


def _values(rows, cols, alias: str) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"


def _bracket_case(col: str) -> str:
    edges = [10, 25, 50, 100, 250, 500, 1000, 2000, 10000]
    parts, low = [], 0
    for i, e in enumerate(edges, start=1):
        parts.append(f"WHEN {col} > {low} AND {col} <= {e} THEN {i}")
        low = e
    parts.append(f"WHEN {col} > {low} THEN {len(edges) + 1}")
    return "CASE " + " ".join(parts) + " END"


@register("bracket_labels", f"""
SELECT c.c_custkey, {_bracket_case('c.c_acctbal')} AS tramo_capital_propio_positivo,
       coalesce(b.tramo_capital_propio_txt, 'Sin Información') AS tramo_capital_propio_txt, g.grupo
FROM customer c
LEFT JOIN {_values(CAPITAL_BRACKETS, ['tramo', 'tramo_capital_propio_txt'], 'b')}
  ON b.tramo = {_bracket_case('c.c_acctbal')}
LEFT JOIN {_values([(g, m) for g, ms in SEGMENT_GROUPS.items() for m in ms], ['grupo', 'segmento'], 'g')}
  ON g.segmento = c.c_mktsegment
""")
def bracket_labels(spark, d):
    """B23 (S10, G5, C1, C5): balance brackets labelled from a literal table; segments grouped by a
    literal map of lists exploded to rows."""
    t = Tables(spark, d)
    bal = F.col("c_acctbal")
    edges = [10, 25, 50, 100, 250, 500, 1000, 2000, 10000]
    rules, low = [], 0
    for i, e in enumerate(edges, start=1):
        rules.append(((bal > low) & (bal <= e), i))
        low = e
    rules.append((bal > low, len(edges) + 1))
    c = t.customer.select("c_custkey", "c_mktsegment", first_rule(rules, F.lit(None).cast("int")).alias("tramo_capital_propio_positivo"))
    labels = literal_table(spark, CAPITAL_BRACKETS, "tramo int, tramo_capital_propio_txt string")
    groups = explode_groups(spark, SEGMENT_GROUPS, "grupo", "segmento")
    out = (c.join(labels, c["tramo_capital_propio_positivo"] == labels["tramo"], "left")
           .join(groups, F.col("segmento") == F.col("c_mktsegment"), "left"))
    return out.select("c_custkey", "tramo_capital_propio_positivo",
                      F.coalesce("tramo_capital_propio_txt", F.lit("Sin Información")).alias("tramo_capital_propio_txt"),
                      "grupo")


@register("month_names", f"""
SELECT a.anio, a.mes, m.mes_nombre, a.n_pedidos FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
         CAST(count(*) AS BIGINT) AS n_pedidos FROM orders GROUP BY 1, 2) a
LEFT JOIN {_values([(i + 1, n) for i, n in enumerate(MONTHS_ES)], ['mes', 'mes_nombre'], 'm')}
  ON a.mes = m.mes
""")
def month_names(spark, d):
    """Spanish month names joined from a literal month table (after aggregating)."""
    o = Tables(spark, d).orders
    counts = o.groupBy(F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes")).agg(
        F.count(F.lit(1)).alias("n_pedidos"))
    months = literal_table(spark, [(i + 1, n) for i, n in enumerate(MONTHS_ES)], "mes int, mes_nombre string")
    return counts.join(months, "mes", "left").select("anio", "mes", "mes_nombre", "n_pedidos")


@register("json_extract", """
SELECT event_id, json_extract_string(props, '$.k') AS k_txt, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_num,
       json_extract_string(props, '$.max_tol') AS faltante
FROM events
""")
def json_extract_q(spark, d):
    """G1: a JSON path as text; a missing path gives null."""
    ev = Tables(spark, d).events
    return ev.select("event_id", json_text("props", "$.k").alias("k_txt"),
                     json_text("props", "$.k").try_cast("int").alias("k_num"),
                     json_text("props", "$.max_tol").alias("faltante"))


@register("json_array", """
SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS tipos, CAST(count(*) AS INTEGER) AS n_tipos
FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1
""")
def json_array(spark, d):
    """A nested JSON record per user (its distinct event types as ``types[].type.name``) parsed
    back with ``from_json`` and flattened with ``transform``; compared as sorted text."""
    ev = Tables(spark, d).events.select("user_id", "event_type").distinct()
    per_user = ev.groupBy("user_id").agg(F.array_sort(F.collect_list("event_type")).alias("t"))
    doc = per_user.select("user_id", F.to_json(F.struct(
        F.col("user_id").alias("id"),
        F.transform("t", lambda x: F.struct(F.struct(x.alias("name")).alias("type"))).alias("types"))).alias("json"))
    names = inner_names("json", "id BIGINT, types ARRAY<STRUCT<type: STRUCT<name: STRING>>>", "types", "type.name")
    return doc.select("user_id", F.array_join(F.array_sort(names), ",").alias("tipos"), F.size(names).alias("n_tipos"))
