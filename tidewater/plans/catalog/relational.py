"""Catalogue: versions, joins, lookups, flags, history merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.nested import map_lookup
from tidewater.functions.rules import later_wins
from tidewater.functions.text import concat_null_empty, fold
from tidewater.operators.history import snapshot_merge
from tidewater.operators.relational import (branch_counts, exclude, exists_flag, folded_join, hop, lookup_join,
                                            role_join)
from tidewater.operators.versions import drop_earliest_dup, first_by, latest_by
from tidewater.plans.catalog import AS_OF_ORDERS, Tables, register
from tidewater.plans.employment import company_dimension
from tidewater.plans import energy
from tidewater.session import temp_views


@register("latest_version", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def latest_version(spark, d):
    """Newest row per (user_id, event_type); ties on event_id."""
    ev = Tables(spark, d).events.select("event_id", "ts", "user_id", "event_type", "value")
    return latest_by(ev, ["user_id", "event_type"], order_by="ts", tie_break="event_id")


@register("first_version", """
SELECT user_id, event_type, event_id, ts, value, c_name FROM (
  SELECT e.*, c.c_name, row_number() OVER (PARTITION BY e.user_id, e.event_type ORDER BY e.ts, e.event_id) AS rn
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  WHERE c.c_mktsegment = 'BUILDING' AND e.ts IS NOT NULL) WHERE rn = 1
""")
def first_version(spark, d):
    """W2 + J2: oldest row per (user, type) among users in a pre-filtered customer list (N7: null order never ranks)."""
    t = Tables(spark, d)
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    dim = t.customer.select(F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey")).alias("c_custkey"), "c_name")
    joined = lookup_join(ev, dim, {"user_id": "c_custkey"}, how="inner", select=["c_name"])
    return first_by(joined, ["user_id", "event_type"], order_by="ts", tie_break="event_id", drop_null_order=True)


def generation_fact(spark: SparkSession, lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                    nation: DataFrame, region: DataFrame, supplier: DataFrame, part: DataFrame) -> DataFrame:
    """B1 on the driver tables: the newest version of each (order, line), then a chain of inner
    joins and filters written as SQL over temp views (S11). Version selection is the
    partially-aggregated ``latest_by``; the join chain is left to Catalyst (it pushes the
    filters into the scans and AQE picks broadcast or sort-merge per join from sizes)."""
    ops = latest_by(lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
                                    "l_extendedprice"),
                    ["l_orderkey", "l_linenumber"], order_by="l_shipdate",
                    tie_break=["l_partkey", "l_suppkey", "l_extendedprice"])
    views = {"ops": ops, "orders": orders, "customer": customer, "nation": nation, "region": region,
             "supplier": supplier, "part": part}
    with temp_views(spark, views) as v:
        return spark.sql(f"""
            SELECT om.l_orderkey AS orderkey, om.l_linenumber AS linenumber, om.l_extendedprice AS valor,
                   p.p_type AS unidad, CAST(om.l_shipdate AS DATE) AS fecha, c.c_name AS cliente,
                   cn.n_name AS nacion_cliente, r.r_name AS region_cliente, s.s_name AS proveedor,
                   sn.n_name AS tipo_nodo, o.o_orderpriority AS prioridad
            FROM {v['ops']} om
            JOIN {v['orders']} o ON om.l_orderkey = o.o_orderkey
            JOIN {v['customer']} c ON o.o_custkey = c.c_custkey
            JOIN {v['nation']} cn ON c.c_nationkey = cn.n_nationkey
            JOIN {v['region']} r ON cn.n_regionkey = r.r_regionkey
            JOIN {v['supplier']} s ON om.l_suppkey = s.s_suppkey
            JOIN {v['nation']} sn ON s.s_nationkey = sn.n_nationkey
            JOIN {v['part']} p ON om.l_partkey = p.p_partkey
            WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH') AND sn.n_regionkey <> 0
        """)


@register("topology_fact", """
WITH ops AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS orden
  FROM lineitem)
SELECT om.l_orderkey AS orderkey, om.l_linenumber AS linenumber, om.l_extendedprice AS valor, p.p_type AS unidad,
       CAST(om.l_shipdate AS DATE) AS fecha, c.c_name AS cliente, cn.n_name AS nacion_cliente,
       r.r_name AS region_cliente, s.s_name AS proveedor, sn.n_name AS tipo_nodo, o.o_orderpriority AS prioridad
FROM ops om
JOIN orders o ON om.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN region r ON cn.n_regionkey = r.r_regionkey
JOIN supplier s ON om.l_suppkey = s.s_suppkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
JOIN part p ON om.l_partkey = p.p_partkey
WHERE om.orden = 1 AND o.o_orderpriority IN ('1-URGENT', '2-HIGH') AND sn.n_regionkey <> 0
""")
def topology_fact(spark, d):
    """B1: newest version per line, then a chain of inner joins written as SQL over temp views."""
    t = Tables(spark, d)
    return generation_fact(spark, t.lineitem, t.orders, t.customer, t.nation, t.region, t.supplier, t.part)


@register("role_dims", """
SELECT cn.n_name AS cliente_n_name, sn.n_name AS proveedor_n_name, CAST(count(*) AS BIGINT) AS n_lines,
       round(sum(l.l_extendedprice * (1 - l.l_discount)), 4) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
GROUP BY 1, 2
""")
def role_dims(spark, d):
    """Nation in two roles (customer side, supplier side). Lines are aggregated to
    (customer nation key, supplier nation key) first, so the role joins touch at most 625 rows."""
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    lines = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
             .join(s, li.l_suppkey == s.s_suppkey))
    pairs = lines.groupBy("c_nationkey", "s_nationkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    named = role_join(pairs, t.nation, "n_nationkey", {"cliente": "c_nationkey", "proveedor": "s_nationkey"},
                      ["n_name"])
    named = named.groupBy("cliente_n_name", "proveedor_n_name").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("revenue").alias("revenue"))
    return named.select("cliente_n_name", "proveedor_n_name", "n_lines", F.round("revenue", 4).alias("revenue"))


@register("graph_hop", """
WITH edges AS (
  SELECT DISTINCT c.c_nationkey AS src, s.s_nationkey AS dst
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)
SELECT a.n_name AS src_n_name, a.n_regionkey AS src_n_regionkey, b.n_name AS dst_n_name, b.n_regionkey AS dst_n_regionkey
FROM edges e JOIN nation a ON e.src = a.n_nationkey JOIN nation b ON e.dst = b.n_nationkey
WHERE b.n_regionkey = 1
""")
def graph_hop(spark, d):
    """Node -> edge -> node with a type filter on the destination node."""
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    edges = (li.join(o, li.l_orderkey == o.o_orderkey)
             .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
             .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
             .select(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).distinct())
    out = hop(edges, t.nation, "src", "dst", "n_nationkey", ["n_name", "n_regionkey"],
              dst_filter=F.col("dst_n_regionkey") == 1)
    return out.select("src_n_name", "src_n_regionkey", "dst_n_name", "dst_n_regionkey")


@register("lookup_left", """
SELECT o.o_orderkey AS id_pedido, o.o_custkey AS id_cliente, c.c_name AS cliente, c.c_mktsegment AS segmento
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
WHERE (o.o_orderstatus = 'F' OR o.o_orderpriority = '1-URGENT') AND o.o_totalprice > 1000
""")
def lookup_left(spark, d):
    """Pruned read (S2), AND/OR filter (F2), left lookup on one key (J3), renames."""
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice").where(
        ((F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT")) & (F.col("o_totalprice") > 1000))
    out = lookup_join(o, t.customer, {"o_custkey": "c_custkey"}, select=["c_name", "c_mktsegment"])
    return out.select(F.col("o_orderkey").alias("id_pedido"), F.col("o_custkey").alias("id_cliente"),
                      F.col("c_name").alias("cliente"), F.col("c_mktsegment").alias("segmento"))


STATUS_LABELS = {"F": "Finalizado", "O": "Abierto"}


@register("map_lookup", """
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'Finalizado' WHEN 'O' THEN 'Abierto' END AS estado_txt
FROM orders
""")
def map_lookup_q(spark, d):
    """Literal map lookup; codes without an entry give null."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    return o.withColumn("estado_txt", map_lookup("o_orderstatus", STATUS_LABELS))


@register("invert_map", """
SELECT c_mktsegment AS valor, max(c_custkey) AS clave FROM customer GROUP BY c_mktsegment
""")
def invert_map(spark, d):
    """Invert key -> value pairs; a repeated value keeps the last key (pairs ordered by key)."""
    pairs = Tables(spark, d).customer.select(F.col("c_custkey").alias("clave"), F.col("c_mktsegment").alias("valor"))
    return latest_by(pairs, ["valor"], order_by="clave").select("valor", "clave")


@register("existence_flags", """
SELECT c.c_custkey, c.c_name, coalesce(u.flag, false) AS tiene_urgente
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey, true AS flag FROM orders WHERE o_orderpriority = '1-URGENT') u
  ON c.c_custkey = u.o_custkey
""")
def existence_flags(spark, d):
    """Flag from the distinct keys of another table; null -> false."""
    t = Tables(spark, d)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return exists_flag(t.customer.select("c_custkey", "c_name"), urgent, {"c_custkey": "o_custkey"}, "tiene_urgente")


@register("exclusion_anti", """
SELECT p_partkey, p_name, p_retailprice FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)
""")
def exclusion_anti(spark, d):
    """Parts not on an exclusion list (left anti join)."""
    t = Tables(spark, d)
    excluded = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
    return exclude(t.part.select("p_partkey", "p_name", "p_retailprice"), excluded, {"p_partkey": "l_partkey"})


@register("member_registry", """
WITH members AS (
  SELECT lower(c_name) AS rut, c_custkey, c_nationkey, c_mktsegment FROM customer 
  UNION ALL
  SELECT lower(s_name) AS rut, NULL, s_nationkey, NULL FROM supplier),
insolvent AS (SELECT DISTINCT lower(c.c_name) AS rut, true AS insolvente FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
              WHERE o.o_orderstatus = 'P' AND o.o_totalprice > 300000),
totals AS (SELECT lower(c.c_name) AS rut, CAST(count(*) AS BIGINT) AS n_pedidos, round(sum(o.o_totalprice), 2) AS monto
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1)
SELECT m.rut, m.c_custkey, lower(n.n_name) AS nacion, coalesce(m.c_mktsegment, 'Sin Información') AS segmento,
       coalesce(i.insolvente, false) AS insolvente, coalesce(t.n_pedidos, 0) AS n_pedidos, coalesce(t.monto, 0.0) AS monto
FROM members m LEFT JOIN nation n ON m.c_nationkey = n.n_nationkey
LEFT JOIN insolvent i ON m.rut = i.rut LEFT JOIN totals t ON m.rut = t.rut
""")
def member_registry(spark, d):
    """A stand-in on the driver tables for B23's steps (its job is ``registry_members``): members from two sources with different
    columns (U2), lowercased keys (X1), registry lookup (J3), insolvency flag (J8), pre-aggregated totals (A1, A4), per-column fills (C5)."""
    from tidewater.plans.membership import member_totals as job
    t = Tables(spark, d)
    socios = t.customer.select(
        F.col("c_name").alias("rut"), "c_custkey", "c_nationkey", "c_mktsegment")
    empresas = t.supplier.select(F.col("s_name").alias("rut"),
                                                                  F.col("s_nationkey").alias("c_nationkey"))
    cust = t.customer.select("c_custkey", "c_name")
    orders = t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("rut"), "o_orderstatus", "o_totalprice")
    insolvencies = orders.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000)).select("rut")
    registry = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("nacion"))
    return job(socios, empresas, registry, insolvencies, orders.select("rut", "o_totalprice"))


@register("company_dim", f"""
WITH emp AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS rut, c.c_nationkey, n.n_name AS nom_region,
         CASE WHEN c.c_acctbal >= 0 THEN 1 ELSE 0 END AS estado
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
ign AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS rut, true AS ignorar FROM customer WHERE c_nationkey = 3),
act AS (SELECT CAST(o.o_custkey AS VARCHAR) AS rut, sum(l.l_quantity) AS persona_lista
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R' GROUP BY 1),
usr AS (SELECT CAST(o_custkey AS VARCHAR) AS rut, CAST(count(*) AS BIGINT) AS cv_vistos,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS numero_cv_descargados,
               max(CAST(o_orderdate AS DATE)) AS ultima_actividad, min(CAST(o_orderdate AS DATE)) AS fechaalta
        FROM orders GROUP BY 1),
soc AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS rut, 1 AS socio FROM customer WHERE c_mktsegment = 'BUILDING'),
j AS (
  SELECT e.rut, e.estado, e.nom_region, i.ignorar, a.persona_lista, u.cv_vistos, u.numero_cv_descargados,
         u.fechaalta, datediff('day', u.ultima_actividad, DATE '{AS_OF_ORDERS}') AS difference, s.socio
  FROM emp e LEFT JOIN ign i ON e.rut = i.rut LEFT JOIN act a ON e.rut = a.rut
  LEFT JOIN usr u ON e.rut = u.rut LEFT JOIN soc s ON e.rut = s.rut
  WHERE e.estado = 1)
SELECT rut, estado,
       coalesce(round(persona_lista, 2), 0.0) AS persona_lista,
       coalesce(cv_vistos, 0) AS cv_vistos,
       coalesce(numero_cv_descargados, 0) AS numero_cv_descargados,
       CASE WHEN difference IS NULL THEN 'INACTIVO' WHEN difference < 61 AND difference > 30 THEN 'CASI INACTIVO'
            WHEN difference < 31 THEN 'ACTIVO' ELSE 'INACTIVO' END AS status,
       coalesce(socio, 0) AS socio,
       CASE WHEN (cv_vistos > 0 OR numero_cv_descargados > 0 OR persona_lista > 0) AND estado = 1 AND ignorar IS NULL
            THEN true ELSE false END AS uso,
       fechaalta,
       CASE WHEN fechaalta >= DATE '{AS_OF_ORDERS}' - INTERVAL 12 MONTH THEN true ELSE false END AS f_365,
       CASE WHEN nom_region = 'NATION_0' THEN 'Santiago' ELSE 'Regiones' END AS santiago_region
FROM j WHERE coalesce(ignorar, false) = false
""")
def company_dim(spark, d):
    """Company dimension (A1, A2, J8, J9, T7, C1, C7, T19, C5) with a fixed as_of."""
    t = Tables(spark, d)
    empresas = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("rut"), F.col("n_name").alias("nom_region"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("estado"))
    ignorar = t.customer.select(F.when(F.col("c_nationkey") == 3, F.col("c_custkey").cast("string")).alias("rut"))
    li = t.lineitem.select(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("l_orderkey"), "l_quantity")
    actividad = li.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("rut"), F.col("l_quantity").alias("persona_lista"))
    usuarios = t.orders.select(F.col("o_custkey").cast("string").alias("rut"),
                               F.lit(1).alias("vistas_cv"),
                               F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("descarga_cv"),
                               F.to_date("o_orderdate").alias("fecha_alta"))
    socios = t.customer.select(F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey").cast("string")).alias("rut"))
    return company_dimension(empresas, ignorar, actividad, usuarios, socios, AS_OF_ORDERS, capital_region="NATION_0")


@register("company_registry", f"""
WITH emp AS (
  SELECT 'r' || CAST(c.c_custkey AS VARCHAR) AS rut, c.c_nationkey, 1 AS estado, CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS estado_real,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN '31/02/2001' ELSE strftime(DATE '1996-01-01' + CAST(c_custkey % 2100 AS INTEGER), '%d/%m/%Y') END AS fechaalta,
         CASE WHEN c.c_nationkey = 5 THEN 'Migración' ELSE 'ÑUÑOA ' || CAST(c.c_nationkey AS VARCHAR) END AS nom_comuna, n.n_name AS nom_region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
usr AS (SELECT 'r' || CAST(o_custkey AS VARCHAR) AS rut, count(*) AS cv_vistos, count(*) FILTER (WHERE o_orderstatus = 'F') AS numero_cv_descargados,
               max(CAST(o_orderdate AS DATE)) AS ultima FROM orders GROUP BY 1),
geo AS (SELECT DISTINCT CAST(n_nationkey AS BIGINT) + 100 AS id_camara, CASE WHEN n_nationkey = 5 THEN 'migracion' ELSE 'nunoa ' || CAST(n_nationkey AS VARCHAR) END AS c
        FROM nation WHERE n_regionkey <> 1),
reg AS (SELECT upper('r' || CAST(c_custkey AS VARCHAR)) AS rut, c_mktsegment AS rubro_economico, CAST(floor(c_acctbal) AS BIGINT) AS numero_de_trabajadores
        FROM customer)
SELECT upper(e.rut) AS rut, estado, CAST(0 AS DOUBLE) AS persona_lista, coalesce(cv_vistos, 0) AS cv_vistos, coalesce(numero_cv_descargados, 0) AS numero_cv_descargados,
       CASE WHEN ultima IS NULL THEN 'INACTIVO' WHEN datediff('day', ultima, DATE '{AS_OF_ORDERS}') BETWEEN 31 AND 60 THEN 'CASI INACTIVO'
            WHEN datediff('day', ultima, DATE '{AS_OF_ORDERS}') < 31 THEN 'ACTIVO' ELSE 'INACTIVO' END AS status,
       CASE WHEN e.rut IN (SELECT 'r' || CAST(s_suppkey AS VARCHAR) FROM supplier) THEN 1 ELSE 0 END AS socio,
       coalesce(cv_vistos > 0, false) AS uso, CAST(try_strptime(fechaalta, '%d/%m/%Y') AS DATE) AS fechaalta,
       coalesce(CAST(try_strptime(fechaalta, '%d/%m/%Y') AS DATE) >= DATE '{AS_OF_ORDERS}' - INTERVAL 12 MONTH, false) AS f_365,
       CASE WHEN nom_region = 'NATION_0' THEN 'Santiago' ELSE 'Regiones' END AS santiago_region,
       CASE WHEN nom_comuna = 'Migración' THEN 'Sin Información' ELSE nom_comuna END AS nom_comuna, geo.id_camara, reg.rubro_economico, reg.numero_de_trabajadores
FROM emp e LEFT JOIN usr ON usr.rut = e.rut LEFT JOIN geo ON geo.c = lower(strip_accents(e.nom_comuna)) LEFT JOIN reg ON reg.rut = upper(e.rut)
WHERE estado_real = 1 AND e.rut NOT IN (SELECT 'r' || CAST(7 * p_partkey AS VARCHAR) FROM part)
""")
def company_registry(spark, d):
    """B19 with all its branches: sign-up dates as ``dd/MM/yyyy`` text (some impossible), the chamber by accent-folded municipality
    (J14, X11), and the tax registry by normalised id; companies whose number is seven times a part's are left out."""
    t = Tables(spark, d)
    key = lambda c: F.concat(F.lit("r"), F.col(c).cast("string"))
    n = F.col("c_nationkey")
    signed = F.date_format(F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") % 2100).cast("int")), "dd/MM/yyyy")
    empresas = t.customer.join(t.nation, n == F.col("n_nationkey")).select(
        key("c_custkey").alias("rut"), F.col("n_name").alias("nom_region"), F.when(F.col("c_acctbal") < 0, 0).otherwise(1).alias("estado"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "31/02/2001").otherwise(signed).alias("fechaalta"),
        F.when(n == 5, "Migración").otherwise(F.concat(F.lit("ÑUÑOA "), n.cast("string"))).alias("nom_comuna"))
    usuarios = t.orders.select(key("o_custkey").alias("rut"), F.lit(1).alias("vistas_cv"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("descarga_cv"),
                               F.to_date("o_orderdate").alias("fecha_alta"))
    actividad = t.supplier.select(F.lit("none").alias("rut"), F.col("s_acctbal").alias("persona_lista"))
    geography = t.nation.where("n_regionkey <> 1").select((F.col("n_nationkey").cast("bigint") + 100).alias("id_geo"),
                                                          F.when(F.col("n_nationkey") == 5, "MIGRACIÓN").otherwise(F.concat(F.lit("Ñuñoá "), F.col("n_nationkey").cast("string"))).alias("comuna"))
    registry = t.customer.select(F.concat(F.lit("r-"), F.col("c_custkey").cast("string")).alias("rut"), F.col("c_mktsegment").alias("rubro_economico"),
                                 F.floor("c_acctbal").cast("bigint").alias("numero_de_trabajadores"))
    return company_dimension(empresas, t.part.select(F.concat(F.lit("r"), (7 * F.col("p_partkey")).cast("string")).alias("rut")), actividad, usuarios, t.supplier.select(key("s_suppkey").alias("rut")),
                             AS_OF_ORDERS, capital_region="NATION_0", geography=geography, registry=registry)


SNAPSHOT_BASE = """
WITH src AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS rut,
         CAST(o_orderkey AS VARCHAR) AS rol, CAST(o_orderdate AS DATE) AS fecha_publicacion,
         CASE WHEN o_orderstatus = 'F' THEN true END AS proceso_finalizado
  FROM orders),
h AS (SELECT rut, rol, fecha_publicacion, CAST(NULL AS VARCHAR) AS fecha_ejecucion, proceso_finalizado,
             coalesce(rut, 'CORRECCION:' || rol) AS k FROM src WHERE fecha_publicacion < DATE '1998-01-01'),
s AS (SELECT rut, rol, fecha_publicacion, coalesce(rut, 'CORRECCION:' || rol) AS k
      FROM src WHERE fecha_publicacion >= DATE '1997-01-01'),
open_k AS (SELECT DISTINCT k FROM h WHERE proceso_finalizado IS NULL),
fin AS (SELECT k FROM open_k WHERE k NOT IN (SELECT k FROM s)),
hu AS (SELECT rut, rol, fecha_publicacion,
              CASE WHEN rut IN (SELECT k FROM fin) THEN '{as_of}' ELSE fecha_ejecucion END AS fecha_ejecucion,
              CASE WHEN rut IN (SELECT k FROM fin) THEN true ELSE proceso_finalizado END AS proceso_finalizado FROM h),
added AS (SELECT rut, rol, fecha_publicacion, k FROM s WHERE k NOT IN (SELECT k FROM open_k)),
merged AS (SELECT rut, rol, fecha_publicacion, fecha_ejecucion, proceso_finalizado FROM hu
           UNION ALL SELECT rut, rol, fecha_publicacion, CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN) FROM added),
reg AS (SELECT CAST(c_custkey AS VARCHAR) AS rut, c_name AS razon_social, c_mktsegment AS rubro_economico
        FROM customer WHERE c_acctbal > 0 AND CAST(c_custkey AS VARCHAR) IN (SELECT k FROM added))
SELECT m.rut, m.rol, m.fecha_publicacion, m.fecha_ejecucion, m.proceso_finalizado, r.razon_social, r.rubro_economico
FROM merged m LEFT JOIN reg r ON m.rut = r.rut
"""


@register("snapshot_merge", SNAPSHOT_BASE.format(as_of=AS_OF_ORDERS))
def snapshot_merge_q(spark, d):
    """Orders before 1998 as stored history, orders from 1997 as today's snapshot.

    Keys fall back to ``'CORRECCION:' || rol`` where the id is null (X16); open keys missing from the
    snapshot are finished (J11), snapshot keys not open in history are appended (J11 + U2), and
    registry attributes of the appended ids are joined (J10, D3, J3).
    """
    t = Tables(spark, d)
    src = t.orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("rut"),
        F.col("o_orderkey").cast("string").alias("rol"),
        F.to_date("o_orderdate").alias("fecha_publicacion"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("proceso_finalizado"))
    history = src.where(F.col("fecha_publicacion") < F.lit("1998-01-01").cast("date")).select(
        "rut", "rol", "fecha_publicacion", F.lit(None).cast("string").alias("fecha_ejecucion"), "proceso_finalizado")
    snapshot = src.where(F.col("fecha_publicacion") >= F.lit("1997-01-01").cast("date")).select(
        "rut", "rol", "fecha_publicacion")
    registry = t.customer.select(F.col("c_custkey").cast("string").alias("rut"), F.col("c_name").alias("razon_social"),
                                 F.col("c_mktsegment").alias("rubro_economico"),
                                 F.when(F.col("c_acctbal") > 0, "ACTIVO").otherwise("INACTIVO").alias("estado"),
                                 F.col("c_custkey").alias("orden"))
    return snapshot_merge(history, snapshot, AS_OF_ORDERS, registry=registry,
                          registry_cols=["razon_social", "rubro_economico"],
                          registry_filter=F.col("estado") == "ACTIVO", registry_order="orden")


@register("expression_key", """
SELECT c.c_custkey, c.c_name, CAST(c.c_custkey AS VARCHAR) || upper(lower(substr(c.c_mktsegment, 1, 1))) AS rut,
       coalesce(x.fundacion_social, 'No') AS fundacion_social
FROM customer c LEFT JOIN (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) || o_orderstatus AS rut, 'Si' AS fundacion_social FROM orders) x
  ON x.rut = CAST(c.c_custkey AS VARCHAR) || upper(lower(substr(c.c_mktsegment, 1, 1)))
""")
def expression_key(spark, d):
    """Join on an expression key ``concat(number, upper(check letter))``."""
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", "c_name", F.col("c_custkey").cast("string").alias("num"),
                          F.lower(F.substring("c_mktsegment", 1, 1)).alias("dv"))
    cesantes = t.orders.select(F.concat(F.col("o_custkey").cast("string"), F.col("o_orderstatus")).alias("rut"),
                               F.lit("Si").alias("fundacion_social")).distinct()
    out = c.join(cesantes, cesantes["rut"] == F.concat(c["num"], F.upper(c["dv"])), "left")
    return out.select("c_custkey", "c_name", F.concat("num", F.upper("dv")).alias("rut"),
                      F.coalesce("fundacion_social", F.lit("No")).alias("fundacion_social"))


FOLD_SQL = "regexp_replace(strip_accents(lower({0})), '[^\\x00-\\x7F]', '', 'g')"


@register("folded_join", f"""
WITH a AS (SELECT {FOLD_SQL.format("split_part(text, ' ', 1)")} AS palabra, CAST(count(*) AS BIGINT) AS n_documentos
           FROM documents GROUP BY 1),
b AS (SELECT {FOLD_SQL.format("split_part(text, ' ', 1)")} AS palabra, CAST(count(*) AS BIGINT) AS n_turnos
      FROM conversations GROUP BY 1)
SELECT a.palabra, a.n_documentos, b.n_turnos FROM a LEFT JOIN b ON a.palabra = b.palabra
""")
def folded_join_q(spark, d):
    """Accent- and case-insensitive join. First words are counted per folded form on each side
    (aggregation before the join, so hot words never multiply), then joined on the folded key."""
    t = Tables(spark, d)
    docs = (t.documents.select(F.element_at(F.split("text", " "), 1).alias("w"))
            .groupBy(fold("w").alias("palabra")).agg(F.count(F.lit(1)).alias("n_documentos")))
    turns = (t.conversations.select(F.element_at(F.split("text", " "), 1).alias("w"))
             .groupBy(fold("w").alias("w2")).agg(F.count(F.lit(1)).alias("n_turnos")))
    return folded_join(docs, turns, "palabra", "w2", select=["n_turnos"]).select("palabra", "n_documentos", "n_turnos")


@register("fanout_counts", """
WITH m AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1),
cu AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
su AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1)
SELECT c.c_custkey, CAST(coalesce(m.n, 0) AS BIGINT) AS ed_media, CAST(coalesce(cu.n, 0) AS BIGINT) AS cursos,
       CAST(coalesce(su.n, 0) AS BIGINT) AS ed_superior,
       coalesce(m.n, 0) > 0 AS tiene_ed_media, coalesce(cu.n, 0) > 0 AS tiene_cursos,
       coalesce(su.n, 0) > 0 AS tiene_ed_superior
FROM customer c LEFT JOIN m ON c.c_custkey = m.k LEFT JOIN cu ON c.c_custkey = cu.k LEFT JOIN su ON c.c_custkey = su.k
WHERE coalesce(m.n, 0) > 0 OR coalesce(cu.n, 0) > 0 OR coalesce(su.n, 0) > 0
""")
def fanout_counts(spark, d):
    """J16/A10/C6 (B14): child counts per parent in three branches, kept when any is positive, plus flags.
    Each branch is counted on its own, so no join multiplies rows."""
    t = Tables(spark, d)
    media = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    cursos = t.orders.where(F.col("o_orderstatus") == "F")
    out = branch_counts(t.customer.select("c_custkey"), "c_custkey",
                        {"ed_media": (media, "o_custkey"), "cursos": (cursos, "o_custkey"),
                         "ed_superior": (t.events, "user_id")})
    return out.withColumns({f"tiene_{n}": F.col(n) > 0 for n in ["ed_media", "cursos", "ed_superior"]})


@register("chain_count", """
SELECT strftime(l.l_shipdate, '%Y-%m-%d') AS dia, r.r_name AS region, CAST(count(*) AS BIGINT) AS descargas
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE o.o_orderstatus = 'F' AND s.s_acctbal > 0
GROUP BY 1, 2
""")
def chain_count(spark, d):
    """A six-table join chain counted by day text and region.

    Lines are first counted per (order, supplier, day) (COUNT distributes over the lookups),
    so each later join moves partial counts instead of lines.
    """
    from tidewater.functions.dates import style_120
    t = Tables(spark, d)
    li = (t.lineitem.groupBy("l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("dia"))
          .agg(F.count(F.lit(1)).alias("n")))
    o = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    s = t.supplier.select(F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).alias("s_suppkey"))
    chain = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
             .groupBy("o_custkey", "dia").agg(F.sum("n").alias("n"))
             .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
             .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
             .join(t.region.select("r_regionkey", F.col("r_name").alias("region")), F.col("n_regionkey") == F.col("r_regionkey")))
    # the day is formatted as text (style 120) only after the last aggregation
    out = chain.groupBy("dia", "region").agg(F.sum("n").alias("descargas"))
    return out.select(style_120("dia").alias("dia"), "region", "descargas")


@register("nested_agg", """
SELECT c.c_name AS rut, o.o_orderkey AS lista, c.c_custkey AS id_usuario, g.numero AS persona_lista,
       round(COALESCE(SUM(COALESCE(l.l_quantity, 0)), 0), 2) AS numero_cv_descargados
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, count(*) AS numero FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) g
  ON g.l_orderkey = o.o_orderkey
GROUP BY c.c_name, o.o_orderkey, c.c_custkey, g.numero
""")
def nested_agg(spark, d):
    """List usage per user; downloads summed with ISNULL/COALESCE, invitations from a
    pre-aggregated subquery. Both lineitem aggregates come from one pass keyed by order."""
    t = Tables(spark, d)
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.coalesce("l_quantity", F.lit(0.0))).alias("cv"),
        F.count_if(F.col("l_returnflag") == "R").alias("numero"))
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    out = (o.join(c, o.o_custkey == c.c_custkey, "left")
           .join(t.nation.select("n_nationkey"), F.col("n_nationkey") == F.col("c_nationkey"))
           .join(per_order, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    return out.select(F.col("c_name").alias("rut"), F.col("o_orderkey").alias("lista"),
                      F.col("c_custkey").alias("id_usuario"),
                      F.when(F.col("numero") > 0, F.col("numero")).alias("persona_lista"),
                      F.round(F.coalesce("cv", F.lit(0.0)), 2).alias("numero_cv_descargados"))


@register("star_fact", """
SELECT l.l_orderkey, l.l_linenumber, coalesce(p.p_partkey, 99999999) AS id_parte,
       coalesce(p.p_brand, 'Sin Información') AS marca,
       CASE WHEN p.p_brand LIKE 'Brand#10%' THEN 'grupo_10' WHEN p.p_brand LIKE 'Brand#2%' THEN 'grupo_2'
            WHEN p.p_brand LIKE 'Brand#1%' THEN 'grupo_1' ELSE 'otro' END AS grupo,
       coalesce(s.s_name, 'Sin Información') AS proveedor, round(l.l_extendedprice, 2) AS monto, CAST(0 AS DOUBLE) AS monto_usd
FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")
def star_fact(spark, d):
    """Fact to dimensions with an unknown member; prefix rules where a later rule wins."""
    t = Tables(spark, d)
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    parts = t.part.select(F.when(F.col("p_size") <= 45, F.col("p_partkey")).alias("p_partkey"), "p_brand")
    out = lookup_join(fact, parts, {"l_partkey": "p_partkey"}, select=["p_partkey", "p_brand"],
                      defaults={"p_partkey": 99999999, "p_brand": "Sin Información"})
    out = lookup_join(out, t.supplier, {"l_suppkey": "s_suppkey"}, select=["s_name"],
                      defaults={"s_name": "Sin Información"})
    brand = F.col("p_brand")
    grupo = later_wins([(brand.startswith("Brand#1"), "grupo_1"), (brand.startswith("Brand#2"), "grupo_2"),
                        (brand.startswith("Brand#10"), "grupo_10")], "otro")
    return out.select("l_orderkey", "l_linenumber", F.col("p_partkey").alias("id_parte"),
                      F.col("p_brand").alias("marca"), grupo.alias("grupo"), F.col("s_name").alias("proveedor"),
                      F.round("l_extendedprice", 2).alias("monto"), F.lit(0.0).alias("monto_usd"))


@register("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, d):
    """D1."""
    return Tables(spark, d).orders.select("o_orderstatus", "o_orderpriority").distinct()


@register("dedup_first", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS fecha, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def dedup_first(spark, d):
    """First order per customer, tie on order key."""
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = first_by(o, ["o_custkey"], "o_orderdate", "o_orderkey")
    return out.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("fecha"), "o_totalprice")


@register("dedup_last", """
SELECT x.o_custkey, x.o_orderkey, CAST(x.o_orderdate AS DATE) AS fecha, c.c_name, c.c_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) x
JOIN customer c ON x.o_custkey = c.c_custkey
WHERE x.rn = 1 AND c.c_acctbal > 0
""")
def dedup_last(spark, d):
    """Last order per customer, joined to the registry, active rows only."""
    t = Tables(spark, d)
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    last = latest_by(o, ["o_custkey"], "o_orderdate", "o_orderkey")
    active = t.customer.where(F.col("c_acctbal") > 0)
    out = lookup_join(last, active, {"o_custkey": "c_custkey"}, how="inner", select=["c_name", "c_acctbal"])
    return out.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("fecha"), "c_name", "c_acctbal")


@register("drop_earliest_dup", """
WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS dia, event_type FROM events),
d AS (SELECT user_id, min(dia) AS d0 FROM e WHERE dia IS NOT NULL GROUP BY user_id HAVING min(dia) < max(dia))
SELECT e.event_id, e.user_id, e.dia, e.event_type,
       CASE WHEN regexp_matches(lower(e.event_type), 'error|refund') THEN false ELSE true END AS is_nombre_valido,
       CASE WHEN e.event_type = 'purchase' THEN 'SI' ELSE 'NO' END AS str_asistencia
FROM e WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.user_id = e.user_id AND d.d0 = e.dia)
""")
def drop_earliest_dup_q(spark, d):
    """Users seen on several days lose their earliest day; cancelled-word flag (F8); fills."""
    from tidewater.functions.text import contains_any
    ev = Tables(spark, d).events.select("event_id", "user_id", F.to_date("ts").alias("dia"), "event_type")
    out = drop_earliest_dup(ev, "user_id", "dia")
    return out.select("event_id", "user_id", "dia", "event_type",
                      F.when(contains_any("event_type", ["error", "refund"]), False).otherwise(True).alias("is_nombre_valido"),
                      F.when(F.col("event_type") == "purchase", "SI").otherwise("NO").alias("str_asistencia"))


__all__ = ["concat_null_empty", "fold"]


@register("plant_generation", """
WITH m AS (
  SELECT l_suppkey AS key_id, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS time_id, l_extendedprice AS value,
         row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate), month(l_shipdate) ORDER BY l_orderkey * 10 + l_linenumber DESC) AS rn
  FROM lineitem)
SELECT m.value AS valor, ur.r_name AS unidad, make_date(CAST(m.time_id // 100 AS INTEGER), CAST(m.time_id % 100 AS INTEGER), 1) AS fecha,
       CAST(m.time_id % 24 AS INTEGER) AS "Hora", s.s_name AS "Nombre_Central_Unidad", tr.r_name AS "Tipo_Tecnologia",
       'Owner ' || tr.r_name AS "Propietario", CASE WHEN s.s_acctbal > 0 THEN CAST(s.s_suppkey AS VARCHAR) END AS potencia_maxima,
       m.key_id AS "Idcentral"
FROM m JOIN supplier s ON s.s_suppkey = m.key_id
JOIN region ur ON ur.r_regionkey = s.s_nationkey % 5
JOIN nation n ON n.n_nationkey = s.s_nationkey
JOIN region tr ON tr.r_regionkey = n.n_regionkey
WHERE m.rn = 1 AND s.s_nationkey % 5 IN (1, 2) AND tr.r_regionkey <> 0
""")
def plant_generation(spark, d):
    """B1 through ``plans.energy.real_generation``, all twelve joins: suppliers as keys, line items as measurements per
    month, nations as plants, regions as units, technologies and owners."""
    t = Tables(spark, d)
    month = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    meas = t.lineitem.select(F.col("l_suppkey").alias("key_id"), month.cast("bigint").alias("reported_time_id"),
                             (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("audit_id"), F.col("l_extendedprice").alias("value"))
    time = meas.select(F.col("reported_time_id").alias("id")).distinct().select(
        "id", F.make_date(F.floor(F.col("id") / 100).cast("int"), (F.col("id") % 100).cast("int"), F.lit(1)).alias("date"), (F.col("id") % 24).cast("int").alias("hour"))
    params = F.when(F.col("s_acctbal") > 0, F.format_string('{"max_tol": %d}', "s_suppkey")).otherwise("{}")
    key = t.supplier.select(F.col("s_suppkey").alias("id"), (F.col("s_nationkey") % 5).alias("key_type_id"), F.col("s_name").alias("name"),
                            params.alias("params"), F.col("s_nationkey").alias("company_id"))
    node = (t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("description"), F.lit(3).alias("node_type_id"))
            .union(t.region.select(F.col("r_regionkey") + 100, "r_name", F.when(F.col("r_regionkey") > 0, 1).otherwise(2))))
    return energy.real_generation(
        meas, key, t.supplier.select(F.col("s_suppkey").alias("key_id")), time,
        t.region.select(F.col("r_regionkey").alias("id"), F.col("r_regionkey").alias("key_unit_id")),
        t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("natural_key")),
        t.supplier.select(F.col("s_suppkey").alias("key_id"), F.col("s_nationkey").alias("node_id")), node,
        t.nation.select(F.col("n_nationkey").alias("src_id"), (F.col("n_regionkey") + 100).alias("dst_id")),
        t.nation.select(F.col("n_nationkey").alias("id")),
        t.nation.select(F.col("n_name").alias("centralnombre"), F.col("n_regionkey").alias("id_propietario")),
        t.region.select(F.col("r_regionkey").alias("id_empresa"), F.concat(F.lit("Owner "), "r_name").alias("empresanombre")), key_types=(1, 2))
