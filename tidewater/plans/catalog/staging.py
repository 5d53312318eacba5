"""Catalogue: the small staging jobs run on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans import employment, energy, membership, projects
from tidewater.plans.catalog import AS_OF_ORDERS, Tables, register


@register("roles_staging", """
SELECT CAST(o_custkey AS VARCHAR) AS rut, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS BIGINT)
         AS numero_socio, CAST(o_orderkey AS BIGINT) AS id_relacion, CAST(o_orderdate AS DATE) AS fecha_relacion,
       sha256(CAST(o_custkey AS VARCHAR)) AS rut_hash
FROM orders
""")
def roles_staging_q(spark, d):
    """B29 through ``plans.membership.roles_staging``: orders as member roles (ids as text, some not
    numbers), relation timestamp text truncated to a date, hashed id."""
    o = Tables(spark, d).orders
    raw = o.select(F.col("o_custkey").cast("string").alias("RUT"),
                   F.when(F.col("o_orderstatus") == "P", "x").otherwise(F.col("o_custkey").cast("string")).alias("NUMERO_SOCIO"),
                   F.col("o_orderkey").cast("string").alias("ID_RELACION"),
                   F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("FECHA_RELACION"))
    return membership.roles_staging(raw)


@register("requests_staging", """
SELECT CAST(o_orderdate AS DATE) AS fecha,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 7 END AS fecha_resolucion,
       TRY_CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS BIGINT) AS numero_socio
FROM orders
""")
def requests_staging_q(spark, d):
    """B36 through ``plans.membership.requests_staging``: orders as membership requests."""
    o = Tables(spark, d).orders
    day = F.to_date("o_orderdate")
    raw = o.select(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("FECHA"),
                   F.when(F.col("o_orderstatus") == "F", F.date_format(F.date_add(day, 7), "yyyy-MM-dd")).alias("FECHA_RESOLUCION"),
                   F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_custkey").cast("string")).alias("NUMERO_SOCIO"))
    return membership.requests_staging(raw)


@register("positions", """
SELECT p.p_partkey AS idcargo, p.p_name AS nombre_cargo, s.flag AS es_alto_cargo
FROM part p LEFT JOIN (SELECT DISTINCT p_partkey AS id, true AS flag FROM part
                       WHERE p_size > 40 AND p_brand <> 'Brand#1') s ON s.id = p.p_partkey
""")
def positions_q(spark, d):
    """B33 through ``plans.membership.positions``: parts as positions (raw header names cleaned);
    large parts listed as senior positions, those without a title ignored."""
    p = Tables(spark, d).part
    positions_df = p.select(F.col("p_partkey").alias("IdCargo"), F.col("p_name").alias("Nombre Cargo"))
    senior = p.where(F.col("p_size") > 40).select(
        F.col("p_partkey").cast("string").alias("IdCargo"),
        F.when(F.col("p_brand") == "Brand#1", F.lit(None)).otherwise(F.col("p_brand")).alias("Cargo_Directivo"))
    return membership.positions(positions_df, senior)


@register("representatives", """
SELECT r.numero_socio AS id_socio, r.per_id AS id_persona, p.rut, p.nombre_completo AS nombre, p.telefono_comercial,
       p.telefono_movil_comercial AS celular_comercial, p.email_comercial AS mail_comercial
FROM (SELECT o_custkey AS per_id, o_orderkey AS numero_socio FROM orders
      WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') r
LEFT JOIN (SELECT c_custkey AS per_id, CAST(c_custkey AS VARCHAR) AS rut, c_name AS nombre_completo,
                  CAST(c_nationkey AS VARCHAR) AS telefono_comercial,
                  CASE WHEN c_acctbal > 0 THEN CAST(c_custkey * 7 AS VARCHAR) END AS telefono_movil_comercial,
                  lower(c_name) || '@correo.example' AS email_comercial
           FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') p ON p.per_id = r.per_id
""")
def representatives_q(spark, d):
    """B38 through ``plans.projects.representatives``: open urgent orders as active relations of the
    representative role; customers (one segment missing) as the people's contact sheet."""
    t = Tables(spark, d)
    o = t.orders
    roles = o.select(F.col("o_custkey").alias("per_id"), F.col("o_orderkey").alias("numero_socio"),
                     F.when(F.col("o_orderpriority") == "1-URGENT", 106).otherwise(5).alias("id_rol"),
                     F.when(F.col("o_orderstatus") == "O", "ACTIVA").otherwise("INACTIVA").alias("estado_relacion"))
    people = t.customer.select(
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_custkey")).alias("per_id"), F.col("c_custkey").cast("string").alias("rut"),
        F.col("c_name").alias("nombre_completo"), F.col("c_nationkey").cast("string").alias("telefono_comercial"),
        F.when(F.col("c_acctbal") > 0, (F.col("c_custkey") * 7).cast("string")).alias("telefono_movil_comercial"),
        F.concat(F.lower("c_name"), F.lit("@correo.example")).alias("email_comercial"))
    return projects.representatives(roles, people)


@register("attendance_rolling", f"""
SELECT o_custkey AS reuid, CAST(o_orderdate AS DATE) AS reufecini, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS asiasis,
       'Reunion ' || CASE WHEN o_orderpriority = '5-LOW' THEN 'POSTERGADA' ELSE o_orderpriority END AS reunom,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CASE WHEN o_orderstatus = 'F' THEN 'SI' ELSE 'NO' END AS str_asistencia,
       CAST(year(o_orderdate) AS VARCHAR) || CAST(month(o_orderdate) AS VARCHAR) AS periodo,
       o_orderpriority <> '5-LOW' AS is_nombre_valido,
       CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS sexo
FROM orders
WHERE make_date(CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1)
      >= CAST(DATE '{AS_OF_ORDERS}' - INTERVAL 12 MONTH AS DATE)
""")
def attendance_rolling_q(spark, d):
    """B35 through ``plans.membership.attendance_rolling``: orders as meetings; only the (year, month)
    partitions from as_of minus 12 months are kept; cancelled-word flag and attendance text."""
    o = Tables(spark, d).orders
    df = o.select(F.col("o_custkey").alias("reuid"), F.to_date("o_orderdate").alias("reufecini"),
                  F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("asiasis"),
                  F.concat(F.lit("Reunion "), F.when(F.col("o_orderpriority") == "5-LOW", "POSTERGADA")
                           .otherwise(F.col("o_orderpriority"))).alias("reunom"),
                  F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                  F.when(F.col("o_orderstatus") == "P", "s/i").when(F.col("o_orderstatus") == "F", "1.0").otherwise("2").alias("sexo"))
    return membership.attendance_rolling(df, AS_OF_ORDERS)


@register("projected_demand", """
SELECT CASE WHEN year(o_orderdate) <= 1998 THEN 'escenario_medio' ELSE 'escenario_alto' END AS escenario,
       o_orderkey AS nombre_barra_proyeccion, o_totalprice AS medida_horaria, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN year(o_orderdate) >= 1999 THEN o_orderpriority END AS registro_romano,
       CAST(year(o_orderdate) AS VARCHAR) AS anio, '1999' AS "yearParticion"
FROM orders
""")
def projected_demand_q(spark, d):
    """B6 through ``plans.energy.projected_demand``: two scenarios with different columns, tagged and
    appended (missing columns null) under the job's names."""
    o = Tables(spark, d).orders
    cols = [F.col("o_orderkey").alias("barra_proyeccion"), F.col("o_totalprice").alias("MedidaHoraria2"), F.year("o_orderdate").alias("ano")]
    medio = o.where(F.year("o_orderdate") <= 1998).select(*cols)
    alto = o.where(F.year("o_orderdate") >= 1999).select(*cols, F.col("o_orderpriority").alias("reg_rom_"))
    return energy.projected_demand({"escenario_medio": medio, "escenario_alto": alto}, load_year=1999)


@register("projected_marginal_cost", """
SELECT o_orderpriority AS hidrologia, CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
       o_orderstatus AS nombre_barra, '01-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS fecha,
       CAST(year(o_orderdate) AS INTEGER) AS year_partition, o_orderpriority AS escenario_partition, '1999' AS "yearParticion"
FROM orders
""")
def projected_marginal_cost_q(spark, d):
    """B4 through ``plans.energy.projected_marginal_cost``: first-of-month text, renames and partition aliases."""
    o = Tables(spark, d).orders
    df = o.select(F.col("o_orderpriority").alias("hidro"), F.year("o_orderdate").alias("year"),
                  F.month("o_orderdate").alias("mes"), F.col("o_orderstatus").alias("barnom"))
    return energy.projected_marginal_cost(df, load_year=1999)


@register("evaluations_count", """
SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS "EVALUACION", CAST(count(*) AS BIGINT) AS "CONTEO"
FROM orders GROUP BY 1
""")
def evaluations_count_q(spark, d):
    """B15 through ``plans.employment.evaluations_count``: order priorities as evaluation scores."""
    o = Tables(spark, d).orders
    return employment.evaluations_count(o.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("EVALUACION")))


@register("pass_through", """
SELECT c_custkey AS id_cliente, c_name AS c_name, c_nationkey AS c_nationkey, c_acctbal AS saldo, c_mktsegment AS c_mktsegment
FROM customer
""")
def pass_through_q(spark, d):
    """B21 through ``plans.membership.pass_through``: a table copied with lowercased and renamed columns."""
    c = Tables(spark, d).customer
    raw = c.toDF(*[x.upper() for x in c.columns])
    return membership.pass_through(raw, {"c_custkey": "id_cliente", "c_acctbal": "saldo"})
