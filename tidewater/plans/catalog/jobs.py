"""Catalogue: named jobs run end to end on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import MONTHS_ES
from tidewater.functions.rules import first_rule
from tidewater.plans import employment, energy, finance, membership, monitor, projects, sport
from tidewater.plans.catalog import AS_OF_ORDERS, Tables, register
from tidewater.plans.employment import AGE_LABELS, EXPERIENCE_ORDER, REGION_NAMES
from tidewater.plans.membership import CAPITAL_BRACKETS, CONSTRUCTION_GROUPS

RUN_STATE_SQL = ("CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCEEDED' "
                 "WHEN 'error' THEN 'FAILED' WHEN 'click' THEN 'TIMED_OUT' ELSE 'ABORTED' END")
PROCESS_NAMES = {f"arn:proc:stateMachine:{i}": f"Proceso {i}" for i in range(5)}


@register("process_report", f"""
WITH r AS (
  SELECT 'arn:proc:stateMachine:' || CAST(user_id AS VARCHAR) AS arn, ts AS startdate,
         CASE WHEN event_type = 'signup' THEN NULL
              ELSE ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS stopdate,
         {RUN_STATE_SQL} AS status
  FROM events),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arn ORDER BY startdate DESC NULLS LAST,
                                                  stopdate DESC NULLS LAST) AS rn FROM r) WHERE rn = 1)
SELECT CASE arn {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in PROCESS_NAMES.items())} END AS "Nombre Proceso / Fuente",
       string_split(arn, ':')[-1] AS "Statemachine", startdate AS "Inicio", stopdate AS "Fin",
       round(date_diff('microsecond', startdate, stopdate) / 1e6, 6) AS "Duración",
       replace(replace(replace(replace(status, 'SUCCEEDED', '✅'), 'FAILED', '❌'), 'ABORTED', '⊗'), 'RUNNING', '🏃') AS "Estado"
FROM l
""")
def process_report_q(spark, d):
    """B11 through ``plans.monitor.process_report``: events as runs of one process per user (signups
    still running, other runs stopping ``value`` seconds after they start); latest run per process,
    display name from a literal map, state symbols."""
    ev = Tables(spark, d).events
    state = F.when(F.col("event_type") == "signup", "RUNNING").when(F.col("event_type") == "purchase", "SUCCEEDED") \
        .when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "click", "TIMED_OUT") \
        .otherwise("ABORTED")
    stop = F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(
        F.timestamp_add("MICROSECOND", F.round(F.col("value") * 1e6).cast("bigint"), F.col("ts")))
    runs = ev.select(F.concat(F.lit("arn:proc:stateMachine:"), F.col("user_id").cast("string")).alias("stateMachineArn"),
                     F.col("ts").alias("startDate"), stop.alias("stopDate"), state.alias("status"))
    out = monitor.process_report(runs, PROCESS_NAMES)
    return out.withColumn("Duración", F.round("Duración", 6))


@register("error_report", """
SELECT CASE event_type WHEN 'error' THEN 'Errores' WHEN 'purchase' THEN 'Compras' END AS "Nombre Proceso",
       event_type AS "Nombre Función",
       sum(CASE WHEN value > 45 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS "Cantidad de errores",
       CAST(ts AS DATE) AS "Fecha de ejecución",
       CASE WHEN sum(CASE WHEN value > 45 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) > 0 THEN '❌' ELSE '✅' END AS "Estado"
FROM events GROUP BY event_type, CAST(ts AS DATE)
""")
def error_report_q(spark, d):
    """B12 through ``plans.monitor.daily_errors``: per event type and day, the number of events
    above a threshold as the error metric, with the day's status symbol."""
    ev = Tables(spark, d).events
    metrics = ev.select(F.col("event_type").alias("function"), F.col("ts").alias("Timestamp"),
                        F.when(F.col("value") > 45, 1.0).otherwise(0.0).alias("Sum"))
    return monitor.daily_errors(metrics, {"error": "Errores", "purchase": "Compras"})


LOCAL_TEXT_SQL = "translate(format('{{:,.2f}}', {0}), ',.', '.,')"
PARSE_SQL = "CAST(round_even(TRY_CAST(replace(replace({0}, '.', ''), ',', '.') AS DOUBLE), 0) AS BIGINT)"
DATE_SQL = "CAST(try_strptime(split_part({0}, ' ', 1), '%d-%m-%Y') AS DATE)"
CAP_SQL = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"
LABEL_SQL = ("['ene', 'feb', 'mar', 'abr', 'may', 'jun', 'jul', 'ago', 'sep', 'oct', 'nov', 'dic']"
             "[CAST(substr({0}, 5, 2) AS INTEGER)] || ' - ' || substr({0}, 1, 4)")


@register("tenders_staging", f"""
WITH t AS (
  SELECT o_orderkey AS id_licitacion,
         {LOCAL_TEXT_SQL.format('o_totalprice')} AS cantidad_adjudicada,
         CAST(o_custkey AS VARCHAR) || ',5' AS presupuesto,
         {LOCAL_TEXT_SQL.format('o_totalprice')} AS total_adjudicado,
         CASE WHEN o_orderstatus = 'P' THEN 'sin precio' ELSE CAST(o_custkey AS VARCHAR) END AS precio_unitario,
         strftime(o_orderdate, '%d-%m-%Y') || ' 00:00' AS adjudicacion,
         strftime(o_orderdate - INTERVAL 10 DAY, '%d-%m-%Y') AS publicacion,
         CASE WHEN o_orderstatus = 'P' THEN '31-02-' || CAST(year(o_orderdate) AS VARCHAR) || ' 10:00'
              ELSE strftime(o_orderdate + INTERVAL 5 DAY, '%d-%m-%Y') END AS cierre,
         o_orderpriority AS lic_nombre, 'LICITACION ' || o_orderstatus AS lic_descrip
  FROM orders),
s AS (
  SELECT id_licitacion, {PARSE_SQL.format('cantidad_adjudicada')} AS cantidad_adjudicada,
         {PARSE_SQL.format('presupuesto')} AS presupuesto, {PARSE_SQL.format('total_adjudicado')} AS total_adjudicado,
         {PARSE_SQL.format('precio_unitario')} AS precio_unitario,
         {DATE_SQL.format('adjudicacion')} AS adjudicacion, {DATE_SQL.format('publicacion')} AS publicacion,
         {DATE_SQL.format('cierre')} AS cierre, {CAP_SQL.format('lic_nombre')} AS lic_nombre,
         {CAP_SQL.format('lic_descrip')} AS lic_descrip
  FROM t)
SELECT *, strftime(adjudicacion, '%Y%m') AS periodo_num,
       {LABEL_SQL.format("strftime(adjudicacion, '%Y%m')")} AS periodo_str,
       {LABEL_SQL.format("strftime(adjudicacion, '%Y%m')")} AS periodo
FROM s
""")
def tenders_staging_q(spark, d):
    """B24 through ``plans.finance.tenders_staging``: orders as tenders with local-format amounts
    (some ending in ``,5`` to exercise half-even rounding, some not numbers), ``dd-MM-yyyy`` dates
    with a time part (some invalid), names to capitalise, and the award period label."""
    o = Tables(spark, d).orders
    local = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    day = F.to_date("o_orderdate")
    raw = o.select(
        F.col("o_orderkey").alias("ID_LICITACION"),
        local.alias("CANTIDAD_ADJUDICADA"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(",5")).alias("PRESUPUESTO"),
        local.alias("TOTAL_ADJUDICADO"),
        F.when(F.col("o_orderstatus") == "P", "sin precio").otherwise(F.col("o_custkey").cast("string")).alias("PRECIO_UNITARIO"),
        F.concat(F.date_format(day, "dd-MM-yyyy"), F.lit(" 00:00")).alias("ADJUDICACION"),
        F.date_format(F.date_sub(day, 10), "dd-MM-yyyy").alias("PUBLICACION"),
        F.when(F.col("o_orderstatus") == "P",
               F.concat(F.lit("31-02-"), F.year(day).cast("string"), F.lit(" 10:00")))
        .otherwise(F.date_format(F.date_add(day, 5), "dd-MM-yyyy")).alias("CIERRE"),
        F.col("o_orderpriority").alias("LIC_NOMBRE"),
        F.concat(F.lit("LICITACION "), F.col("o_orderstatus")).alias("LIC_DESCRIP"))
    return finance.tenders_staging(raw)


MILESTONE_SQL = f"""
WITH m AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id_proyecto, '-' || substr(o_orderpriority, 1, 1) AS id_tablero,
         CAST(o_orderkey AS VARCHAR) AS id_hito,
         CASE o_orderpriority WHEN '5-LOW' THEN 'Cabecera' WHEN '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END
           AS nombre_hito,
         'lider-' || o_orderstatus AS nombre_lider_hito, o_orderstatus AS gerencia_hito,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_finalizado,
         CAST(o_orderdate AS DATE) AS fecha_planificada_inicio, CAST(o_orderdate AS DATE) + 30 AS fecha_planificada_fin,
         CAST(o_orderdate AS DATE) + 1 AS fecha_real_inicio,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 45 END AS fecha_real_fin
  FROM orders),
f AS (SELECT * REPLACE (id_proyecto || id_tablero AS id_proyecto) FROM m
      WHERE nombre_hito IS NULL OR nombre_hito NOT IN ({', '.join("'" + k + "'" for k in projects.KEEP_OUT)}))
SELECT id_proyecto, id_tablero, id_hito, nombre_hito, nombre_lider_hito, gerencia_hito, is_finalizado,
       fecha_planificada_inicio, fecha_planificada_fin, fecha_real_inicio, fecha_real_fin FROM f
UNION ALL
SELECT id_proyecto, arg_min(id_tablero, id_hito), CAST(NULL AS VARCHAR), '{projects.SUMMARY_LABEL}', CAST(NULL AS VARCHAR),
       CAST(NULL AS VARCHAR), NOT bool_or(coalesce(is_finalizado = false, false)), min(fecha_planificada_inicio),
       max(fecha_planificada_fin), min(fecha_real_inicio), max(fecha_real_fin)
FROM f WHERE id_proyecto IS NOT NULL GROUP BY id_proyecto
"""


@register("project_milestones", MILESTONE_SQL)
def project_milestones_q(spark, d):
    """B37 through ``plans.projects.project_milestones``: orders as milestones of (customer, board)
    projects; 'Cabecera' milestones dropped (null names kept); one summary row per project."""
    o = Tables(spark, d).orders
    day = F.to_date("o_orderdate")
    ms = o.select(
        F.col("o_custkey").cast("string").alias("id_proyecto"),
        F.concat(F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("id_tablero"),
        F.col("o_orderkey").cast("string").alias("id_hito"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Cabecera").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", None)
        .otherwise(F.col("o_orderpriority")).alias("nombre_hito"),
        F.concat(F.lit("lider-"), F.col("o_orderstatus")).alias("nombre_lider_hito"),
        F.col("o_orderstatus").alias("gerencia_hito"),
        F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("is_finalizado"),
        day.alias("fecha_planificada_inicio"), F.date_add(day, 30).alias("fecha_planificada_fin"),
        F.date_add(day, 1).alias("fecha_real_inicio"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(day, 45)).alias("fecha_real_fin"))
    return projects.project_milestones(ms)


@register("attendance", """
WITH a AS (
  SELECT event_id, user_id AS reuid, CAST(ts AS DATE) AS reufecini,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS asiasis,
         event_type || CASE WHEN value > 45 THEN ' SUSPENDIDA' ELSE ' ok' END AS reunom,
         CASE WHEN value > 25 THEN 1 ELSE 2 END AS sexo,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
  FROM events),
d AS (SELECT reuid, year, min(reufecini) AS d0 FROM a WHERE reufecini IS NOT NULL GROUP BY reuid, year HAVING min(reufecini) < max(reufecini))
SELECT event_id, reuid, reufecini, asiasis, reunom, sexo, year, month,
       CASE WHEN asiasis = 1 THEN 'SI' ELSE 'NO' END AS str_asistencia,
       CAST(year AS VARCHAR) || CAST(month AS VARCHAR) AS periodo,
       CASE WHEN regexp_matches(lower(reunom), 'cancelada|eliminada|pospuesta|reagendada|suspendida|postergada|cancelado|eliminado|pospuesto|reagendado|suspendido|postergado')
            THEN false ELSE true END AS is_nombre_valido
FROM a WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.reuid = a.reuid AND d.year = a.year AND d.d0 = a.reufecini)
""")
def attendance_q(spark, d):
    """B34 through ``plans.membership.attendance``: events as meeting attendance (user = meeting,
    day = meeting date); earliest date of meetings held on several dates dropped; cancelled-word
    flag; attendance text; period text."""
    ev = Tables(spark, d).events
    a = ev.select("event_id", F.col("user_id").alias("reuid"), F.to_date("ts").alias("reufecini"),
                  F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("asiasis"),
                  F.concat(F.col("event_type"), F.when(F.col("value") > 45, " SUSPENDIDA").otherwise(" ok")).alias("reunom"),
                  F.when(F.col("value") > 25, 1).otherwise(2).alias("sexo"),
                  F.year("ts").alias("year"), F.month("ts").alias("month"))
    return membership.attendance(a)


@register("meter_batches", """
WITH k AS (SELECT DISTINCT 'M' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS k FROM lineitem
           WHERE l_linenumber <> 1 AND l_returnflag = 'N'),
i AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM k),
g AS (SELECT CAST(floor(i / 30) AS BIGINT) AS grupo, CAST(count(*) AS BIGINT) AS n_keys,
             string_agg('''' || k || '''', ', ' ORDER BY k) AS items FROM i GROUP BY 1)
SELECT grupo, n_keys, '(' || items || ');grupo' || CAST(grupo AS VARCHAR) AS linea FROM g
""")
def meter_batches_q(spark, d):
    """B9 through ``plans.energy.meter_batches``: line items as meter readings (part as meter,
    line number as interval count, flag N as active); groups of 30 meters as text lines."""
    li = Tables(spark, d).lineitem
    readings = li.select(F.concat(F.lit("M"), F.lpad(F.col("l_partkey").cast("string"), 6, "0")).alias("NOINS"),
                         F.col("l_linenumber").alias("NOINTERVALS"),
                         F.when(F.col("l_returnflag") == "N", 1).otherwise(0).alias("IS_ACTIVE"))
    return energy.meter_batches(readings)


PROJECT_CODE_SQL = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'FRN' WHEN '2-HIGH' THEN 'FR' WHEN '3-MEDIUM' THEN 'FN' "
                    "ELSE 'X' END || CAST(o_orderkey AS VARCHAR)")


@register("financial_summary", f"""
WITH l AS (
  SELECT 'C' || substr(o_orderpriority, 1, 1) AS codigo_sap, o_orderstatus AS accountcode, {PROJECT_CODE_SQL} AS projectcode,
         o_orderdate AS postingdate, o_totalprice AS debit_lc, CAST(0 AS DOUBLE) AS credit_lc, CAST(0 AS DOUBLE) AS debit_sc,
         CAST(0 AS DOUBLE) AS credit_sc, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders),
codes AS (SELECT upper(r_name) AS camara, 'C' || CAST(r_regionkey AS VARCHAR) AS code FROM region),
tim AS (SELECT DISTINCT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS BIGINT) AS id,
               CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority <> '5-LOW'),
acc AS (SELECT DISTINCT o_orderstatus AS codigo FROM orders WHERE o_orderstatus <> 'P'),
ch AS (SELECT r_regionkey AS id, upper(r_name) AS descripcion FROM region),
cur AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS fecha FROM lineitem),
com AS (SELECT n_nationkey AS id, 'C' || CAST(n_nationkey AS VARCHAR) AS codigo_sap FROM nation)
SELECT l.accountcode AS id, t.id AS id_fecha, coalesce(ch.id, 99999999) AS id_camara,
       coalesce(acc.codigo, '99999999') AS id_cuenta_sap, coalesce(com.id, 99999999) AS id_comite,
       l.debit_lc, l.credit_lc, l.credit_sc, l.debit_sc,
       0 AS debit_lc_uf, 0 AS credit_lc_uf, 0 AS credit_sc_uf, 0 AS debit_sc_uf,
       0 AS debit_lc_usd, 0 AS credit_lc_usd, 0 AS debit_sc_usd, 0 AS credit_sc_usd,
       TIMESTAMP '{AS_OF_ORDERS} 00:00:00' AS fecha_creacion, TIMESTAMP '{AS_OF_ORDERS} 00:00:00' AS fecha_actualizacion,
       CASE WHEN starts_with(l.projectcode, 'FRN') THEN 'Fondo Regional/Proyecto impacto'
            WHEN starts_with(l.projectcode, 'FN') THEN 'Proyecto impacto'
            WHEN starts_with(l.projectcode, 'FR') THEN 'Fondo Regional' END AS is_project,
       l.year
FROM l LEFT JOIN codes c ON c.code = l.codigo_sap
LEFT JOIN tim t ON t.d = CAST(l.postingdate AS DATE)
LEFT JOIN acc ON acc.codigo = l.accountcode
LEFT JOIN ch ON ch.descripcion = c.camara
LEFT JOIN cur ON cur.fecha = CAST(l.postingdate AS DATE)
LEFT JOIN com ON com.codigo_sap = l.codigo_sap
""")
def financial_summary_q(spark, d):
    """B26 through ``plans.finance.financial_summary``: orders as ledger lines (priority as chamber
    code, status as account, priority-based project codes); regions as chambers (one code without a
    chamber), order dates as the time dimension (low-priority-only dates missing), ship dates as
    currency dates, nations as committees; unknown members become 99999999."""
    t = Tables(spark, d)
    o = t.orders
    pc = F.concat(F.when(F.col("o_orderpriority") == "1-URGENT", "FRN").when(F.col("o_orderpriority") == "2-HIGH", "FR")
                  .when(F.col("o_orderpriority") == "3-MEDIUM", "FN").otherwise("X"), F.col("o_orderkey").cast("string"))
    ledger = o.select(F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("distributionrulecode1"),
                      F.col("o_orderstatus").alias("accountcode"), pc.alias("projectcode"),
                      F.col("o_orderdate").alias("postingdate"), F.col("o_totalprice").alias("debit_lc"),
                      F.lit(0.0).alias("credit_lc"), F.lit(0.0).alias("debit_sc"), F.lit(0.0).alias("credit_sc"),
                      F.year("o_orderdate").alias("year"))
    accounts = o.select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("codigo")).distinct()
    chambers = t.region.select(F.col("r_regionkey").alias("id"), F.upper("r_name").alias("descripcion"))
    day = F.to_date("o_orderdate")
    time = o.select((F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint").alias("id"),
                    F.when(F.col("o_orderpriority") != "5-LOW", day).alias("date")).distinct()
    currency = t.lineitem.select(F.to_date("l_shipdate").alias("fecha")).distinct().select(
        "fecha", F.lit(1.0).alias("uf"), F.lit(2.0).alias("dolar"))
    committees = t.nation.select(F.col("n_nationkey").alias("id"),
                                 F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("codigo_sap"))
    codes = t.region.select(F.col("r_name").alias("camara"),
                            F.concat(F.lit("C"), F.col("r_regionkey").cast("string")).alias("id_camara_sap"))
    return finance.financial_summary(ledger, accounts, chambers, time, currency, committees, codes, AS_OF_ORDERS)


def _sql_case(col: str, pairs, default: str = "NULL") -> str:
    def q(v):
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "CASE " + " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in pairs) + f" ELSE {default} END"


_AGE_CASE = ("CASE WHEN edad <= 30 THEN 'Menor a 30' WHEN edad > 30 AND edad <= 40 THEN 'Entre 31 y 40' "
             "WHEN edad > 40 AND edad <= 50 THEN 'Entre 41 y 50' WHEN edad > 50 AND edad <= 60 THEN 'Entre 51 y 60' "
             "ELSE 'Mayor a 60' END")


@register("workers", f"""
WITH t AS (
  SELECT o.o_orderkey AS id, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS fecha_registro,
         CAST(o.o_custkey AS VARCHAR) AS num_documento, lower(substr(c.c_mktsegment, 1, 1)) AS digito_verificador,
         replace(lower(o.o_orderpriority), 'specified', 'Specified') AS ocupacion,
         {_sql_case('o.o_orderstatus', [('F', EXPERIENCE_ORDER[0]), ('O', EXPERIENCE_ORDER[3])])} AS rango_experiencia,
         n.n_name AS region, CASE WHEN c.c_acctbal < 1000 THEN NULL ELSE 'Ñ' || substr(n.n_name, 2) END AS comuna,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(floor(c.c_acctbal / 100) AS INTEGER) END AS edad,
         substr(c.c_mktsegment, 1, 1) AS sexo
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
ofi AS (SELECT DISTINCT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '' ELSE 'x ' END || replace(lower(o_orderpriority), 'specified', 'Specified') AS oficio FROM orders),
esp AS (SELECT DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN 'x ' ELSE '' END || replace(lower(o_orderpriority), 'specified', 'Specified') AS ocupacion,
               'Esp ' || o_orderpriority AS especialidad FROM orders),
ces AS (SELECT CASE WHEN c_acctbal < 0 THEN '' ELSE 'x' END || CAST(c_custkey AS VARCHAR) || upper(substr(c_mktsegment, 1, 1)) AS rut, 'Si' AS fundacion_social
        FROM customer),
geo AS (SELECT DISTINCT CAST(n_regionkey AS BIGINT) AS id_camara_regional, lower(n_name) AS c FROM nation),
j AS (
  SELECT t.*, t.num_documento || t.digito_verificador AS rut, ofi.oficio,
         coalesce(esp.especialidad, 'Sin Información') AS especialidad, coalesce(ces.fundacion_social, 'No') AS fundacion_social,
         {_sql_case('t.rango_experiencia', [(lab, i + 1) for i, lab in enumerate(EXPERIENCE_ORDER)])} AS OrdenRangoExperiencia,
         {_AGE_CASE} AS tramo_de_edad,
         CASE WHEN sexo = 'M' THEN 'Mujeres' WHEN sexo = 'H' THEN 'Hombres' ELSE 'Sin Información' END AS genero
  FROM t LEFT JOIN ofi ON ofi.oficio = t.ocupacion LEFT JOIN esp ON esp.ocupacion = t.ocupacion
  LEFT JOIN ces ON ces.rut = t.num_documento || upper(t.digito_verificador)),
k AS (
  SELECT * REPLACE (CAST(fecha_registro AS DATE) AS fecha_registro),
         {_sql_case('tramo_de_edad', [(lab, i + 1) for i, lab in enumerate(AGE_LABELS)])} AS OrdenTramoEdad,
         concat_ws('', rut, ocupacion) AS clave_combinada, concat_ws('', rut, rango_experiencia) AS experiencia_combinada,
         concat_ws('', rut, oficio) AS oficio_combinada, concat_ws('', rut, especialidad) AS especialidades_combinada,
         CASE WHEN geo.id_camara_regional = 1 THEN 'Santiago' WHEN geo.id_camara_regional <> 1 THEN 'Regiones' ELSE 'Sin información' END AS santiago_region,
         row_number() OVER (PARTITION BY rut, ocupacion ORDER BY CAST(fecha_registro AS DATE), id) AS rn
  FROM j LEFT JOIN geo ON geo.c = 'n' || substr(lower(strip_accents(j.comuna)), 2))
SELECT * EXCLUDE (rn, c) FROM k WHERE rn = 1
""")
def workers_q(spark, d):
    """B20 through ``plans.employment.workers``: orders as worker registrations (customer as person,
    priority as occupation, status as experience); trade and speciality lookups, unemployed list on an
    expression key, brackets, ordinals, composite keys, the regional chamber by accent-folded municipality, first registration
    per (rut, occupation)."""
    t = Tables(spark, d)
    o, c = t.orders, t.customer
    exp = F.when(F.col("o_orderstatus") == "F", EXPERIENCE_ORDER[0]).when(F.col("o_orderstatus") == "O", EXPERIENCE_ORDER[3])
    trab = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").cast("string").alias("fecha_registro"),
                    F.col("o_custkey").cast("string").alias("num_documento"),
                    F.lower(F.substring("c_mktsegment", 1, 1)).alias("digito_verificador"),
                    F.col("o_orderpriority").alias("ocupacion"), exp.alias("rango_experiencia"),
                    F.col("n_name").alias("region"),
                    F.when(F.col("c_acctbal") >= 1000, F.concat(F.lit("Ñ"), F.expr("substr(n_name, 2)"))).alias("comuna"),
                    F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.floor(F.col("c_acctbal") / 100).cast("int")).alias("edad"),
                    F.substring("c_mktsegment", 1, 1).alias("sexo")))
    known = lambda hit, mark: F.when(hit, "").otherwise(mark)  # noqa: E731  entries of a lookup that no row matches
    oficios = o.select(F.concat(known(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "x "), F.initcap("o_orderpriority")).alias("oficio")).distinct()
    esp = o.select(F.concat(known(F.col("o_orderpriority") != "5-LOW", "x "), F.initcap("o_orderpriority")).alias("ocupacion"),
                   F.concat(F.lit("Esp "), F.col("o_orderpriority")).alias("especialidad")).distinct()
    ces = c.select(F.concat(known(F.col("c_acctbal") < 0, "x"), F.col("c_custkey").cast("string"), F.upper(F.substring("c_mktsegment", 1, 1))).alias("rut"),
                   F.lit("Si").alias("fundacion_social"))
    geography = t.nation.select(F.col("n_regionkey").alias("id_geo"), F.col("n_name").alias("comuna"))
    return employment.workers(trab, oficios, esp, ces, tie_break="id", geography=geography)


@register("first_version_cost", """
WITH p AS (
  SELECT l.l_orderkey AS id, CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS date, l.l_suppkey AS key_id,
         l.l_extendedprice AS value, l.l_linenumber AS reported_time_id, l.l_partkey AS audit_id, l.l_quantity AS q
  FROM lineitem l),
k AS (SELECT s_suppkey AS key_id, 92 AS key_type_id, s_name AS name FROM supplier WHERE s_acctbal > 0),
j AS (SELECT p.*, k.key_type_id, row_number() OVER (PARTITION BY p.date, k.name, p.reported_time_id
                                                    ORDER BY p.audit_id, p.id, p.value, p.q) AS rn
      FROM p JOIN k ON p.key_id = k.key_id
      WHERE p.audit_id IS NOT NULL AND k.name IS NOT NULL AND p.reported_time_id IS NOT NULL AND p.date IS NOT NULL)
SELECT key_id AS "ID_BARRA", key_type_id AS "ID_CONCEPTO_UNIDAD", reported_time_id AS "ID_TIEMPO",
       value AS "V_COSTOMARGINALPROGRAMADO", date AS "FECHA_REPORTE"
FROM j WHERE rn = 1
""")
def first_version_cost_q(spark, d):
    """B3 through ``plans.energy.programmed_marginal_cost``: line items as programmed values (supplier
    as key, line number as reported time, part key as audit id, ship date as report date), keys of one type
    (suppliers with a positive balance), the smallest audit per (date, key name, time)."""
    t = Tables(spark, d)
    prog = t.lineitem.select(F.col("l_orderkey").alias("id"), F.to_date("l_shipdate").cast("string").alias("date"),
                             F.col("l_suppkey").alias("key_id"), F.col("l_extendedprice").alias("value"),
                             F.col("l_linenumber").alias("reported_time_id"), F.col("l_partkey").alias("audit_id"),
                             F.col("l_quantity").alias("q"))
    keys = t.supplier.select(F.col("s_suppkey").alias("id"),
                             F.when(F.col("s_acctbal") > 0, 92).otherwise(1).alias("key_type_id"),
                             F.col("s_name").alias("name"))
    return energy.programmed_marginal_cost(prog, keys, tie_break=["id", "value", "q"])


@register("penalty_scorers", """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS scorer, l_linestatus AS team, CAST(count(l_shipdate) AS BIGINT) AS date
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2
""")
def penalty_scorers_q(spark, d):
    """B40 through ``plans.sport.penalty_scorers``: returned lines as penalty goals per supplier
    and line status (the team), all of them."""
    li = Tables(spark, d).lineitem
    goals = li.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("scorer"), F.col("l_linestatus").alias("team"), F.col("l_shipdate").alias("date"),
                      (F.col("l_returnflag") == "R").alias("penalty"))
    return sport.penalty_scorers(goals)


_REGION_NAME_SQL = "CASE r_regionkey WHEN 0 THEN 'MIGRACION' WHEN 1 THEN 'Bío Bío' WHEN 2 THEN 'Maule' WHEN 3 THEN 'Ñuble' ELSE r_name END"
_FOLD_SQL = "regexp_replace(strip_accents(lower({0})), '[^\\x00-\\x7F]', '', 'g')"


@register("education_levels", f"""
WITH per AS (
  SELECT c.c_custkey AS id, concat_ws('', CAST(c.c_custkey AS VARCHAR), nullif(substr(c.c_mktsegment, 1, 1), 'H')) AS rut,
         n.n_regionkey AS id_region, CASE WHEN c.c_acctbal > 0 THEN c.c_nationkey END AS id_comuna
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
m AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
cu AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
su AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1),
reg AS (SELECT r_regionkey AS id, {_REGION_NAME_SQL} AS nombre FROM region),
com AS (SELECT n_nationkey AS id, n_name || ' Sur' AS nombre FROM nation),
g AS (
  SELECT p.rut, reg.nombre AS region, com.nombre AS comuna, sum(coalesce(m.n, 0)) AS ed_media,
         sum(coalesce(cu.n, 0)) AS cursos, sum(coalesce(su.n, 0)) AS ed_superior
  FROM per p LEFT JOIN m ON m.k = p.id LEFT JOIN cu ON cu.k = p.id LEFT JOIN su ON su.k = p.id
  LEFT JOIN reg ON reg.id = p.id_region LEFT JOIN com ON com.id = p.id_comuna
  GROUP BY 1, 2, 3
  HAVING sum(coalesce(m.n, 0)) > 0 OR sum(coalesce(cu.n, 0)) > 0 OR sum(coalesce(su.n, 0)) > 0),
geo AS (SELECT upper(n.n_name) || ' SUR' AS comuna, r.r_name AS region
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey <> 7)
SELECT rut, {_sql_case('region', list(REGION_NAMES.items()))} AS region, comuna,
       ed_media > 0 AS tiene_ed_media, cursos > 0 AS tiene_cursos, ed_superior > 0 AS tiene_ed_superior
FROM g WHERE comuna IS NULL AND (region IS NULL OR region <> 'MIGRACION')
UNION ALL
SELECT g.rut, geo.region, g.comuna, g.ed_media > 0, g.cursos > 0, g.ed_superior > 0
FROM g LEFT JOIN geo ON {_FOLD_SQL.format('geo.comuna')} = {_FOLD_SQL.format('g.comuna')}
WHERE g.comuna IS NOT NULL
""")
def education_levels_q(spark, d):
    """B14 through ``plans.employment.education_levels``: customers as people (check letter missing for
    one segment, no municipality when the balance is not positive), urgent orders, finished orders and
    events as the three education branches, regions with names from the fixed map (one region
    'MIGRACION'), nations as municipalities matched accent- and case-insensitively to a geography."""
    t = Tables(spark, d)
    per = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("ID"), F.col("c_custkey").cast("string").alias("NUM_DOCUMENTO"),
        F.nullif(F.substring("c_mktsegment", 1, 1), F.lit("H")).alias("DIGITO_VERIFICADOR"),
        F.col("n_regionkey").alias("ID_REGION"),
        F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("ID_COMUNA"))
    media = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("ID_PERSONA"))
    cursos = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("ID_PERSONA"))
    superior = t.events.select(F.col("user_id").alias("ID_PERSONA"))
    rk = F.col("r_regionkey")
    regiones = t.region.select(rk.alias("ID"), F.when(rk == 0, "MIGRACION").when(rk == 1, "Bío Bío").when(rk == 2, "Maule")
                               .when(rk == 3, "Ñuble").otherwise(F.col("r_name")).alias("NOMBRE"))
    comunas = t.nation.select(F.col("n_nationkey").alias("ID"), F.concat(F.col("n_name"), F.lit(" Sur")).alias("NOMBRE"))
    geo = (t.nation.where(F.col("n_nationkey") != 7).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.concat(F.upper("n_name"), F.lit(" SUR")).alias("comuna"), F.col("r_name").alias("region")))
    out = employment.education_levels(per, media, cursos, superior, regiones, comunas, geo)
    return out.select("rut", "region", "comuna", "tiene_ed_media", "tiene_cursos", "tiene_ed_superior")


_BRACKET_EDGES = [10, 25, 50, 100, 250, 500, 1000, 2000, 10000]


def _bracket_sql(col: str) -> str:
    parts, low = [], 0
    for i, e in enumerate(_BRACKET_EDGES, start=1):
        parts.append(f"WHEN {col} > {low} AND {col} <= {e} THEN {i}")
        low = e
    return "CASE " + " ".join(parts) + f" WHEN {col} > {low} THEN {len(_BRACKET_EDGES) + 1} END"


def _values_sql(rows, cols, alias):
    body = ", ".join("(" + ", ".join(("'" + v.replace("'", "''") + "'") if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"


_SUBSECTOR_SQL = ("CASE c.c_mktsegment WHEN 'BUILDING' THEN 'CONSTRUCCION DE EDIFICIOS' "
                  "WHEN 'MACHINERY' THEN 'DEMOLICION Y PREPARACION DEL TERRENO' ELSE c.c_mktsegment END")


@register("registry_members", f"""
WITH members AS (SELECT lower(c_name) AS rut FROM customer UNION ALL SELECT lower(s_name) FROM supplier),
reg AS (
  SELECT lower(s_name) AS rut, s_name || ' Manual' AS razon_social FROM supplier
  UNION ALL BY NAME
  SELECT lower(c.c_name) AS rut, c.c_name || ' SA' AS razon_social,
         CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c.c_mktsegment END AS rubro_economico,
         {_SUBSECTOR_SQL} AS subrubro_economico, 'PJ' AS tipo_de_contribuyente,
         CASE WHEN c.c_acctbal > 5000 THEN 'Grande' END AS tramo_de_facturacion_txt, n.n_name AS tamano_de_empresa,
         CASE WHEN c.c_acctbal > 0 THEN 'T' || CAST(c.c_nationkey AS VARCHAR) END AS tramo_trabajadores,
         {_bracket_sql('c.c_acctbal')} AS tramo_capital_propio_positivo
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_nationkey <> 5),
ins AS (SELECT DISTINCT lower(c.c_name) AS rut FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderstatus = 'P' AND o.o_totalprice > 300000),
comp AS (SELECT lower(c.c_name) AS rut, 'ACTIVO' AS estado, n.n_name AS camara_casa_matriz, true AS socio
         FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_acctbal > 0)
SELECT m.rut, r.razon_social, g.grupo_caenes, coalesce(r.rubro_economico, 'Valor por Defecto') AS rubro_economico,
       coalesce(r.subrubro_economico, 'Valor por Defecto') AS subrubro_economico, r.tipo_de_contribuyente,
       coalesce(r.tramo_de_facturacion_txt, 'No Informado') AS tramo_de_facturacion_txt, r.tamano_de_empresa,
       coalesce(r.tramo_trabajadores, 'Sin Información') AS tramo_trabajadores,
       coalesce(b.txt, 'Sin Información') AS tramo_capital_propio_txt, coalesce(cp.socio, false) AS socio,
       cp.estado, cp.camara_casa_matriz, i.rut IS NOT NULL AS insolvente, CAST(2021 AS INTEGER) AS commercial_year
FROM members m LEFT JOIN reg r ON r.rut = m.rut LEFT JOIN ins i ON i.rut = m.rut LEFT JOIN comp cp ON cp.rut = m.rut
LEFT JOIN {_values_sql([(k, v) for k, vs in CONSTRUCTION_GROUPS.items() for v in vs], ['grupo_caenes', 'sub'], 'g')}
  ON g.sub = r.subrubro_economico
LEFT JOIN {_values_sql(CAPITAL_BRACKETS, ['n', 'txt'], 'b')} ON b.n = r.tramo_capital_propio_positivo
""")
def registry_members_q(spark, d):
    """B23 through ``plans.membership.member_registry``: customers and
    suppliers as members; customers (one nation missing) as the yearly registry plus suppliers as
    manual rows; large pending orders as insolvencies; customers with a positive balance as companies."""
    t = Tables(spark, d)
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    members = t.customer.select(F.col("c_name").alias("rut")).unionByName(t.supplier.select(F.col("s_name").alias("rut")))
    bal = F.col("c_acctbal")
    rules, low = [], 0
    for i, e in enumerate(_BRACKET_EDGES, start=1):
        rules.append(((bal > low) & (bal <= e), i))
        low = e
    rules.append((bal > low, len(_BRACKET_EDGES) + 1))
    seg = F.col("c_mktsegment")
    registry = c.select(
        F.when(F.col("c_nationkey") != 5, F.col("c_name")).alias("rut"), F.concat(F.col("c_name"), F.lit(" SA")).alias("razon_social"),
        F.when(seg == "HOUSEHOLD", F.lit(None)).otherwise(seg).alias("rubro_economico"),
        F.when(seg == "BUILDING", "CONSTRUCCION DE EDIFICIOS").when(seg == "MACHINERY", "DEMOLICION Y PREPARACION DEL TERRENO")
        .otherwise(seg).alias("subrubro_economico"),
        F.lit("PJ").alias("tipo_de_contribuyente"),
        F.when(bal > 5000, "Grande").alias("tramo_de_facturacion_txt"), F.col("n_name").alias("tamano_de_empresa"),
        F.when(bal > 0, F.concat(F.lit("T"), F.col("c_nationkey").cast("string"))).alias("tramo_trabajadores"),
        first_rule(rules, F.lit(None).cast("int")).alias("tramo_capital_propio_positivo"))
    manual = t.supplier.select(F.col("s_name").alias("rut"), F.concat(F.col("s_name"), F.lit(" Manual")).alias("razon_social"))
    ins = (t.orders.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000))
           .join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("rut")))
    comp = c.where(bal > 0).select(F.col("c_name").alias("rut"), F.lit("ACTIVO").alias("estado"),
                                   F.col("n_name").alias("camara_casa_matriz"))
    return membership.member_registry(members, registry, manual, ins, comp, 2021)


# The employment exchange's user -> location -> company -> sector chain, mapped onto the driver
# tables: customers are users (and their location is their nation), nations relate to companies
# (regions), regions belong to sector 1 or 2, orders are CV downloads (priority digit as list id,
# none for pending orders), line items are download details (part as the person), parts carry an
# occupation (size), regions are the companies' state and exclusion lists.
_CHAIN_SQL = """
users AS (SELECT c_custkey AS id_usuario, c_name AS nom_usuario, c_nationkey AS id_ubic_rel FROM customer),
relac AS (SELECT n_nationkey AS id, n_regionkey AS id_empresario FROM nation),
emp AS (SELECT r_regionkey AS id, r_name AS rut, CASE WHEN r_regionkey <> 1 THEN r_regionkey END AS id_comuna,
               r_regionkey AS id_region FROM region),
sec AS (SELECT r_regionkey AS id_empresario, CASE WHEN r_regionkey < 3 THEN 1 ELSE 2 END AS id_sector FROM region),
cu AS (SELECT u.id_usuario, u.nom_usuario, e.rut, e.id_comuna, e.id_region
       FROM users u JOIN relac c ON c.id = u.id_ubic_rel JOIN emp e ON e.id = c.id_empresario
       JOIN sec s ON s.id_empresario = e.id WHERE s.id_sector = 1),
dl AS (SELECT o_orderkey AS id, o_custkey AS id_emp_usuario,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS id_lista,
              CAST(floor(o_totalprice / 100000) AS INTEGER) AS num_cv, o_orderdate AS fec_alta FROM orders)
"""


def _exchange_tables(t):
    c, n, r, o = t.customer, t.nation, t.region, t.orders
    rk = F.col("r_regionkey")
    return dict(
        users=c.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("NOM_USUARIO"), F.col("c_name").alias("RUT")),
        ubicac=c.select(F.col("c_custkey").alias("ID_EMPRESARIO_USUARIOS"), F.col("c_nationkey").cast("bigint").alias("ID_UBIC_REL")),
        relac=n.select(F.col("n_nationkey").cast("bigint").alias("ID"), F.col("n_regionkey").cast("bigint").alias("ID_EMPRESARIO")),
        empresario=r.select(rk.cast("bigint").alias("ID"), F.col("r_name").alias("RUT"),
                            F.when(rk != 1, rk).cast("bigint").alias("ID_COMUNA"), rk.cast("bigint").alias("ID_REGION")),
        sectores=r.select(rk.cast("bigint").alias("ID_EMPRESARIO"), F.when(rk < 3, 1).otherwise(2).alias("ID_SECTOR")),
        downloads=o.select(F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("ID_EMP_USUARIO"),
                           F.when(F.col("o_orderstatus") == "P", F.lit(None))
                           .otherwise(F.substring("o_orderpriority", 1, 1).cast("bigint")).alias("ID_LISTA"),
                           F.floor(F.col("o_totalprice") / 100000).cast("int").alias("NUM_CV"),
                           F.col("o_orderdate").alias("FEC_ALTA")),
    )


@register("downloads_by_day_place", f"""
WITH {_CHAIN_SQL},
com AS (SELECT r_regionkey AS id, 'Comuna ' || r_name AS nombre FROM region),
reg AS (SELECT r_regionkey AS id, r_name AS nombre FROM region),
det AS (SELECT l_orderkey AS id_descarga_cv, l_partkey AS id_persona FROM lineitem WHERE l_returnflag = 'R'),
per AS (SELECT p_partkey AS id FROM part WHERE p_size <= 45),
po AS (SELECT p_partkey AS id_persona, CAST(p_size AS BIGINT) AS id_ocupacion FROM part WHERE p_type <> 'SMALL'),
oc AS (SELECT DISTINCT CAST(p_size AS BIGINT) AS id, 'Oficio ' || CAST(p_size AS VARCHAR) AS descripcion FROM part
       WHERE p_size <= 40)
SELECT CAST(strftime(f.fec_alta, '%Y-%m-%d') AS DATE) AS fecha_alta, com.nombre AS comuna, reg.nombre AS region,
       oc.descripcion AS ocupacion, CAST(count(*) AS BIGINT) AS total
FROM cu JOIN dl f ON f.id_emp_usuario = cu.id_usuario
LEFT JOIN com ON com.id = cu.id_comuna LEFT JOIN reg ON reg.id = cu.id_region
LEFT JOIN det ON det.id_descarga_cv = f.id LEFT JOIN per ON per.id = det.id_persona
LEFT JOIN po ON po.id_persona = per.id LEFT JOIN oc ON oc.id = po.id_ocupacion
GROUP BY 1, 2, 3, 4
""")
def downloads_by_day_place_q(spark, d):
    """B13 through ``plans.employment.downloads_by_day_place``: downloads of sector-1 company users by
    day, municipality, region and the occupation of the downloaded people (returned lines as details)."""
    t = Tables(spark, d)
    b = _exchange_tables(t)
    r, p = t.region, t.part
    comunas = r.select(F.col("r_regionkey").cast("bigint").alias("ID"), F.concat(F.lit("Comuna "), F.col("r_name")).alias("NOMBRE"))
    regiones = r.select(F.col("r_regionkey").cast("bigint").alias("ID"), F.col("r_name").alias("NOMBRE"))
    det = t.lineitem.select(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("ID_DESCARGA_CV"), F.col("l_partkey").alias("ID_PERSONA"))
    per = p.select(F.when(F.col("p_size") <= 45, F.col("p_partkey")).alias("ID"))
    po = p.select(F.when(F.col("p_type") != "SMALL", F.col("p_partkey")).alias("ID_PERSONA"), F.col("p_size").cast("bigint").alias("ID_OCUPACION"))
    oc = p.select(F.when(F.col("p_size") <= 40, F.col("p_size")).cast("bigint").alias("ID"),
                                               F.concat(F.lit("Oficio "), F.col("p_size").cast("string")).alias("DESCRIPCION")).distinct()
    return employment.downloads_by_day_place(b["users"], b["ubicac"], b["relac"], b["empresario"], b["sectores"],
                                             b["downloads"], comunas, regiones, det, per, po, oc)


@register("company_user_activity", f"""
WITH {_CHAIN_SQL},
g AS (SELECT cu.rut AS "RUT", cu.id_usuario, cu.nom_usuario, CAST(strptime(strftime(f.fec_alta, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS "FECHA_ALTA",
             f.id_lista AS "ID_LISTA", CAST(count(*) AS BIGINT) AS total, CAST(sum(f.num_cv) AS BIGINT) AS descarga
      FROM cu JOIN dl f ON f.id_emp_usuario = cu.id_usuario
      GROUP BY 1, 2, 3, 4, 5),
exc AS (SELECT r_name AS rut FROM region WHERE r_regionkey = 2)
SELECT g."RUT", g.id_usuario, g.nom_usuario, g."FECHA_ALTA", CAST(date_trunc('month', g."FECHA_ALTA") AS DATE) AS "FECHA_ALTA_MES",
       g."ID_LISTA", g.total AS "VISTAS_CV", CASE WHEN g."ID_LISTA" IS NULL THEN g.total - g.descarga ELSE g.descarga END AS "DESCARGA_CV"
FROM g WHERE g."RUT" NOT IN (SELECT rut FROM exc)
""")
def company_user_activity_q(spark, d):
    """B16 through ``plans.employment.company_user_activity``: views and downloaded CVs per company
    user, day and list; one company excluded; where there is no list, downloads = views - CVs."""
    t = Tables(spark, d)
    b = _exchange_tables(t)
    rk = F.col("r_regionkey")
    empresas = t.region.select(F.col("r_name").alias("RUT"), F.when(rk != 0, 1).otherwise(0).alias("ESTADO"))
    excluded = t.region.where(rk == 2).select(F.col("r_name").alias("rut"))
    out = employment.company_user_activity(b["users"], b["ubicac"], b["relac"], b["empresario"], b["sectores"],
                                           b["downloads"], empresas, excluded)
    return out.withColumn("DESCARGA_CV", F.col("DESCARGA_CV").cast("bigint"))


@register("list_usage", f"""
WITH {_CHAIN_SQL.replace("WHERE s.id_sector = 1", "")},
lists AS (SELECT o_orderkey AS id, o_custkey AS id_emp_usuario FROM orders),
f AS (SELECT l_orderkey AS id_lista, CAST(l_quantity AS INTEGER) AS num_cv FROM lineitem),
inv AS (SELECT l_orderkey AS id_lista FROM lineitem WHERE l_returnflag = 'R')
SELECT cu.rut AS "RUT", aa.id AS lista, g.numero AS persona_lista, cu.nom_usuario AS "NOM_USUARIO", cu.id_usuario,
       CAST(COALESCE(SUM(COALESCE(f.num_cv, 0)), 0) AS BIGINT) AS numero_cv_descargados
FROM lists aa JOIN cu ON aa.id_emp_usuario = cu.id_usuario
LEFT JOIN f ON f.id_lista = aa.id
LEFT JOIN (SELECT id_lista, CAST(count(*) AS BIGINT) AS numero FROM inv GROUP BY id_lista) g ON g.id_lista = aa.id
GROUP BY cu.rut, aa.id, g.numero, cu.nom_usuario, cu.id_usuario
""")
def list_usage_q(spark, d):
    """B18 through ``plans.employment.list_usage``: orders as CV lists of their customer,
    line quantities as downloaded CVs, returned lines as invitations. The oracle joins rows and
    groups (the source form); the job sums downloads per list before joining."""
    t = Tables(spark, d)
    b = _exchange_tables(t)
    lists = t.orders.select(F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("ID_EMP_USUARIO"))
    dl = t.lineitem.select(F.col("l_orderkey").alias("ID_LISTA"), F.col("l_quantity").cast("int").alias("NUM_CV"))
    inv = t.lineitem.select(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("ID_LISTA"))
    return employment.list_usage(lists, b["users"], b["ubicac"], b["relac"], b["empresario"], b["sectores"], dl, inv)


@register("downloads_reconciliation", """
SELECT CAST(sum(v.total) AS BIGINT) AS total_vistas, (SELECT CAST(count(*) AS BIGINT) FROM customer) AS filas
FROM (SELECT n.n_name AS rut, CAST(floor(c.c_acctbal) AS BIGINT) AS total
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) v
LEFT JOIN (SELECT n_name AS rut FROM nation WHERE n_regionkey <> 0) e ON e.rut = v.rut
WHERE v.rut NOT IN (SELECT n_name FROM nation WHERE n_regionkey = 2)
""")
def downloads_reconciliation_q(spark, d):
    """B42 through ``plans.employment.downloads_reconciliation``: customers' balances as viewed CVs of
    their nation (the company); one region's companies excluded; total and row count."""
    t = Tables(spark, d)
    views = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("RUT"), F.floor("c_acctbal").cast("bigint").alias("TOTAL"))
    empresas = t.nation.select(F.col("n_name").alias("RUT"), F.when(F.col("n_regionkey") != 0, 1).otherwise(0).alias("ESTADO"))
    excluded = t.nation.where(F.col("n_regionkey") == 2).select(F.col("n_name").alias("rut"))
    return employment.downloads_reconciliation(views, empresas, excluded)


@register("insolvency_merge", f"""
WITH src AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS rut,
         CAST(o_orderkey AS VARCHAR) AS rol, o_orderdate, o_orderstatus FROM orders),
h AS (SELECT rut, rol, CAST(o_orderdate AS DATE) AS fecha_publicacion, CAST(NULL AS VARCHAR) AS fecha_ejecucion,
             CASE WHEN o_orderstatus = 'F' THEN true END AS proceso_finalizado, coalesce(rut, 'CORRECCION:' || rol) AS k
      FROM src WHERE CAST(o_orderdate AS DATE) < DATE '1998-01-01'),
s AS (SELECT rut, rol,
             CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN '31/02/' || CAST(year(o_orderdate) AS VARCHAR)
                                    ELSE strftime(o_orderdate, '%d/%m/%Y') END, '%d/%m/%Y') AS DATE) AS fecha_publicacion,
             coalesce(rut, 'CORRECCION:' || rol) AS k
      FROM src WHERE CAST(o_orderdate AS DATE) >= DATE '1997-01-01'),
open_k AS (SELECT DISTINCT k FROM h WHERE proceso_finalizado IS NULL),
fin AS (SELECT k FROM open_k WHERE k NOT IN (SELECT k FROM s)),
hu AS (SELECT rut, rol, fecha_publicacion,
              CASE WHEN rut IN (SELECT k FROM fin) THEN '{AS_OF_ORDERS}' ELSE fecha_ejecucion END AS fecha_ejecucion,
              CASE WHEN rut IN (SELECT k FROM fin) THEN true ELSE proceso_finalizado END AS proceso_finalizado FROM h),
added AS (SELECT rut, rol, fecha_publicacion, k FROM s WHERE k NOT IN (SELECT k FROM open_k)),
merged AS (SELECT rut, rol, fecha_publicacion, fecha_ejecucion, proceso_finalizado FROM hu
           UNION ALL SELECT rut, rol, fecha_publicacion, CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN) FROM added),
reg AS (SELECT CAST(c_custkey AS VARCHAR) AS rut, c_name AS razon_social,
               CASE WHEN c_acctbal > 5000 THEN 'Grande' ELSE 'Pyme' END AS tamano_de_empresa,
               c_mktsegment AS rubro_economico, 'Sub ' || c_mktsegment AS subrubro_economico, 'ACTIVO' AS estado
        FROM customer WHERE c_acctbal > 0 AND CAST(c_custkey AS VARCHAR) IN (SELECT k FROM added))
SELECT m.*, r.razon_social, r.tamano_de_empresa, r.rubro_economico, r.subrubro_economico, r.estado
FROM merged m LEFT JOIN reg r ON m.rut = r.rut
""")
def insolvency_merge_q(spark, d):
    """B22 through ``plans.projects.insolvency_merge``: orders before 1998 as the stored history,
    orders from 1997 as today's list with ``dd/MM/yyyy`` publication texts (pending orders carry an
    impossible date); registry attributes of active customers attached to the added ids."""
    t = Tables(spark, d)
    o = t.orders
    rut = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey").cast("string"))
    day = F.to_date("o_orderdate")
    history = o.where(day < F.lit("1998-01-01").cast("date")).select(
        rut.alias("rut"), F.col("o_orderkey").cast("string").alias("rol"), day.alias("fecha_publicacion"),
        F.lit(None).cast("string").alias("fecha_ejecucion"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("proceso_finalizado"))
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("31/02/"), F.year(day).cast("string"))) \
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    new = o.where(day >= F.lit("1997-01-01").cast("date")).select(
        rut.alias("rut"), F.col("o_orderkey").cast("string").alias("rol"), text.alias("fecha_publicacion"))
    bal = F.col("c_acctbal")
    registry = t.customer.select(
        F.col("c_custkey").cast("string").alias("rut"), F.col("c_name").alias("razon_social"),
        F.when(bal > 5000, "Grande").otherwise("Pyme").alias("tamano_de_empresa"),
        F.col("c_mktsegment").alias("rubro_economico"), F.concat(F.lit("Sub "), F.col("c_mktsegment")).alias("subrubro_economico"),
        F.when(bal > 0, "ACTIVO").otherwise("INACTIVO").alias("estado"), F.col("c_custkey").alias("orden"))
    return projects.insolvency_merge(history, new, registry, AS_OF_ORDERS)


@register("active_insolvencies", """
SELECT CAST(o.o_custkey AS VARCHAR) AS rut, CAST(o.o_orderkey AS VARCHAR) AS rol, CAST(o.o_orderdate AS DATE) AS fecha,
       c.c_name || ' 2' AS razon_social, 'ACTIVO' AS estado
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_orderstatus = 'P' AND c.c_acctbal > 0
""")
def active_insolvencies_q(spark, d):
    """B41 through ``plans.projects.active_insolvencies``: pending orders as insolvency rows, all of them; the registry has
    two active rows per customer with a positive balance (the later one counts) and a last inactive one."""
    t = Tables(spark, d)
    ins = t.orders.where(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").cast("string").alias("rut"), F.col("o_orderkey").cast("string").alias("rol"),
        F.to_date("o_orderdate").alias("fecha"))
    version = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("orden")
    registry = t.customer.select("*", version).select(
        F.col("c_custkey").cast("string").alias("rut"), F.concat_ws(" ", "c_name", F.col("orden").cast("string")).alias("razon_social"),
        F.when((F.col("c_acctbal") > 0) & (F.col("orden") < 3), "ACTIVO").otherwise("INACTIVO").alias("estado"), "orden")
    out = projects.active_insolvencies(ins, registry, "orden")
    return out.select("rut", "rol", "fecha", "razon_social", "estado")


PO_NAMES = ["proyecto_pedido", "total_neto", "glosa", "fecha_cont_em", "codigo_impuesto", "cantidad", "estatus_pedido"]


@register("purchase_orders", f"""
WITH li AS (
  SELECT 'P' || CAST(l_suppkey AS VARCHAR) AS proyecto_pedido,
         CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS total_neto_t,
         CASE WHEN l_linestatus = 'F' THEN 'nan' ELSE 'Glosa ' || l_linestatus END AS glosa_t,
         CASE WHEN l_returnflag = 'A' THEN '2023-02-30' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS fecha_t,
         CASE WHEN l_tax = 0 THEN 'IVA_EXE' WHEN l_tax > 0.05 THEN 'IVA' END AS codigo_impuesto,
         CAST(l_linenumber AS VARCHAR) AS cantidad_t, CASE WHEN l_returnflag = 'N' THEN l_linestatus END AS estatus_pedido
  FROM lineitem),
x AS (SELECT proyecto_pedido, TRY_CAST(total_neto_t AS DOUBLE) AS total_neto, nullif(glosa_t, 'nan') AS glosa,
             CAST(try_strptime(fecha_t, '%Y-%m-%d') AS DATE) AS fecha_cont_em, coalesce(codigo_impuesto, '_') AS codigo_impuesto,
             TRY_CAST(cantidad_t AS INTEGER) AS cantidad, estatus_pedido,
             CASE WHEN estatus_pedido = 'O' THEN 'Pedido Abierto' ELSE 'Pedido Cerrado' END AS dsc_estatus_pedido FROM li)
SELECT x.*,
       round(CASE WHEN coalesce(codigo_impuesto, '_') = 'IVA_EXE' THEN total_neto ELSE total_neto * CAST(1.19 AS DOUBLE) END, 6)
         AS total_con_impuesto,
       CAST(year(fecha_cont_em) AS INTEGER) AS fecha_cont_em_year, CAST(month(fecha_cont_em) AS INTEGER) AS fecha_cont_em_month,
       m.mes AS fecha_cont_em_mes_spa, p.proyecto
FROM x LEFT JOIN {_values_sql([(i + 1, n) for i, n in enumerate(MONTHS_ES)], ['n', 'mes'], 'm')}
  ON m.n = month(x.fecha_cont_em)
LEFT JOIN (SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS pp, s_name AS proyecto FROM supplier WHERE s_acctbal > 0) p
  ON p.pp = x.proyecto_pedido
""")
def purchase_orders_q(spark, d):
    """B25 through ``plans.finance.purchase_orders_staging``: line items as purchase-order rows with
    unnamed text columns renamed by position, amounts and counts cast (some not numbers), 'nan'
    texts, dates (some impossible), tax codes, Spanish month names, supplier projects looked up."""
    t = Tables(spark, d)
    li = t.lineitem
    raw = li.select(
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("c0"),
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("c1"),
        F.when(F.col("l_linestatus") == "F", "nan").otherwise(F.concat(F.lit("Glosa "), F.col("l_linestatus"))).alias("c2"),
        F.when(F.col("l_returnflag") == "A", "2023-02-30").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("c3"),
        F.when(F.col("l_tax") == 0, "IVA_EXE").when(F.col("l_tax") > 0.05, "IVA").alias("c4"),
        F.col("l_linenumber").cast("string").alias("c5"), F.when(F.col("l_returnflag") == "N", F.col("l_linestatus")).alias("c6"))
    projects_df = t.supplier.select(
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("P"), F.col("s_suppkey").cast("string"))).alias("proyecto_pedido"), F.col("s_name").alias("proyecto"))
    out = finance.purchase_orders_staging(spark, raw, PO_NAMES, {"double": ["total_neto"], "int": ["cantidad"]},
                                          ["fecha_cont_em"], projects_df)
    return out.withColumn("total_con_impuesto", F.round("total_con_impuesto", 6))


SHEET_CONCEPTS = [1001, 1002, 1003]
SHEET_ATTRIBUTES = ["Concepto 1", "Concepto 2", "Concepto 3", "Concepto 9"]
_WIDE_COLS = ", ".join("max(CASE WHEN conceptonombre = '%s' THEN fta_datovalortexto END) AS \"%s\"" % (a, a)
                       for a in SHEET_ATTRIBUTES)
_WIDE_SELECT = ", ".join('w."%s"' % a for a in SHEET_ATTRIBUTES)


@register("unit_configurations", f"""
WITH cfg AS (SELECT p_partkey AS id_configuracion, CAST(p_size AS BIGINT) AS id_central,
                    p_name || ' #' || CAST(p_partkey AS VARCHAR) AS configuracionnombre, p_brand AS configuracionnumero,
                    p_type AS configuracionnemotecnico, p_name AS configuraciondescripcion FROM part),
pl AS (SELECT s.s_suppkey AS id_central, s.s_name AS centralnombre, CAST(s.s_nationkey AS BIGINT) AS id_propietario,
              CAST(n.n_regionkey AS BIGINT) AS id_coordinado, CAST(s.s_nationkey AS BIGINT) AS id_centrocontrol
       FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
ents AS (SELECT c.*, pl.centralnombre, pl.id_propietario, pl.id_coordinado, pl.id_centrocontrol
         FROM cfg c LEFT JOIN pl ON pl.id_central = c.id_central),
base AS (SELECT DISTINCT e.id_configuracion, e.configuracionnombre, e.configuracionnumero, e.centralnombre, e.id_central,
                g.r_name AS gruponombre, e.id_coordinado, cc.n_name AS empresanombre, e.id_centrocontrol,
                e.configuracionnemotecnico, e.configuraciondescripcion
         FROM ents e LEFT JOIN nation cc ON cc.n_nationkey = e.id_centrocontrol
         LEFT JOIN region g ON g.r_regionkey = e.id_coordinado),
inst AS (SELECT o_orderkey AS id_instalacion, o_custkey AS id_configuracion FROM orders WHERE o_orderstatus = 'F'),
val AS (SELECT c.configuracionnombre, 'Concepto ' || CAST(l.l_linenumber AS VARCHAR) AS conceptonombre,
               CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS fta_datovalortexto
        FROM cfg c JOIN inst i ON i.id_configuracion = c.id_configuracion
        JOIN lineitem l ON l.l_orderkey = i.id_instalacion
        WHERE 1000 + l.l_linenumber IN ({', '.join(str(x) for x in SHEET_CONCEPTS)})),
wide AS (SELECT configuracionnombre,
                {_WIDE_COLS}
         FROM val GROUP BY configuracionnombre)
SELECT DISTINCT b.id_configuracion AS "id", b.configuracionnombre AS "nombre", b.configuracionnumero AS "numero",
       b.centralnombre AS "nombre central", b.id_central AS "id central", b.gruponombre AS "nombre coordinado",
       b.id_coordinado AS "id coordinado", b.empresanombre AS "nombre centro control",
       b.id_centrocontrol AS "id centro control", b.configuracionnemotecnico AS "nemotecnico",
       b.configuraciondescripcion AS "descripcion", {_WIDE_SELECT}
FROM base b LEFT JOIN wide w ON w.configuracionnombre = b.configuracionnombre
""")
def unit_configurations_q(spark, d):
    """B7 through ``plans.energy.unit_configurations``: parts as unit configurations of the supplier
    with the part's size as plant; finished orders as installations of the customer-numbered
    configuration; order lines as the sheet data (line number as datum and concept, quantity as the
    text); nations as companies in two roles, regions as coordinated groups."""
    t = Tables(spark, d)
    p, s, n, o, li = t.part, t.supplier, t.nation, t.orders, t.lineitem
    configs = p.select(F.col("p_partkey").alias("id_configuracion"), F.col("p_size").cast("bigint").alias("id_central"),
                       F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("configuracionnombre"),
                       F.col("p_brand").alias("configuracionnumero"), F.col("p_type").alias("configuracionnemotecnico"),
                       F.col("p_name").alias("configuraciondescripcion"))
    plants = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id_central"), F.col("s_name").alias("centralnombre"),
        F.col("s_nationkey").cast("bigint").alias("id_propietario"), F.col("n_regionkey").cast("bigint").alias("id_coordinado"),
        F.col("s_nationkey").cast("bigint").alias("id_centrocontrol"))
    installations = o.select(F.col("o_orderkey").alias("id_instalacion"),
                             F.when(F.col("o_orderstatus") == "F", 5).otherwise(9).alias("id_instalaciontipo"),
                             F.col("o_custkey").alias("id_configuracion"))
    applied = o.select(F.col("o_orderkey").alias("id_ftaplicada"), F.col("o_orderkey").alias("id_instalacion"))
    applied_data = li.select(F.col("l_quantity").cast("bigint").cast("string").alias("fta_datovalortexto"),
                             F.col("l_linenumber").cast("bigint").alias("id_fte_dato"), F.col("l_orderkey").alias("id_ftaplicada"))
    numbers = li.select(F.col("l_linenumber").cast("bigint").alias("k")).distinct()
    standard = numbers.select(F.col("k").alias("id_fte_dato"), F.col("k").alias("id_datotecnico"))
    tech = numbers.select(F.col("k").alias("id_datotecnico"), (F.col("k") + 1000).alias("id_concepto"))
    concepts = numbers.select((F.col("k") + 1000).alias("id_concepto"),
                              F.concat(F.lit("Concepto "), F.col("k").cast("string")).alias("conceptonombre"))
    companies = n.select(F.col("n_nationkey").cast("bigint").alias("id_empresa"), F.col("n_name").alias("empresanombre"))
    groups = t.region.select(F.col("r_regionkey").cast("bigint").alias("id_grupo"), F.col("r_name").alias("gruponombre"))
    sheet, _dupes = energy.unit_configurations(configs, plants, installations, applied, applied_data, standard, tech,
                                               concepts, companies, groups, SHEET_CONCEPTS, SHEET_ATTRIBUTES)
    return sheet


_WIDE_MIN = ", ".join("min(CASE WHEN conceptonombre = '%s' THEN fta_datovalortexto END) AS \"%s\"" % (a, a)
                      for a in SHEET_ATTRIBUTES)


@register("substations", f"""
WITH sub AS (
  SELECT p.p_partkey AS id_subestacion, CAST(s.s_nationkey AS BIGINT) AS id_centrocontrol,
         CAST(s.s_nationkey AS BIGINT) AS id_propietario,
         CASE WHEN p.p_size > 45 THEN NULL ELSE CAST(n.n_regionkey AS BIGINT) END AS id_coordinado,
         p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS subestacionnombre, p.p_brand AS subestacionnumero,
         p.p_type AS subestacionnemotecnico, p.p_name AS subestaciondescripcion, 'SE' || CAST(p.p_partkey AS VARCHAR) AS subestacioncodigo
  FROM part p LEFT JOIN supplier s ON s.s_suppkey = p.p_size LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey),
base AS (SELECT DISTINCT x.id_subestacion, x.subestacionnombre, cc.n_name AS empresanombre, ow.n_name AS empresanombre2,
                g.r_name AS gruponombre, x.subestacionnumero, x.subestacionnemotecnico, x.subestaciondescripcion,
                x.subestacioncodigo, x.id_centrocontrol, x.id_propietario, x.id_coordinado
         FROM sub x LEFT JOIN nation cc ON cc.n_nationkey = x.id_centrocontrol
         LEFT JOIN nation ow ON ow.n_nationkey = x.id_propietario LEFT JOIN region g ON g.r_regionkey = x.id_coordinado),
inst AS (SELECT o_orderkey AS id_instalacion, o_custkey AS id_subestacion FROM orders WHERE o_orderstatus = 'O'),
val AS (SELECT x.subestacionnombre, 'Concepto ' || CAST(l.l_linenumber AS VARCHAR) AS conceptonombre,
               CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS fta_datovalortexto
        FROM sub x JOIN inst i ON i.id_subestacion = x.id_subestacion JOIN lineitem l ON l.l_orderkey = i.id_instalacion
        WHERE 1000 + l.l_linenumber IN ({', '.join(str(x) for x in SHEET_CONCEPTS)})),
wide AS (SELECT subestacionnombre, {_WIDE_MIN} FROM val GROUP BY subestacionnombre)
SELECT DISTINCT b.id_subestacion AS "id", b.subestacionnombre AS "nombre", b.empresanombre AS "nombre centro control",
       b.empresanombre2 AS "nombre propietario", b.gruponombre AS "empresa coordinada", b.subestacionnumero AS "numero",
       b.subestacionnemotecnico AS "nemotecnico", b.subestaciondescripcion AS "descripcion",
       b.subestacioncodigo AS "codigo_subestacion", b.id_centrocontrol, b.id_propietario,
       coalesce(CAST(b.id_coordinado AS VARCHAR), '') AS id_coordinado, {_WIDE_SELECT}
FROM base b LEFT JOIN wide w ON w.subestacionnombre = b.subestacionnombre
""")
def substations_q(spark, d):
    """B8 through ``plans.energy.substations``: parts as substations (company ids from the supplier
    numbered by the part's size; large parts without a coordinated company), open orders as their
    installations, order lines as sheet data; the first (smallest) text per (substation, concept)."""
    t = Tables(spark, d)
    p, s, n, o, li = t.part, t.supplier, t.nation, t.orders, t.lineitem
    sn = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_regionkey")
    subs = p.join(sn, F.col("p_size") == F.col("s_suppkey"), "left").select(
        F.col("p_partkey").alias("id_subestacion"), F.col("s_nationkey").cast("bigint").alias("id_centrocontrol"),
        F.col("s_nationkey").cast("bigint").alias("id_propietario"),
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("n_regionkey")).cast("bigint").alias("id_coordinado"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("subestacionnombre"),
        F.col("p_brand").alias("subestacionnumero"), F.col("p_type").alias("subestacionnemotecnico"),
        F.col("p_name").alias("subestaciondescripcion"),
        F.concat(F.lit("SE"), F.col("p_partkey").cast("string")).alias("subestacioncodigo"))
    installations = o.select(F.col("o_orderkey").alias("id_instalacion"),
                             F.when(F.col("o_orderstatus") == "O", 10).otherwise(9).alias("id_instalaciontipo"),
                             F.col("o_custkey").alias("id_subestacion"))
    applied = o.select(F.col("o_orderkey").alias("id_ftaplicada"), F.col("o_orderkey").alias("id_instalacion"))
    applied_data = li.select(F.col("l_quantity").cast("bigint").cast("string").alias("fta_datovalortexto"),
                             F.col("l_linenumber").cast("bigint").alias("id_fte_dato"), F.col("l_orderkey").alias("id_ftaplicada"))
    numbers = li.select(F.col("l_linenumber").cast("bigint").alias("k")).distinct()
    standard = numbers.select(F.col("k").alias("id_fte_dato"), F.col("k").alias("id_datotecnico"))
    tech = numbers.select(F.col("k").alias("id_datotecnico"), (F.col("k") + 1000).alias("id_concepto"))
    concepts = numbers.select((F.col("k") + 1000).alias("id_concepto"),
                              F.concat(F.lit("Concepto "), F.col("k").cast("string")).alias("conceptonombre"))
    companies = n.select(F.col("n_nationkey").cast("bigint").alias("id_empresa"), F.col("n_name").alias("empresanombre"))
    groups = t.region.select(F.col("r_regionkey").cast("bigint").alias("id_grupo"), F.col("r_name").alias("gruponombre"))
    sheet, _dupes = energy.substations(subs, installations, applied, applied_data, standard, tech, concepts, companies,
                                       groups, SHEET_CONCEPTS, SHEET_ATTRIBUTES, order_by="fta_datovalortexto")
    return sheet
