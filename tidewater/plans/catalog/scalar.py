"""Catalogue: column functions (text, numbers, dates, rules) and the staging jobs built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import (first_of_month, first_of_month_text, parse_date, period_label, style_105,
                                       style_120, within_last_year, yyyymm)
from tidewater.functions.names import add_constants, cast_columns, copy_columns, lower_names, rename, rename_positional
from tidewater.functions.numbers import difference_where_null, local_number, round_half_even_int, tax_inclusive
from tidewater.functions.rules import (blank_if_null, first_rule, in_range_or_null, not_in_keep_null, not_true,
                                       positive_flag)
from tidewater.functions.text import (capitalize_first, concat_null_empty, contains_any, nan_to_null, proper,
                                      split_part, tax_id)
from tidewater.plans.catalog import AS_OF_ORDERS, Tables, register
from tidewater.plans.employment import AGE_LABELS, EXPERIENCE_ORDER, age_bracket, ordinal
from tidewater.plans.membership import member_staging, person_record, working_group_members


@register("local_numbers", """
WITH t AS (SELECT o_orderkey,
                  CASE WHEN o_orderstatus = 'P' THEN 'sin monto' WHEN o_orderpriority = '5-LOW' THEN '3.000.000.000,00'
                  ELSE translate(format('{:,.2f}', o_totalprice), ',.', '.,') END AS texto
           FROM orders)
SELECT o_orderkey, texto, TRY_CAST(replace(replace(texto, '.', ''), ',', '.') AS DOUBLE) AS monto,
       CAST(round_even(TRY_CAST(replace(replace(texto, '.', ''), ',', '.') AS DOUBLE), 0) AS BIGINT) AS monto_entero
FROM t
""")
def local_numbers(spark, d):
    """B24 (M2, M1): local-format amounts (``1.234,56``) parsed back, bad text -> null, half-even integers."""
    o = Tables(spark, d).orders
    text = F.when(F.col("o_orderstatus") == "P", F.lit("sin monto")).when(F.col("o_orderpriority") == "5-LOW", "3.000.000.000,00").otherwise(
        F.translate(F.format_number("o_totalprice", 2), ",.", ".,"))
    t = o.select("o_orderkey", text.alias("texto"))
    return t.select("o_orderkey", "texto", local_number("texto").alias("monto"),
                    round_half_even_int(local_number("texto")).alias("monto_entero"))


MONTHS_SQL = "['ene', 'feb', 'mar', 'abr', 'may', 'jun', 'jul', 'ago', 'sep', 'oct', 'nov', 'dic']"


@register("period_label", f"""
WITH p AS (SELECT strftime(o_orderdate, '%Y%m') AS periodo,
                  CAST(year(o_orderdate) AS VARCHAR) || CAST(month(o_orderdate) AS VARCHAR) AS periodo_corto FROM orders)
SELECT periodo, periodo_corto,
       {MONTHS_SQL}[CAST(substr(periodo, 5, 2) AS INTEGER)] || ' - ' || substr(periodo, 1, 4) AS etiqueta,
       {MONTHS_SQL}[CAST(substr(periodo_corto, 5, 2) AS INTEGER)] || ' - ' || substr(periodo_corto, 1, 4) AS etiqueta_corta,
       CAST(count(*) AS BIGINT) AS n_pedidos
FROM p GROUP BY 1, 2, 3, 4
""")
def period_label_q(spark, d):
    """B24 (T3, T4): ``yyyyMM`` text and the Spanish short label, from 6- and 5-character periods."""
    o = Tables(spark, d).orders
    p = o.select(yyyymm("o_orderdate").alias("periodo"),
                 F.concat(F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string")).alias("periodo_corto"))
    return p.groupBy("periodo", "periodo_corto", period_label("periodo").alias("etiqueta"),
                     period_label("periodo_corto").alias("etiqueta_corta")).agg(F.count(F.lit(1)).alias("n_pedidos"))


@register("tax_total", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax = 0 THEN 'IVA_EXE' WHEN l_tax >= 0.05 THEN 'IVA' END AS codigo,
       round(CASE WHEN coalesce(CASE WHEN l_tax = 0 THEN 'IVA_EXE' WHEN l_tax >= 0.05 THEN 'IVA' END, '_') = 'IVA_EXE'
                  THEN l_extendedprice * (1 - l_discount) ELSE l_extendedprice * (1 - l_discount) * CAST(1.19 AS DOUBLE) END, 6) AS total,
       CASE WHEN l_tax = 0 THEN 'exento' ELSE 'afecto' END AS tipo
FROM lineitem
""")
def tax_total(spark, d):
    """B25 (M3, C2): exempt code keeps the net amount, other codes (null counts as ``_``) add 19%."""
    li = Tables(spark, d).lineitem
    code = first_rule([(F.col("l_tax") == 0, "IVA_EXE"), (F.col("l_tax") >= 0.05, "IVA")], F.lit(None).cast("string"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    x = li.select("l_orderkey", "l_linenumber", net.alias("neto"), code.alias("codigo"), "l_tax")
    return x.select("l_orderkey", "l_linenumber", "codigo", F.round(tax_inclusive("neto", "codigo"), 6).alias("total"),
                    F.when(F.col("l_tax") == 0, "exento").otherwise("afecto").alias("tipo"))


# Region names of the driver tables grouped into zones (later list wins, C4).
DRIVER_ZONES = {"Zona Norte": ["AMERICA"], "Zona Centro": ["EUROPE", "AFRICA"], "Zona Sur": ["ASIA", "AFRICA"],
                "RM": ["MIDDLE EAST"]}


@register("zone_hash", """
SELECT c.c_custkey AS id_socio, upper(lower(c.c_mktsegment)) AS estado, c.c_mktsegment AS actividades,
       coalesce(nullif(n.n_name, 'NATION_0'), 'Sin Comité Principal') AS comite_principal, 'NO' AS entidad,
       r.r_name AS camara, c.c_name AS rut,
       CASE WHEN contains(c.c_mktsegment, 'BUILD') THEN 'SI' END AS is_entidad,
       CASE WHEN r.r_name IN ('MIDDLE EAST') THEN 'RM' WHEN r.r_name IN ('ASIA', 'AFRICA') THEN 'Zona Sur'
            WHEN r.r_name IN ('EUROPE', 'AFRICA') THEN 'Zona Centro' WHEN r.r_name IN ('AMERICA') THEN 'Zona Norte' END AS zona,
       sha256(c.c_name) AS rut_hash
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def zone_hash(spark, d):
    """B28 (P3, P2, X1, F8, C5, C4, X13): member staging on customers: upper state, entity flag,
    fills, zone from name lists, SHA-256 of the id."""
    t = Tables(spark, d)
    src = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("c_custkey").alias("C_CUSTKEY"), F.lower("c_mktsegment").alias("ESTADO"),
                   F.col("c_mktsegment").alias("ACTIVIDADES"),
                   F.nullif(F.col("n_name"), F.lit("NATION_0")).alias("COMITE_PRINCIPAL"),
                   F.lit(None).cast("string").alias("ENTIDAD"), F.col("r_name").alias("CAMARA"),
                   F.col("c_name").alias("RUT")))
    out = member_staging(src, {"c_custkey": "id_socio"}, zones=DRIVER_ZONES, entity_word="BUILD")
    return out.select("id_socio", "estado", "actividades", "comite_principal", "entidad", "camara", "rut",
                      "is_entidad", "zona", "rut_hash")


@register("name_assembly", """
WITH g AS (
  SELECT c.c_custkey AS per_id, nullif(c.c_mktsegment, 'HOUSEHOLD') AS per_nom_0, n.n_name AS per_ape_pat_1,
         c.c_name AS per_ape_mat_15, CAST(c.c_custkey AS VARCHAR) AS per_rut_3, substr(c.c_mktsegment, 1, 1) AS per_dv_4,
         c.c_name AS per_nom_11, nullif(n.n_name, 'NATION_1') AS per_ape_pat_12,
         CASE WHEN c.c_acctbal < 0 THEN 'n/a' ELSE CAST(c.c_nationkey AS VARCHAR) END AS per_rut_16, 'K' AS per_dv_17,
         n.n_name AS gru_nom, CASE WHEN c.c_acctbal < 0 THEN 'x' ELSE CAST(c.c_custkey AS VARCHAR) END AS reg,
         CAST(c.c_nationkey AS VARCHAR) AS tipo, nullif(c.c_mktsegment, 'BUILDING') AS calle, CAST(c.c_nationkey AS VARCHAR) AS nro
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT per_id, TRY_CAST(reg AS BIGINT) AS nro_registro, TRY_CAST(reg AS BIGINT) AS id_socio, TRY_CAST(tipo AS INTEGER) AS tipo_persona,
       gru_nom AS nombre_grupo, per_nom_0 AS razon_social, nro AS telefono_1,
       regexp_replace(coalesce(calle, '') || ' ' || coalesce(nro, ''), ' +', ' ', 'g') AS direccion,
       regexp_replace(coalesce(per_nom_0, '') || ' ' || coalesce(per_ape_pat_1, '') || ' ' || coalesce(per_ape_mat_15, ''), ' +', ' ', 'g') AS socio_nombre,
       CAST(TRY_CAST(per_rut_3 AS INTEGER) AS VARCHAR) || '-' || per_dv_4 AS rut,
       regexp_replace(coalesce(per_nom_11, '') || ' ' || coalesce(per_ape_pat_12, '') || ' ' || coalesce(per_ape_mat_15, ''), ' +', ' ', 'g') AS persona_nombre,
       CAST(TRY_CAST(per_rut_16 AS INTEGER) AS VARCHAR) || '-' || per_dv_17 AS persona_rut,
       gru_nom AS organo_gremial
FROM g
""")
def name_assembly(spark, d):
    """B32 (X7, X14, X5): names assembled with null parts as empty and single spaces; ``number-dv``
    ids that are null when either part is missing or the number does not parse; renames, integer casts, address."""
    t = Tables(spark, d)
    g = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("PER_ID"), F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("PER_NOM_0"),
        F.col("n_name").alias("PER_APE_PAT_1"), F.col("c_name").alias("PER_APE_MAT_15"),
        F.col("c_custkey").cast("string").alias("PER_RUT_3"), F.substring("c_mktsegment", 1, 1).alias("PER_DV_4"),
        F.col("c_name").alias("PER_NOM_11"), F.nullif(F.col("n_name"), F.lit("NATION_1")).alias("PER_APE_PAT_12"),
        F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("PER_RUT_16"),
        F.lit("K").alias("PER_DV_17"), F.col("n_name").alias("GRU_NOM"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("PER_DET_RAZ_SOC_5"),
        F.when(F.col("c_acctbal") < 0, "x").otherwise(F.col("c_custkey").cast("string")).alias("PRE_REG_NRO_7"),
        F.col("c_nationkey").cast("string").alias("PER_TIPO_9"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("DIR_CALLE_24"),
        F.col("c_nationkey").cast("string").alias("DIR_NRO_25"), F.col("c_nationkey").cast("string").alias("SCLR_29"))
    out = working_group_members(g)
    return out.select("per_id", "nro_registro", "id_socio", "tipo_persona", "nombre_grupo", "razon_social", "telefono_1", "direccion",
                      "socio_nombre", "rut", "persona_nombre", "persona_rut", "organo_gremial")


@register("text_length_flag", """
SELECT doc_id, lang, coalesce(length(text) < 90, false) AS is_descripcion_corta, CAST(length(text) AS INTEGER) AS largo_descripcion FROM documents
""")
def text_length_flag(spark, d):
    """B30 (F11, X9): every text with its length and a flag for those shorter than 90 characters."""
    from tidewater.plans.membership import group_names
    docs = Tables(spark, d).documents.select("doc_id", "lang", F.col("text").alias("descripcion"))
    return group_names(docs).select("doc_id", "lang", "is_descripcion_corta", "largo_descripcion")


@register("person_record", f"""
WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS primera FROM orders GROUP BY 1),
p AS (SELECT c.c_custkey AS per_id, c.c_mktsegment AS nombre, n.n_name AS apellido_paterno,
             nullif(c.c_name, 'Customer#000000007') AS apellido_materno, f.primera AS fecha_creacion,
             CASE WHEN c.c_nationkey <> 7 THEN CAST(f.primera - INTERVAL 204 MONTH AS DATE) END AS fecha_nacimiento,
             CASE WHEN c.c_nationkey = 3 THEN DATE '2000-01-01' END AS fecha_defuncion
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN f ON f.o_custkey = c.c_custkey),
gm AS (SELECT DISTINCT lower(c_mktsegment) AS primer_nombre,
              CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'F' ELSE 'M' END AS sexo_inferido FROM customer),
cons AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'),
rol AS (SELECT o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN 75 WHEN '2-HIGH' THEN 112 ELSE 106 END AS id_rol,
               o_orderstatus = 'F' AND o_totalprice > 200000 AS activo FROM orders)
SELECT p.per_id, p.nombre, p.apellido_paterno, p.apellido_materno, p.fecha_creacion, p.fecha_nacimiento,
       p.fecha_defuncion, CASE WHEN p.fecha_defuncion IS NULL THEN 'NO' ELSE 'SI' END AS is_difunto,
       p.per_id IN (SELECT o_custkey FROM cons) AND p.per_id IN (SELECT o_custkey FROM rol WHERE activo AND id_rol <> 75) AS is_consejero_regional,
       p.per_id IN (SELECT o_custkey FROM rol WHERE id_rol IN (75, 112)) AS is_personal_camara,
       p.per_id IN (SELECT o_custkey FROM rol WHERE activo) AS is_relacionado_socio,
       gm.sexo_inferido,
       CAST(round_even(date_diff('day', p.fecha_creacion, DATE '{AS_OF_ORDERS}') / 365, 0) AS INTEGER) AS antiguedad_camara,
       CAST(round_even(date_diff('day', p.fecha_nacimiento, DATE '{AS_OF_ORDERS}') / 365, 0) AS INTEGER) AS edad,
       CASE WHEN round_even(date_diff('day', p.fecha_nacimiento, DATE '{AS_OF_ORDERS}') / 365, 0) > 120
              OR round_even(date_diff('day', p.fecha_nacimiento, DATE '{AS_OF_ORDERS}') / 365, 0) < 18 THEN false ELSE true END
         AS is_fecha_nacimiento_valida,
       regexp_replace(coalesce(p.nombre, '') || ' ' || coalesce(p.apellido_paterno, '') || ' ' || coalesce(p.apellido_materno, ''),
                      ' +', ' ', 'g') AS nombre_completo
FROM p LEFT JOIN gm ON gm.primer_nombre = lower(p.nombre)
""")
def person_record_q(spark, d):
    """B31 (T1, J8, X12, J3, T8, F12, X7, X5): customers as person records; first order as creation
    date, birth 17 years earlier (one nation's is no date); orders as group memberships and roles; ages as half-even
    rounded years at a fixed as_of."""
    t = Tables(spark, d)
    first = t.orders.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("primera"))
    p = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(first, F.col("o_custkey") == F.col("c_custkey"), "left")
         .select(F.col("c_custkey").alias("per_id"), F.col("c_mktsegment").alias("nombre"),
                 F.col("n_name").alias("apellido_paterno"),
                 F.nullif(F.col("c_name"), F.lit("Customer#000000007")).alias("apellido_materno"),
                 F.col("primera").cast("string").alias("fecha_creacion"),
                 F.when(F.col("c_nationkey") == 7, "30-30-1990").otherwise(F.add_months("primera", -204).cast("string")).alias("fecha_nacimiento"),
                 F.when(F.col("c_nationkey") == 3, "2000-01-01").alias("fecha_defuncion")))
    gm = t.customer.select(F.col("c_mktsegment").alias("nombre"),
                           F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"), "F").otherwise("M")
                           .alias("sexo_inferido")).distinct()
    members = t.orders.select(
        F.col("o_custkey").cast("string").alias("per_id"), F.when(F.col("o_orderstatus") == "P", "INACTIVA").otherwise("ACTIVA").alias("estado_participacion"),
        F.lit("ACTIVA").alias("estado_grupo"), F.when(F.col("o_orderpriority") == "1-URGENT", "Consejo Regional").otherwise("Otro").alias("nombre_grupo"))
    role = F.when(F.col("o_orderpriority") == "1-URGENT", 75).when(F.col("o_orderpriority") == "2-HIGH", 112).otherwise(106)
    roles = t.orders.select(
        F.col("o_custkey").alias("per_id"), role.alias("id_rol"), F.when(F.col("o_orderstatus") == "F", "ACTIVA").otherwise("INACTIVA").alias("estado_relacion"),
        F.when(F.col("o_totalprice") > 200000, "Activo").otherwise("Inactivo").alias("estado_socio"))
    return person_record(p, gm, members, roles, AS_OF_ORDERS)


EXPERIENCE_BY_SEGMENT = {"BUILDING": EXPERIENCE_ORDER[0], "MACHINERY": EXPERIENCE_ORDER[1],
                         "AUTOMOBILE": EXPERIENCE_ORDER[3], "FURNITURE": EXPERIENCE_ORDER[4]}


def _case_map(col: str, mapping: dict) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


@register("worker_brackets", f"""
WITH w AS (SELECT c_custkey, c_name,
                  CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal / 100) AS INTEGER) END AS edad,
                  substr(c_mktsegment, 1, 1) AS sexo, {_case_map('c_mktsegment', EXPERIENCE_BY_SEGMENT)} AS rango_experiencia
           FROM customer)
SELECT c_custkey, edad,
       CASE WHEN edad <= 30 THEN '{AGE_LABELS[0]}' WHEN edad > 30 AND edad <= 40 THEN '{AGE_LABELS[1]}'
            WHEN edad > 40 AND edad <= 50 THEN '{AGE_LABELS[2]}' WHEN edad > 50 AND edad <= 60 THEN '{AGE_LABELS[3]}'
            ELSE '{AGE_LABELS[4]}' END AS tramo_de_edad,
       CASE WHEN edad <= 30 THEN 1 WHEN edad > 30 AND edad <= 40 THEN 2 WHEN edad > 40 AND edad <= 50 THEN 3
            WHEN edad > 50 AND edad <= 60 THEN 4 ELSE 5 END AS OrdenTramoEdad,
       CASE WHEN sexo = 'M' THEN 'Mujeres' WHEN sexo = 'H' THEN 'Hombres' ELSE 'Sin Información' END AS genero,
       rango_experiencia,
       CASE {' '.join(f"WHEN rango_experiencia = '{lab}' THEN {i + 1}" for i, lab in enumerate(EXPERIENCE_ORDER))} END
         AS OrdenRangoExperiencia,
       concat_ws('', c_name, rango_experiencia) AS clave_combinada
FROM w
""")
def worker_brackets(spark, d):
    """B20 (C1, X8): age brackets (null falls to the last), ordinals, gender labels, composite keys."""
    from tidewater.functions.nested import map_lookup
    c = Tables(spark, d).customer.select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.floor(F.col("c_acctbal") / 100).cast("int")).alias("edad"),
        F.substring("c_mktsegment", 1, 1).alias("sexo"),
        map_lookup("c_mktsegment", EXPERIENCE_BY_SEGMENT).alias("rango_experiencia"))
    tramo = age_bracket("edad")
    return c.select(
        "c_custkey", "edad", tramo.alias("tramo_de_edad"), ordinal(tramo, AGE_LABELS).alias("OrdenTramoEdad"),
        first_rule([(F.col("sexo") == "M", "Mujeres"), (F.col("sexo") == "H", "Hombres")], "Sin Información").alias("genero"),
        "rango_experiencia", ordinal("rango_experiencia", EXPERIENCE_ORDER).alias("OrdenRangoExperiencia"),
        concat_null_empty("c_name", "rango_experiencia").alias("clave_combinada"))


@register("projection_ops", """
SELECT o_orderkey AS pedido, o_custkey AS cliente, o_orderstatus AS estado, o_totalprice AS total,
       o_orderpriority AS prioridad, 'tpch' AS origen, 0 AS monto_usd, o_orderstatus AS estado_particion,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prioridad_num,
       TRY_CAST(o_orderstatus || '1' AS INTEGER) AS codigo, o_totalprice * 2 AS total_doble
FROM orders
""")
def projection_ops(spark, d):
    """Select, rename by map, lowercase names, positional rename, drop, constants, copy,
    typed casts with bad text -> null, keep-all plus an expression."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                       "o_orderpriority")
    df = rename(o, {"o_orderkey": "PEDIDO", "o_custkey": "Cliente"})
    df = lower_names(df)
    df = rename_positional(df, ["pedido", "cliente", "estado", "total", "fecha", "prioridad"])
    df = df.drop("fecha")
    df = add_constants(df, {"origen": "tpch", "monto_usd": 0})
    df = copy_columns(df, {"estado": "estado_particion"})
    df = df.withColumns({"prioridad_num": F.substring("prioridad", 1, 1), "codigo": F.concat("estado", F.lit("1"))})
    df = cast_columns(df, {"int": ["prioridad_num", "codigo"]})
    return df.selectExpr("*", "total * 2 AS total_doble")


def _filter_predicates():
    prioridad = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    flag = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    valor = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 2000).cast("int"))
    return {
        "F01_igualdad": F.col("o_orderstatus") == "F",
        "F02_y_o": ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)) | (F.col("o_orderpriority") == "1-URGENT"),
        "F03_en_lista": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
        "F04_fuera_de_lista": not_in_keep_null(prioridad, ["1-URGENT", "2-HIGH"]),
        "F05_nulo": prioridad.isNull(),
        "F06_no_verdadero": not_true(flag),
        "F07_prefijo": F.col("o_orderpriority").startswith("3"),
        "F08_contiene": contains_any("o_orderpriority", ["urgent", "high"]),
        "F09_texto": F.expr("o_totalprice < 50000"),
        "F10_fecha": F.to_date("o_orderdate") >= F.lit("1999-01-01").cast("date"),
        "F11_largo": F.length("o_orderpriority") < 8,
        "F12_rango": in_range_or_null(valor, 18, 120),
    }


_FILTER_SQL = {
    "F01_igualdad": "o_orderstatus = 'F'",
    "F02_y_o": "(o_orderstatus = 'F' AND o_totalprice > 200000) OR o_orderpriority = '1-URGENT'",
    "F03_en_lista": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "F04_fuera_de_lista": "coalesce(NOT (nullif(o_orderpriority, '5-LOW') IN ('1-URGENT', '2-HIGH')), true)",
    "F05_nulo": "nullif(o_orderpriority, '5-LOW') IS NULL",
    "F06_no_verdadero": "NOT coalesce(CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END, false)",
    "F07_prefijo": "starts_with(o_orderpriority, '3')",
    "F08_contiene": "regexp_matches(lower(o_orderpriority), 'urgent|high')",
    "F09_texto": "o_totalprice < 50000",
    "F10_fecha": "CAST(o_orderdate AS DATE) >= DATE '1999-01-01'",
    "F11_largo": "length(o_orderpriority) < 8",
    "F12_rango": "NOT coalesce(CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 2000) AS INTEGER) END > 120 "
                 "OR CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 2000) AS INTEGER) END < 18, false)",
}


@register("filter_ops", "\nUNION ALL\n".join(
    f"SELECT '{k}' AS predicado, CAST(count(*) FILTER (WHERE {v}) AS BIGINT) AS n FROM orders" for k, v in _FILTER_SQL.items()))
def filter_ops(spark, d):
    """Every predicate counted in one pass over orders (with nulls created), one row each."""
    preds = _filter_predicates()
    wide = Tables(spark, d).orders.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(k) for k, p in preds.items()])
    return wide.unpivot([], list(preds), "predicado", "n")


def _initcap_sql(col: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({col}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


@register("text_ops", f"""
SELECT p_partkey, lower(p_name) AS nombre_min, upper(p_name) AS nombre_may,
       upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS nombre_cap,
       {_initcap_sql('p_name')} AS nombre_titulo,
       regexp_replace(p_brand, '#', '-', 'g') AS marca_guion, split_part(p_brand, '#', 2) AS marca_num,
       concat_ws('', p_brand, nullif(p_type, 'SMALL')) AS clave,
       CASE WHEN length(upper(replace(CAST(p_partkey AS VARCHAR) || '-k', '-', ''))) < 10
            THEN lpad(upper(replace(CAST(p_partkey AS VARCHAR) || '-k', '-', '')), 10, '0')
            ELSE upper(replace(CAST(p_partkey AS VARCHAR) || '-k', '-', '')) END AS id_tributario,
       nullif(CASE WHEN p_size > 45 THEN 'nan' ELSE p_type END, 'nan') AS tipo,
       CAST(p_partkey AS VARCHAR) || p_brand AS id_compuesto
FROM part
""")
def text_ops(spark, d):
    """X1 X2 X3 X4 X6 X8 X10 X15 X17 on part names, brands and ids."""
    p = Tables(spark, d).part
    return p.select(
        "p_partkey", F.lower("p_name").alias("nombre_min"), F.upper("p_name").alias("nombre_may"),
        capitalize_first("p_name").alias("nombre_cap"), proper("p_name").alias("nombre_titulo"),
        F.regexp_replace("p_brand", "#", "-").alias("marca_guion"), split_part("p_brand", "#", 2).alias("marca_num"),
        concat_null_empty("p_brand", F.nullif(F.col("p_type"), F.lit("SMALL"))).alias("clave"),
        tax_id(F.concat(F.col("p_partkey").cast("string"), F.lit("-k"))).alias("id_tributario"),
        nan_to_null(F.when(F.col("p_size") > 45, "nan").otherwise(F.col("p_type"))).alias("tipo"),
        F.concat(F.col("p_partkey").cast("string"), F.col("p_brand")).alias("id_compuesto"))


@register("date_ops", f"""
WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS fecha FROM orders),
t AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN '31-02-' || CAST(year(fecha) AS VARCHAR) ELSE strftime(fecha, '%d-%m-%Y') END AS texto FROM o)
SELECT o_orderkey, fecha, texto, CAST(try_strptime(texto, '%d-%m-%Y') AS DATE) AS fecha_parseada,
       CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes, CAST(day(fecha) AS INTEGER) AS dia,
       CAST(date_diff('day', fecha, DATE '{AS_OF_ORDERS}') AS INTEGER) AS dias,
       fecha - 3 AS menos_3_dias, CAST(fecha - INTERVAL 12 MONTH AS DATE) AS menos_12_meses,
       '01-' || CAST(month(fecha) AS VARCHAR) || '-' || CAST(year(fecha) AS VARCHAR) AS primero_txt,
       CAST(date_trunc('month', fecha) AS DATE) AS primero_mes, strftime(fecha, '%Y-%m-%d') AS estilo_120,
       CAST(year(DATE '{AS_OF_ORDERS}') - 2 AS INTEGER) AS anio_particion,
       CASE WHEN fecha >= CAST(DATE '{AS_OF_ORDERS}' - INTERVAL 12 MONTH AS DATE) THEN true ELSE false END AS ultimo_anio
FROM t
""")
def date_ops(spark, d):
    """T1 T2 T6 T7 T9 T10 T11 T12 T15 T17 T19 on order dates with a fixed as_of; some texts are invalid dates."""
    from tidewater.functions.dates import as_date
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("fecha"))
    t = o.withColumn("texto", F.when(F.col("o_orderstatus") == "P",
                                     F.concat(F.lit("31-02-"), F.year("fecha").cast("string"))).otherwise(style_105("fecha")))
    a = as_date(AS_OF_ORDERS)
    return t.select(
        "o_orderkey", "fecha", "texto", parse_date("texto", "dd-MM-yyyy").alias("fecha_parseada"),
        F.year("fecha").alias("anio"), F.month("fecha").alias("mes"), F.dayofmonth("fecha").alias("dia"),
        F.datediff(a, F.col("fecha")).alias("dias"), F.date_sub("fecha", 3).alias("menos_3_dias"),
        F.add_months("fecha", -12).alias("menos_12_meses"),
        first_of_month_text(F.month("fecha"), F.year("fecha")).alias("primero_txt"),
        first_of_month("fecha").alias("primero_mes"), style_120("fecha").alias("estilo_120"),
        (F.year(a) - 2).alias("anio_particion"), within_last_year("fecha", AS_OF_ORDERS).alias("ultimo_anio"))


@register("conditional_ops", """
WITH a AS (SELECT o_custkey, count(*) AS n_urg, sum(o_totalprice) AS monto_urg FROM orders
           WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1),
j AS (SELECT c.c_custkey, c.c_acctbal, a.n_urg, a.monto_urg FROM customer c LEFT JOIN a ON c.c_custkey = a.o_custkey)
SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'alto' ELSE 'bajo' END AS segmento_saldo,
       CAST(coalesce(n_urg, 0) AS BIGINT) AS n_urg, coalesce(n_urg > 0, false) AS tiene_urgente,
       CASE WHEN (n_urg > 0 OR monto_urg > 100000) AND c_acctbal > 0 THEN true ELSE false END AS uso,
       coalesce(CAST(n_urg AS VARCHAR), '') AS texto_n,
       CASE WHEN coalesce(monto_urg, 0) > 0 THEN 'Con pedidos' ELSE 'Sin pedidos' END AS estado,
       CASE WHEN n_urg IS NULL THEN c_acctbal - c_acctbal / 2 ELSE c_acctbal / 2 END AS diferencia,
       round(monto_urg, 2) AS monto_urg
FROM j
""")
def conditional_ops(spark, d):
    """C2 C5 C6 C7 C8 C9 M4 on customers left-joined with per-customer counts (so nulls arise)."""
    t = Tables(spark, d)
    hit = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    a = (t.orders.groupBy("o_custkey").agg(F.when(F.count_if(hit) > 0, F.count_if(hit)).alias("n_urg"),
                                           F.sum(F.when(hit, F.col("o_totalprice"))).alias("monto_urg")))
    j = t.customer.select("c_custkey", "c_acctbal").join(a, F.col("c_custkey") == F.col("o_custkey"), "left")
    uso = ((F.col("n_urg") > 0) | (F.col("monto_urg") > 100000)) & (F.col("c_acctbal") > 0)
    return j.select(
        "c_custkey", F.when(F.col("c_acctbal") > 5000, "alto").otherwise("bajo").alias("segmento_saldo"),
        F.coalesce("n_urg", F.lit(0)).alias("n_urg"), positive_flag("n_urg").alias("tiene_urgente"),
        F.when(uso, True).otherwise(False).alias("uso"), blank_if_null("n_urg").alias("texto_n"),
        F.when(F.coalesce("monto_urg", F.lit(0.0)) > 0, "Con pedidos").otherwise("Sin pedidos").alias("estado"),
        difference_where_null("n_urg", "c_acctbal", F.col("c_acctbal") / 2).alias("diferencia"),
        F.round("monto_urg", 2).alias("monto_urg"))
