"""Membership jobs (B23, B28-B36, B38): member registry, member staging, person records, attendance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import years_between
from tidewater.functions.names import cast_columns, lower_names, rename
from tidewater.functions.rules import first_rule, in_range_or_null
from tidewater.functions.text import (collapse_spaces, contains_any, first_word, full_name, sha256_text,
                                      tax_id_with_dv)
from tidewater.operators.relational import exists_flag, lookup_join
from tidewater.operators.sets import union_all
from tidewater.operators.versions import drop_earliest_dup, first_by


def member_totals(socios: DataFrame, empresas: DataFrame, registry: DataFrame, insolvencies: DataFrame,
                  orders: DataFrame) -> DataFrame:
    """Members from two sources with different columns appended (U2), keys lowercased (X1),
    registry attributes looked up (J3), insolvency flag (J8), per-member totals pre-aggregated
    and joined one-to-one (A1, A4), fills per column (C5)."""
    members = union_all([socios.withColumn("rut", F.lower("rut")), empresas.withColumn("rut", F.lower("rut"))],
                        allow_missing=True)
    out = lookup_join(members, registry, "c_nationkey", select=["nacion"])
    out = exists_flag(out, insolvencies.select(F.lower("rut").alias("rut")), "rut", "insolvente")
    totals = orders.groupBy(F.lower("rut").alias("rut")).agg(
        F.count(F.lit(1)).alias("n_pedidos"), F.round(F.sum("o_totalprice"), 2).alias("monto"))
    out = out.join(totals, "rut", "left")
    return out.select("rut", "c_custkey", "nacion",
                      F.coalesce("c_mktsegment", F.lit("Sin Información")).alias("segmento"), "insolvente",
                      F.coalesce("n_pedidos", F.lit(0)).cast("bigint").alias("n_pedidos"),
                      F.coalesce("monto", F.lit(0.0)).alias("monto"))


# Construction sub-sectors grouped into sector groups.
CONSTRUCTION_GROUPS = {
    "ACTIVIDADES ESPECIALIZADAS DE CONSTRUCCIÓN": [
        "DEMOLICION Y PREPARACION DEL TERRENO",
        "INSTALACIONES ELECTRICAS, DE GASFITERIA Y OTRAS INSTALACIONES PARA OBRAS DE CONSTRUCCION",
        "OTRAS ACTIVIDADES ESPECIALIZADAS DE CONSTRUCCION",
        "TERMINACION Y ACABADO DE EDIFICIOS",
    ],
    "CONSTRUCCIÓN DE EDIFICIOS": ["CONSTRUCCION DE EDIFICIOS"],
    "OBRAS DE INGENIERÍA CIVIL": [
        "CONSTRUCCION DE CARRETERAS Y LINEAS DE FERROCARRIL",
        "CONSTRUCCION DE OTRAS OBRAS DE INGENIERIA CIVIL",
        "CONSTRUCCION DE PROYECTOS DE SERVICIO PUBLICO",
    ],
}

REGISTRY_OUTPUT = ["rut", "razon_social", "grupo_caenes", "rubro_economico", "subrubro_economico",
                   "tipo_de_contribuyente", "tramo_de_facturacion_txt", "tamano_de_empresa", "tramo_trabajadores",
                   "tramo_capital_propio_txt", "socio", "estado", "camara_casa_matriz", "insolvente", "commercial_year"]


def member_registry(members: DataFrame, registry: DataFrame, manual_rows: DataFrame, insolvencies: DataFrame,
                    companies: DataFrame, commercial_year: int) -> DataFrame:
    """B23 (U2, X1, J3, J8, S10, G5, C5): members enriched with the tax registry.

    The registry is the yearly registry plus manually added rows (different columns, appended by
    name); every key is lowercased; members are left-joined to the registry (a repeated registry
    id repeats the member, as a plain merge does), flagged as insolvent from the distinct insolvency
    ids, joined to the companies table (state, head-office chamber, ``socio`` = listed there),
    grouped by construction sub-sector (literal map of lists) and given the equity bracket label
    (literal table); then the per-column fills.
    """
    from tidewater.functions.nested import explode_groups
    from tidewater.sources.readers import literal_table
    spark = members.sparkSession
    reg = union_all([manual_rows.withColumn("commercial_year", F.lit(str(commercial_year))), registry],
                    allow_missing=True).withColumn("rut", F.lower("rut"))
    df = members.select(F.lower("rut").alias("rut")).join(reg.drop("commercial_year"), "rut", "left")
    df = exists_flag(df, insolvencies.select(F.lower("rut").alias("rut")), "rut", "insolvente")
    comp = companies.select(F.lower("rut").alias("rut"), "estado", "camara_casa_matriz", F.lit(True).alias("socio"))
    df = df.join(comp, "rut", "left")
    groups = explode_groups(spark, CONSTRUCTION_GROUPS, "grupo_caenes", "subrubro_economico")
    df = df.join(groups, "subrubro_economico", "left")
    labels = literal_table(spark, CAPITAL_BRACKETS, "tramo_capital_propio_positivo int, tramo_capital_propio_txt string")
    df = df.join(labels, "tramo_capital_propio_positivo", "left")
    df = df.fillna({"socio": False, "tramo_capital_propio_txt": "Sin Información",
                    "tramo_trabajadores": "Sin Información", "tramo_de_facturacion_txt": "No Informado",
                    "rubro_economico": "Valor por Defecto", "subrubro_economico": "Valor por Defecto"})
    df = df.withColumn("commercial_year", F.lit(int(commercial_year)).cast("int"))
    return df.select(*REGISTRY_OUTPUT)


# Chamber-to-zone groups of the member staging job.
ZONES = {
    "Zona Norte": ["ARICA", "ANTOFAGASTA", "CALAMA", "IQUIQUE"],
    "Zona Centro": ["COPIAPÓ", "RANCAGUA", "LA SERENA", "VALPARAÍSO"],
    "Zona Sur": ["CONCEPCIÓN", "LOS ÁNGELES", "TEMUCO", "TALCA", "CHILLÁN"],
    "Zona Austral": ["VALDIVIA", "OSORNO", "COYHAIQUE", "PUERTO MONTT", "PUNTA ARENAS"],
    "RM": ["SANTIAGO"],
}

# Positive equity brackets (number, label) of the member registry.
CAPITAL_BRACKETS = [
    (1, "1. 0< y <= 10UF"),
    (2, "2. 10 < y <= 25UF"),
    (3, "3. 25 < y <= 50UF"),
    (4, "4. 50 < y  <= 100UF"),
    (5, "5. 100 < y <= 250UF"),
    (6, "6. 250 < y <= 500UF"),
    (7, "7. 500 < Y <= 1000UF"),
    (8, "8. 1000 < Y <= 2000UF"),
    (9, "9. 2000 < Y <= 10000UF"),
    (10, "10. 10000UF <"),
]

# Words that mark a meeting as not held.
CANCELLED_WORDS = ["cancelada", "eliminada", "pospuesta", "reagendada", "suspendida", "postergada",
                   "cancelado", "eliminado", "pospuesto", "reagendado", "suspendido", "postergado"]


def zone(c, zones: dict[str, Sequence[str]] = ZONES) -> F.Column:
    """C4: zone from a list of names per zone (the later list wins where two lists share a name)."""
    col = F.col(c) if isinstance(c, str) else c
    return first_rule([(col.isin(list(v)), k) for k, v in reversed(list(zones.items()))], None)


def member_staging(socios: DataFrame, renames: dict[str, str], casts: dict[str, list[str]] | None = None,
                   zones: dict[str, Sequence[str]] = ZONES, entity_word: str = "Entidad") -> DataFrame:
    """Lowercase names (P3), renames (P2), upper state (X1), entity flag from text (F8),
    fills (C5), zone (C4), hashed id (X13), casts (P8). ``is_entidad`` is 'SI' or null as in the
    source job, which fills ``entidad`` instead."""
    df = rename(lower_names(socios), renames)
    df = df.withColumns({
        "estado": F.upper("estado"),
        "is_entidad": F.when(F.col("actividades").contains(entity_word), "SI"),
    })
    df = df.fillna({"comite_principal": "Sin Comité Principal", "entidad": "NO"})
    df = df.withColumns({"zona": zone("camara", zones), "rut_hash": sha256_text("rut")})
    return cast_columns(df, casts or {})


# Role numbers of chamber staff, and the group whose active members may be councillors.
STAFF_ROLES = (75, 112)
COUNCIL_GROUP = "Consejo Regional"


def person_record(personas: DataFrame, gender_map: DataFrame, members: DataFrame, roles: DataFrame, as_of) -> DataFrame:
    """B31 (T1, C1, F8, J8, X12, J3, T8, F12, X7, X5): dates parsed (bad text -> null); deceased flag; councillor (active member of
    the council group with an active role other than 75 in an active company), staff (role 75 or 112) and member
    relation (any active role in an active company) flags; first name folded and looked up in a gender
    map; tenure and age as half-even rounded years; birth-date validity (18-120, null counts as valid); full name
    with null parts as empty and single spaces."""
    df = personas.withColumns({
        **{c: F.col(c).try_cast("date") for c in ("fecha_creacion", "fecha_nacimiento", "fecha_defuncion")},
        "primer_nombre": first_word("nombre")})
    df = df.withColumn("is_difunto", F.when(F.col("fecha_defuncion").isNotNull(), "SI").otherwise("NO"))
    council = members.where((F.col("estado_participacion") == "ACTIVA") & (F.col("estado_grupo") == "ACTIVA")
                            & (F.col("nombre_grupo") == COUNCIL_GROUP)).select(F.col("per_id").try_cast("bigint").alias("per_id"))
    active = roles.where((F.col("estado_relacion") == "ACTIVA") & (F.col("estado_socio") == "Activo"))
    df = exists_flag(df, council, "per_id", "__council")
    df = exists_flag(df, active.where(F.col("id_rol") != STAFF_ROLES[0]), "per_id", "__role")
    df = df.withColumn("is_consejero_regional", F.col("__council") & F.col("__role")).drop("__council", "__role")
    df = exists_flag(df, roles.where(F.col("id_rol").isin(*STAFF_ROLES)), "per_id", "is_personal_camara")
    df = exists_flag(df, active, "per_id", "is_relacionado_socio")
    gm = first_by(gender_map.select(first_word("nombre").alias("primer_nombre"), "sexo_inferido"),
                  ["primer_nombre"], order_by="sexo_inferido")
    df = df.join(gm, "primer_nombre", "left")
    df = df.withColumns({
        "antiguedad_camara": years_between("fecha_creacion", as_of),
        "edad": years_between("fecha_nacimiento", as_of),
    })
    df = df.withColumns({
        "is_fecha_nacimiento_valida": in_range_or_null("edad", 18, 120),
        "nombre_completo": full_name("nombre", "apellido_paterno", "apellido_materno"),
    })
    return df.drop("primer_nombre")


# Output names of the working-group members.
GROUP_MEMBER_NAMES = {
    "gru_nom": "nombre_grupo", "per_det_raz_soc_5": "razon_social", "pre_reg_nro_7": "nro_registro", "pre_reg_cuo_8": "cuota",
    "per_tipo_9": "tipo_persona", "car_gre_nom_18": "cargo_gremial", "prs_fec_nac_23": "persona_fecha_nacimiento",
    "dir_calle_24": "direccion_calle", "dir_nro_25": "direccion_numero", "sclr_29": "telefono_1", "sclr_30": "telefono_2",
    "sclr_31": "correo"}


def working_group_members(df: DataFrame, maternal: str = "per_ape_mat_15") -> DataFrame:
    """B32 (P3, X7, X14, X5, P2, P8): assembled names and ``number-dv`` ids, renames, person type and registry number as
    nullable integers, the number again as ``id_socio``, street and number as one address with single spaces.
    The source uses the same maternal surname column for both names; it is a parameter here. Both versions of the export."""
    df = lower_names(df)
    number = {c: F.col(c).try_cast("int").cast("string") for c in ("per_rut_3", "per_rut_16")}
    df = df.withColumns({
        "socio_nombre": full_name("per_nom_0", "per_ape_pat_1", maternal),
        "rut": tax_id_with_dv(F.col("per_rut_3").try_cast("int"), "per_dv_4"),
        "persona_nombre": full_name("per_nom_11", "per_ape_pat_12", maternal),
        "persona_rut": tax_id_with_dv(F.col("per_rut_16").try_cast("int"), "per_dv_17"),
        "organo_gremial": F.col("gru_nom"),
    })
    df = rename(df.withColumns(number), GROUP_MEMBER_NAMES)
    if "tipo_persona" in df.columns:
        df = df.withColumn("tipo_persona", F.col("tipo_persona").try_cast("int"))
    if "nro_registro" in df.columns:
        df = df.withColumn("nro_registro", F.col("nro_registro").try_cast("bigint")).withColumn("id_socio", F.col("nro_registro"))
    if {"direccion_calle", "direccion_numero"} <= set(df.columns):
        df = df.withColumn("direccion", full_name("direccion_calle", "direccion_numero"))
    return df


def attendance(df: DataFrame) -> DataFrame:
    """B34 (W4, F8, C5): meetings held on several dates of a year lose that year's earliest date (the
    source job runs one year at a time); attendance text; period text; meeting names with a cancelled
    word are invalid."""
    df = drop_earliest_dup(df, ["reuid", "year"], "reufecini")
    return df.withColumns({
        "str_asistencia": F.when(F.col("asiasis").cast("int") == 1, "SI").otherwise("NO"),
        "periodo": F.concat(F.col("year").cast("string"), F.col("month").cast("string")),
        "is_nombre_valido": F.when(contains_any("reunom", CANCELLED_WORDS), False).otherwise(True),
        "sexo": F.col("sexo").try_cast("double").cast("int"),
    })


def attendance_rolling(df: DataFrame, as_of, months: int = 12, full_load: bool = False) -> DataFrame:
    """B35 (T18, F8, C5): the daily attendance report: only (year, month) partitions from
    ``as_of`` minus ``months`` on (pruned at the scan), cancelled-word flag, attendance and period text,
    sex code as a nullable integer."""
    from tidewater.functions.dates import partitions_since
    df = df.where(partitions_since(as_of, months=months, full_load=full_load))
    return df.withColumns({
        "str_asistencia": F.when(F.col("asiasis").cast("int") == 1, "SI").otherwise("NO"),
        "periodo": F.concat(F.col("year").cast("string"), F.col("month").cast("string")),
        "is_nombre_valido": F.when(contains_any("reunom", CANCELLED_WORDS), False).otherwise(True),
        "sexo": F.col("sexo").try_cast("double").cast("int"),
    })


def roles_staging(df: DataFrame) -> DataFrame:
    """B29 (X13, P8, T6): hashed id, nullable integer ids, relation date truncated to a date."""
    df = lower_names(df).withColumn("rut_hash", sha256_text("rut"))
    df = cast_columns(df, {"bigint": ["numero_socio", "id_relacion"]})
    return df.withColumn("fecha_relacion", F.to_date("fecha_relacion"))


def requests_staging(df: DataFrame) -> DataFrame:
    """B36 (T6, P8): request dates as dates, member number as a nullable integer."""
    df = lower_names(df).withColumns({"fecha": F.to_date("fecha"), "fecha_resolucion": F.to_date("fecha_resolucion")})
    return cast_columns(df, {"bigint": ["numero_socio"]})


def positions(positions_df: DataFrame, senior: DataFrame) -> DataFrame:
    """B33 (S6, K10, F5, J8): positions flagged when their id is listed as a senior position
    (rows of the ``;`` export whose ``Cargo_Directivo`` is not null)."""
    from tidewater.functions.names import clean_names
    listed = senior.where(F.col("Cargo_Directivo").isNotNull()).select(F.col("IdCargo").try_cast("bigint").alias("idcargo"))
    df = clean_names(positions_df)
    flagged = listed.distinct().withColumn("es_alto_cargo", F.lit(True))
    return df.join(flagged, "idcargo", "left")


def pass_through(df: DataFrame, renames: dict[str, str] | None = None, lower: bool = True) -> DataFrame:
    """B21 (S1, P2, P3, K1): tables copied with lowercased and renamed columns only."""
    out = lower_names(df) if lower else df
    return rename(out, renames or {})


def group_names(df: DataFrame, short: int = 90) -> DataFrame:
    """B30 (F11, X9): every group, with a flag for descriptions shorter than ``short`` (null: not short) and their length."""
    size = F.length("descripcion")
    return df.withColumns({"is_descripcion_corta": F.coalesce(size < short, F.lit(False)), "largo_descripcion": size})


__all__ = ["collapse_spaces"]
