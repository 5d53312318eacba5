"""Finance and procurement jobs: tenders staging (B24), purchase orders staging (B25),
financial summary fact (B26), budget comments load (B27)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.dates import MONTHS_ES, as_date, parse_date, period_label, yyyymm
from tidewater.functions.names import cast_columns, lower_names, rename, rename_positional
from tidewater.functions.numbers import local_number, round_half_even_int, tax_inclusive
from tidewater.functions.rules import later_wins
from tidewater.functions.text import capitalize_first, nan_to_null, split_part
from tidewater.operators.relational import lookup_join
from tidewater.sources.readers import literal_table, typed_ingest

TENDER_AMOUNTS = ["cantidad_adjudicada", "presupuesto", "total_adjudicado", "precio_unitario"]
TENDER_DATES = ["cierre", "publicacion", "adjudicacion"]
TENDER_TEXTS = ["lic_nombre", "lic_descrip", "stenderclientfullname", "fullname", "competidor"]


def tenders_staging(df: DataFrame, date_format: str = "dd-MM-yyyy") -> DataFrame:
    """B24 (P3, M2, M1, T1, X2, T3, T4): lowercase names; local-format amounts parsed and
    rounded half-to-even to integers (bad text -> null); the date part (before the first
    space) parsed with ``date_format``; names capitalised (first letter only); award period
    ``yyyyMM`` and its Spanish short label."""
    df = lower_names(df)
    df = df.withColumns({c: round_half_even_int(local_number(c)).cast("bigint") for c in TENDER_AMOUNTS if c in df.columns})
    df = df.withColumns({c: parse_date(split_part(c, " ", 1), date_format) for c in TENDER_DATES if c in df.columns})
    df = df.withColumns({c: capitalize_first(c) for c in TENDER_TEXTS if c in df.columns})
    df = df.withColumn("periodo_num", yyyymm("adjudicacion"))
    return df.withColumns({"periodo_str": period_label("periodo_num"), "periodo": period_label("periodo_num")})


def purchase_orders_staging(spark: SparkSession, df: DataFrame, names: Sequence[str],
                            families: Mapping[str, list[str]], date_cols: Sequence[str], projects: DataFrame,
                            date_format: str = "yyyy-MM-dd", net_col: str = "total_neto",
                            tax_code_col: str = "codigo_impuesto", date_for_month: str = "fecha_cont_em",
                            status_col: str = "estatus_pedido") -> DataFrame:
    """B25 (P4, P8, X15, T1, M3, C2, T5, J3), shared by both companies: positional names with a
    width check; typed casts by family (bad values -> null); text ``'nan'`` -> null on string
    columns; dates parsed; a null tax code becomes ``_``; tax-inclusive total; order state as text; year, month and Spanish month name (literal
    month table joined); project names looked up (``proyecto_pedido`` -> ``proyecto``)."""
    df = rename_positional(df, list(names))
    df = cast_columns(df, families)
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    df = df.withColumns({c: nan_to_null(c) for c in strings})
    df = df.withColumns({c: parse_date(c, date_format) for c in date_cols if c in df.columns})
    df = df.withColumn(tax_code_col, F.coalesce(tax_code_col, F.lit("_")))
    df = df.withColumn("total_con_impuesto", tax_inclusive(net_col, tax_code_col))
    if status_col in df.columns:
        df = df.withColumn("dsc_estatus_pedido", F.when(F.col(status_col) == "O", "Pedido Abierto").otherwise("Pedido Cerrado"))
    df = df.withColumns({f"{date_for_month}_year": F.year(date_for_month),
                         f"{date_for_month}_month": F.month(date_for_month)})
    months = literal_table(spark, [(i + 1, m) for i, m in enumerate(MONTHS_ES)],
                           f"{date_for_month}_month int, {date_for_month}_mes_spa string")
    df = df.join(months, f"{date_for_month}_month", "left")
    proj = projects.select("proyecto_pedido", "proyecto")
    return lookup_join(df, proj, "proyecto_pedido", select=["proyecto"])


# Project-code prefixes; a later rule overwrites an earlier one.
PROJECT_RULES = [("FR", "Fondo Regional"), ("FN", "Proyecto impacto"), ("FRN", "Fondo Regional/Proyecto impacto")]
UNKNOWN_KEY = 99999999
CONVERTED = ["debit_lc_uf", "credit_lc_uf", "debit_sc_uf", "credit_sc_uf",
             "debit_lc_usd", "credit_lc_usd", "debit_sc_usd", "credit_sc_usd"]


def financial_summary(ledger: DataFrame, accounts: DataFrame, chambers: DataFrame, time: DataFrame,
                      currency: DataFrame, committees: DataFrame, chamber_codes: DataFrame, as_of) -> DataFrame:
    """B26 (S2, J15, C3, P6): ledger lines to dimension keys with an unknown member (99999999).

    The chamber code is mapped to a chamber name (upper-cased) and on to its id; time, account and
    committee keys are looked up; every unmatched key becomes 99999999 (account ids are text). The
    converted amounts are constant 0, as in the source job, where the currency rates are joined
    but never used (the join is kept: if rates repeat per date it multiplies rows, as the source
    does). ``is_project`` comes from project-code prefixes where a later rule wins.
    ``fecha_creacion`` / ``fecha_actualizacion`` are ``as_of`` (no clock reads).
    """
    codes = chamber_codes.select(F.upper("camara").alias("camara"), F.col("id_camara_sap").alias("distributionrulecode1"))
    df = lookup_join(ledger, codes, "distributionrulecode1", select=["camara"])
    df = df.withColumnRenamed("distributionrulecode1", "codigo_sap")
    t = time.select(F.col("id").alias("id_fecha"), F.to_date("date").alias("__d"))
    df = df.withColumn("__d", F.to_date("postingdate"))
    df = lookup_join(df, t, "__d", select=["id_fecha"])
    acc = accounts.select(F.col("codigo").alias("id_cuenta_sap"), F.col("codigo").alias("accountcode"))
    df = lookup_join(df, acc, "accountcode", select=["id_cuenta_sap"])
    ch = chambers.select(F.col("id").alias("id_camara"), F.col("descripcion").alias("camara"))
    df = lookup_join(df, ch, "camara", select=["id_camara"])
    cur = currency.select(F.to_date("fecha").alias("__d"), "uf", "dolar")
    df = lookup_join(df, cur, "__d", select=["uf"])
    com = committees.select(F.col("id").alias("id_comite"), F.col("codigo_sap"))
    df = lookup_join(df, com, "codigo_sap", select=["id_comite"],
                     defaults={"id_comite": UNKNOWN_KEY})
    df = df.withColumns({"id_camara": F.coalesce("id_camara", F.lit(UNKNOWN_KEY)),
                         "id_cuenta_sap": F.coalesce(F.col("id_cuenta_sap").cast("string"), F.lit(str(UNKNOWN_KEY)))})
    pc = F.col("projectcode")
    df = df.withColumn("is_project", later_wins([(pc.startswith(p), label) for p, label in PROJECT_RULES], None))
    stamp = as_date(as_of).cast("timestamp_ntz")
    df = df.withColumns({**{c: F.lit(0) for c in CONVERTED}, "fecha_creacion": stamp, "fecha_actualizacion": stamp})
    df = df.withColumnRenamed("accountcode", "id")
    return df.select("id", "id_fecha", "id_camara", "id_cuenta_sap", "id_comite", "debit_lc", "credit_lc",
                     "credit_sc", "debit_sc", *CONVERTED, "fecha_creacion", "fecha_actualizacion", "is_project", "year")


def budget_comments(spark: SparkSession, path: str, schema: StructType | str, sep: str = ";") -> DataFrame:
    """B27 (S7, K10): a sheet export read by declared schema with cleaned column names."""
    return typed_ingest(spark, path, schema, sep=sep)


__all__ = ["rename"]
