"""Run monitoring jobs: process status report (B11), daily error report.

The reference calls run-history and metrics services; here both read run-log tables
(one row per run / per function-day metric) so the work is a Spark job over data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import seconds_between, truncate_to_date
from tidewater.functions.nested import map_column
from tidewater.functions.names import clean_names, rename
from tidewater.functions.text import ColumnOrName, _c, split_part
from tidewater.operators.versions import latest_by

# Run states replaced by report symbols, in this order.
STATUS_SYMBOLS = [("SUCCEEDED", "✅"), ("FAILED", "❌"), ("ABORTED", "⊗"), ("RUNNING", "🏃")]
ERROR_SYMBOL, OK_SYMBOL = "❌", "✅"


def status_symbol(c: ColumnOrName) -> Column:
    """Replace each known state word by its symbol; other text is left as it is."""
    out = _c(c)
    for word, symbol in STATUS_SYMBOLS:
        out = F.replace(out, F.lit(word), F.lit(symbol))
    return out


def process_report(runs: DataFrame, names: dict[str, str]) -> DataFrame:
    """B11 (W3, J19, K10, X6, T16, X4): the latest run of each process (by start, ties on stop),
    its display name from a literal map, the state-machine name (last ``:`` piece of the id),
    start, stop, duration in seconds (null while running) and the state symbol."""
    runs = clean_names(runs)
    last = latest_by(runs, ["statemachinearn"], order_by="startdate", tie_break="stopdate")
    last = map_column(last, "statemachinearn", names, "nombre_proceso")
    out = last.select(
        "nombre_proceso", split_part("statemachinearn", ":", -1).alias("Statemachine"),
        "startdate", "stopdate", seconds_between("stopdate", "startdate").alias("Duración"), "status")
    out = rename(out, {"nombre_proceso": "Nombre Proceso / Fuente", "status": "Estado",
                       "startdate": "Inicio", "stopdate": "Fin"})
    return out.withColumn("Estado", status_symbol("Estado"))


def daily_errors(metrics: DataFrame, names: dict[str, str]) -> DataFrame:
    """B12 (A1, T6, C9): error sum per function and day; ❌ when the sum is positive, else ✅."""
    per_day = (metrics.groupBy("function", truncate_to_date("Timestamp").alias("Fecha de ejecución"))
               .agg(F.sum("Sum").alias("Cantidad de errores")))
    per_day = map_column(per_day, "function", names, "Nombre Proceso")
    return per_day.select(
        "Nombre Proceso", F.col("function").alias("Nombre Función"), "Cantidad de errores", "Fecha de ejecución",
        F.when(F.col("Cantidad de errores") > 0, ERROR_SYMBOL).otherwise(OK_SYMBOL).alias("Estado"))
