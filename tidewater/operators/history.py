"""Snapshot history merge (B22: J10, J11, U2, X16, D3, J3).

History holds one row per process; a snapshot lists the processes that are open
today. The merge, all as joins on keys (no driver-side lists):

1. key = ``coalesce(id, prefix || alt_id)`` on both sides (X16);
2. finished keys = keys open in history (``done`` null) and absent from the snapshot (anti join);
3. history rows matching a finished key get ``done = true`` and ``ended = as_of``;
4. snapshot rows whose key is not open in history are appended (anti join + union by name);
5. optionally, registry attributes of the appended ids are left-joined (active registry
   rows, last per id by ``registry_order``), merged into existing columns with ``coalesce``.

As written in the source job, step 3 matches history rows by ``id`` (``finished_by="id"``),
so rows that only have a fallback key never finish, and rows already finished with the same
id are stamped again. ``finished_by="key", open_only=True`` is the corrected variant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import as_date
from tidewater.functions.text import fallback_key
from tidewater.operators.versions import latest_by


def snapshot_merge(history: DataFrame, snapshot: DataFrame, as_of, *, id_col: str = "rut", alt_col: str = "rol",
                   prefix: str = "CORRECCION:", done_col: str = "proceso_finalizado",
                   ended_col: str = "fecha_ejecucion", finished_by: str = "id", open_only: bool = False,
                   registry: DataFrame | None = None, registry_cols: Sequence[str] = (),
                   registry_filter=None, registry_order=None) -> DataFrame:
    h = history.withColumn("__key", fallback_key(id_col, alt_col, prefix))
    s = snapshot.withColumn("__key", fallback_key(id_col, alt_col, prefix))
    open_keys = h.where(F.col(done_col).isNull()).select("__key").distinct()
    snap_keys = s.select("__key").distinct()
    finished = open_keys.join(snap_keys, "__key", "left_anti").withColumn("__fin", F.lit(True))

    match_col = id_col if finished_by == "id" else "__key"
    fin = finished.select(F.col("__key").alias("__fkey"), "__fin")
    h = h.join(fin, h[match_col] == fin["__fkey"], "left").drop("__fkey")
    stamp = F.col("__fin").eqNullSafe(True)
    if open_only:
        stamp = stamp & F.col(done_col).isNull()
    ended_type = dict(history.dtypes).get(ended_col, "string")
    h = h.withColumns({
        ended_col: F.when(stamp, F.date_format(as_date(as_of), "yyyy-MM-dd").cast(ended_type)).otherwise(F.col(ended_col)),
        done_col: F.when(stamp, F.lit(True)).otherwise(F.col(done_col)),
    }).drop("__fin")

    added = s.join(open_keys, "__key", "left_anti")
    merged = h.unionByName(added, allowMissingColumns=True)

    if registry is not None:
        reg = registry if registry_filter is None else registry.where(registry_filter)
        new_ids = added.select(F.col("__key").alias(id_col)).distinct()
        reg = reg.join(new_ids, id_col, "left_semi")
        if registry_order is not None:
            reg = latest_by(reg, [id_col], registry_order)
        reg = reg.select(id_col, *[F.col(c).alias(f"__r_{c}") for c in registry_cols])
        merged = merged.join(reg, id_col, "left")
        merged = merged.withColumns({
            c: (F.coalesce(F.col(f"__r_{c}"), F.col(c)) if c in merged.columns else F.col(f"__r_{c}"))
            for c in registry_cols}).drop(*[f"__r_{c}" for c in registry_cols])
    return merged.drop("__key")
