"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins at runtime from measured
# shuffle sizes (a proven bound for broadcasting), coalesces small partitions
# and splits skewed ones; the session time zone is pinned so dates derived from
# timestamps do not depend on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tidewater",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests pass
    ``local[*]``. ``shuffle_partitions`` should be sized so one partition fits
    an executor task (about 128-256 MB of shuffle data each); AQE coalesces the
    excess at runtime.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that setting
    wins. Only when nothing is configured and the master is local is a fresh folder
    under the system temp directory used; any other master raises, because its executors
    do not see the driver's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables.

    Used to cut lineage with a written table and for write/read round trips;
    never a machine-local folder when the cluster names a shared one.
    """
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: "DataFrame", name: str) -> "DataFrame":
    """``df`` written once into the shared folder and read back: cuts the lineage, and later passes read what was written."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temp_views(spark: SparkSession, frames: dict[str, "DataFrame"]):
    """Register frames as temp views under unique names for one ``spark.sql`` call.

    Yields ``{name: unique_view_name}``; the views are dropped on exit (``spark.sql`` resolves
    them when the statement is analysed, so the returned DataFrame keeps working). Unique names
    keep concurrent jobs in one session from replacing each other's views.
    """
    suffix = uuid.uuid4().hex[:8]
    names = {k: f"{k}_{suffix}" for k in frames}
    for k, df in frames.items():
        df.createOrReplaceTempView(names[k])
    try:
        yield names
    finally:
        for v in names.values():
            spark.catalog.dropTempView(v)
