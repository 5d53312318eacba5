import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="tidewater-tests-")
    session = (SparkSession.builder.master("local[*]").appName("tidewater-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidewater-t-")


def rows(df, *cols):
    """Sorted list of tuples (None-safe) for comparisons."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def plan_text(df):
    """The physical plan as printed by ``explain()``."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
