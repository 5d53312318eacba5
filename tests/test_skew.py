"""Hot keys: one key holding a third of all rows is split by AQE in joins and reduced map-side in
aggregations and version selection (no single task receives the whole hot group)."""

from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tidewater.operators.relational import lookup_join
from tidewater.operators.versions import latest_by

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark, n=30000):
    # a third of the rows carry key 0, the rest are spread over 1000 keys
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1)
                                 .alias("k"), F.col("id").alias("v"))


def test_hot_key_join_is_split(spark):
    old = _with_conf(spark, SKEW_CONF)
    try:
        fact = _skewed(spark)
        dim = spark.range(0, 1001).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
        out = lookup_join(fact, dim, "k", select=["w"])
        assert len(out.collect()) == 30000          # runs this DataFrame's own adaptive plan
        final = plan_text(out)
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        _restore(spark, old)


def test_hot_key_version_selection_and_aggregation(spark):
    fact = _skewed(spark)
    picked = latest_by(fact, ["k"], "v")
    assert rows(picked.where("k = 0")) == [(0, 29997)]
    plan = plan_text(picked)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    agg = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert "partial_count" in plan_text(agg)
    assert rows(agg.where("k = 0")) == [(0, 10000)]
