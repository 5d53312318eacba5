"""The densified grid with small and large dimensions, its plan, and exact distinct counts under a hot key."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tidewater.operators import densify_sum, distinct_counts
from tidewater.operators import reshape


def brute(data):
    kept = [r for r in data if None not in r[:4]]
    dims = [sorted({r[k] for r in data if r[k] is not None}) for k in range(3)]
    years = [r[3] for r in data if r[3] is not None]
    out = {k: (0, 0.0) for k in itertools.product(*dims, range(min(years), max(years) + 1))}
    for *k, v, w in kept:
        a, b = out[tuple(k)]
        out[tuple(k)] = (a + (v or 0), b + (w or 0.0))
    return sorted(((*k, *v) for k, v in out.items()), key=repr)


@pytest.mark.parametrize("limits", [(2048, 1 << 18, 8192), (3, 1 << 18, 8192), (0, 0, 4), (2048, 4, 5), (4, 1 << 18, 1), (2048, 1 << 18, 7)])
def test_grid_with_small_and_large_dimensions(spark, monkeypatch, limits):
    for name, value in zip(("SMALL_VALUES", "SMALL_BYTES", "CHUNK"), limits, strict=True):
        monkeypatch.setattr(reshape, name, value)
    r = random.Random(sum(limits))
    data = [(r.choice(["a", "b", None]), r.choice([10, 20, 30, 40]), r.choice(["p", "q", "ñ", "ss", "t", None]), r.choice([2020, 2021, 2024, None]), r.choice([1, 2, None]), r.choice([0.5, 2.0])) for _ in range(60)]
    df = spark.createDataFrame(data, "s string, t int, u string, ano int, v long, w double")
    assert rows(densify_sum(df, ["s", "t", "u"], "ano", ["v", "w"])) == brute(data)
    one = data[:1] if None not in data[0][:4] else [("a", 10, "p", 2020, 1, 0.5)]
    assert rows(densify_sum(spark.createDataFrame(one, df.schema), ["s", "t", "u"], "ano", ["v", "w"])) == brute(one)
    assert densify_sum(df.limit(0), ["s", "t", "u"], "ano", ["v", "w"]).collect() == []
    assert densify_sum(df.where("s is null"), ["s", "t", "u"], "ano", ["v", "w"]).collect() == []


def test_the_grid_is_made_behind_the_last_exchange(spark):
    df = spark.createDataFrame([("a", 1, 2000, 1), ("b", 2, 2400, 5)], "s string, t int, ano int, v long")
    out = densify_sum(df, ["s", "t"], "ano", "v")
    lines = plan_text(out).splitlines()
    at = next(k for k, line in enumerate(lines) if "+- Generate explode" in line or "+- *" in line and "Generate explode" in line)
    depth, above = lines[at].index("+-"), []
    for line in reversed(lines[:at]):
        if "+-" in line and line.index("+-") < depth:
            depth = line.index("+-")
            above.append(line)
    assert above and not any("Join" in line or "Exchange" in line for line in above)
    assert any("Exchange" in line for line in lines[at:])
    assert out.count() == 2 * 2 * 401 and out.agg(F.sum("v")).first()[0] == 6


def test_distinct_counts_of_a_hot_key(spark):
    r = random.Random(4)
    data = [("hot" if i % 3 else f"k{r.randrange(20)}", r.choice([None, r.randrange(900)]), r.choice(["x", "y", None])) for i in range(6000)]
    data += [("void", None, None), (None, 1, "x")]
    df = spark.createDataFrame(data, "k string, a int, b string")
    out = distinct_counts(df, ["k"], ["a", "b"])
    want = df.groupBy("k").agg(F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b"))
    assert rows(out) == rows(want) and ("void", 0, 0) in rows(out)
    assert rows(distinct_counts(df, ["k"], ["a"], drop_null_keys=True)) == rows(want.where("k is not null").select("k", "n_a"))
    exchanges = [line for line in plan_text(distinct_counts(df, ["k"], ["a", "b"])).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "v0" not in exchanges[0] and "v0" in exchanges[1]
