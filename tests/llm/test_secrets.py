"""The randomness battery and its false-discovery control against versions in plain Python."""

import math
import random

from pyspark.sql import functions as F

from tidewater.llm import secrets

LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def tail(z):
    return 1 / (1 + math.exp(min(max(1.5976 * z + 0.070565992 * z ** 3, -700), 700)))


def battery(run, alphabet):
    """The three tests as their textbook formulas say, joined by Fisher's method."""
    k, v = len(alphabet), [alphabet.index(c) for c in run]
    n = len(v)
    m = max(2, min(k, n // 5))
    stat = 0.0
    for j in range(m):
        want = n * (math.ceil((j + 1) * k / m) - math.ceil(j * k / m)) / k
        seen = sum(c * m // k == j for c in v)
        stat += (seen - want) ** 2 / want
    f = m - 1
    p_chi = tail(((stat / f) ** (1 / 3) - (1 - 2 / (9 * f))) / math.sqrt(2 / (9 * f)))
    high = [2 * c >= k for c in v]
    up = sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 1 + 2 * up * (n - up) / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = 2 * tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 0.0
    dot = sum((a - (k - 1) / 2) * (b - (k - 1) / 2) for a, b in zip(v, v[1:]))
    p_serial = 2 * tail(abs(dot) / ((k * k - 1) / 12) / math.sqrt(n))
    h = -sum(math.log(max(min(p, 1.0), 1e-300)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-h) * (1 + h + h * h / 2)


def test_battery_is_that_of_plain_python(spark):
    r = random.Random(1)
    cases = []
    for name, alphabet in secrets.ALPHABETS.items():
        for n in (16, 17, 20, 33, 64, 200):
            cases += [(name, "".join(r.choice(alphabet) for _ in range(n))), (name, "".join(sorted(r.choice(alphabet) for _ in range(n)))), (name, alphabet[1] * n)]
    got = spark.createDataFrame(cases, "e string, s string").select("e", "s", secrets._battery(F.col("s"), F.col("e")).alias("p")).collect()
    for x in got:
        assert math.isclose(x.p, battery(x.s, secrets.ALPHABETS[x.e]), rel_tol=1e-6, abs_tol=1e-250), x


def test_rare_keys_among_very_many_ordinary_runs():
    """500 keys among 1,000,000 ordinary runs, 20,000 control words: the keys are found at the stated rate."""
    r = random.Random(2)
    place = lambda s: max(0, math.floor((s - secrets.LOWEST) / secrets.BIN))
    ordinary = lambda: -14 - r.expovariate(0.5) + r.expovariate(1.2)
    controls, runs, planted = {}, {}, []
    for _ in range(20_000):
        b = place(ordinary())
        controls[b] = controls.get(b, 0) + 1
    for _ in range(1_000_000):
        b = place(ordinary())
        runs[b] = runs.get(b, 0) + 1
    for _ in range(500):
        planted.append(place(math.log(r.random())))
        runs[planted[-1]] = runs.get(planted[-1], 0) + 1
    least = secrets.cut(controls, runs)
    found, kept = sum(n for b, n in runs.items() if b >= least), sum(b >= least for b in planted)
    assert kept >= 475 and found - kept <= secrets.SHARE * found
    # where ordinary runs score as high as keys, a class is cut above them or not reported
    close = {place(-3 - r.expovariate(1)): 0 for _ in range(50)}
    close = {b: 1 + r.randrange(40) for b in close}
    many = {b: 60 * n for b, n in close.items()}
    many[place(-0.1)] = many.get(place(-0.1), 0) + 3
    assert secrets.cut(close, many) is None or secrets.cut(close, many) > max(close)
    assert secrets.cut({place(-9.0): secrets.CONTROLS - 1}, runs) is None and secrets.cut(controls, {}) is None


def test_keys_are_found_among_slugs(spark):
    r = random.Random(3)
    stems = [a + b for a in ("con", "re", "inter", "trans", "counter", "hyper") for b in ("national", "formation", "struction", "positional", "administered")]
    words = lambda k: "".join(r.choice(stems) for _ in range(k))
    rows = [(i, " ".join([words(2)[:40]] + [f"{r.choice(stems)}-{r.choice(stems)}_{r.choice(stems)}/{i}" for _ in range(4)])) for i in range(4000)]
    keys = {9000 + i: "".join(r.choice(LETTERS) for _ in range(32)) for i in range(40)}
    digits = {9500 + i: "".join(r.choice(LETTERS[:10]) for _ in range(32)) for i in range(20)}
    rows += [(i, f"value {k} ends") for i, k in {**keys, **digits}.items()]
    found = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", F.filter("spans", lambda s: s["kind"] == 3).alias("s")).where(F.size("s") > 0)
    hit = {x.doc_id for x in found.collect()}
    assert len(hit & set(keys)) >= 36 and len(hit & set(digits)) >= 17
    assert len(hit - set(keys) - set(digits)) <= 0.05 * len(hit) + 1
