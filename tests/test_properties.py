"""Property tests: operators against brute-force Python answers on random small inputs
(nulls and ties included)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from tidewater.operators.relational import branch_counts
from tidewater.operators.reshape import densify_sum, key_batches
from tidewater.operators.versions import drop_earliest_dup, latest_by

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["a", "b", "c", None])
small = st.integers(min_value=0, max_value=4)
maybe_small = st.one_of(st.none(), small)


@settings(**SETTINGS)
@given(st.lists(st.tuples(keys, maybe_small), min_size=0, max_size=25))
def test_latest_by_matches_brute_force(spark, data):
    df = spark.createDataFrame([(k, o, i) for i, (k, o) in enumerate(data)], "k string, o int, id int")
    got = rows(latest_by(df, ["k"], "o", "id"), "k", "id")
    best = {}
    for i, (k, o) in enumerate(data):
        rank = (o is not None, o if o is not None else 0, i)   # DESC NULLS LAST, then id DESC
        if k not in best or rank > best[k][0]:
            best[k] = (rank, i)
    assert got == sorted(((k, v[1]) for k, v in best.items()), key=repr)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.one_of(st.none(), st.integers(1, 4))), max_size=25))
def test_drop_earliest_dup_matches_brute_force(spark, data):
    df = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(data)], "k int, d int, id int")
    got = rows(drop_earliest_dup(df, "k", "d"), "id")
    dates = {}
    for k, d in data:
        if k is not None and d is not None:
            dates.setdefault(k, set()).add(d)
    drop = {(k, min(ds)) for k, ds in dates.items() if len(ds) > 1}
    assert got == sorted(((i,) for i, (k, d) in enumerate(data) if (k, d) not in drop), key=repr)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from(["p", "q"]),
                          st.integers(2020, 2023), st.integers(0, 9)), min_size=1, max_size=20))
def test_densify_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "s string, r string, ano int, v long")
    got = rows(densify_sum(df, ["s", "r"], "ano", "v"))
    ss = {s for s, _, _, _ in data if s is not None}
    rs = {r for _, r, _, _ in data}
    years = range(min(a for *_, a, _ in data), max(a for *_, a, _ in data) + 1)
    sums = {}
    for s, r, a, v in data:
        if s is not None:
            sums[(s, r, a)] = sums.get((s, r, a), 0) + v
    expected = sorted(((s, r, a, sums.get((s, r, a), 0)) for s in ss for r in rs for a in years), key=repr)
    assert got == expected


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 500), max_size=80), st.integers(1, 7))
def test_key_batches_matches_brute_force(spark, values, size):
    df = spark.createDataFrame([(v,) for v in values], "k int")
    got = sorted((r["grupo"], r["claves"]) for r in key_batches(df, "k", size=size).collect())
    ks = sorted(set(values))
    expected = [(i // size, ",".join(str(k) for k in ks[i:i + size])) for i in range(0, len(ks), size)]
    assert got == expected


@settings(**SETTINGS)
@given(st.lists(st.sampled_from([1, 2, 3]), max_size=10), st.lists(st.sampled_from([1, 2, 4]), max_size=10))
def test_branch_counts_fan_out_equals_chained_left_joins(spark, a, b):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    ca = spark.createDataFrame([(x,) for x in a], "k int")
    cb = spark.createDataFrame([(x,) for x in b], "k int")
    got = rows(branch_counts(parent, "k", {"a": (ca, "k"), "b": (cb, "k")}, keep_any=False, fan_out=True))
    expected = []
    for k in (1, 2, 3):
        na, nb = a.count(k), b.count(k)
        # COUNT(a.id), COUNT(b.id) over parent LEFT JOIN a LEFT JOIN b
        expected.append((k, na * max(nb, 1), nb * max(na, 1)))
    assert got == sorted(expected, key=repr)


from tidewater.operators.history import snapshot_merge  # noqa: E402
from tidewater.operators.reshape import rollup_rows  # noqa: E402

ids = st.sampled_from(["r1", "r2", "r3", None])
rols = st.sampled_from(["a", "b", "c"])


def _brute_merge(hist, snap, as_of):
    key = lambda rut, rol: rut if rut is not None else "CORRECCION:" + rol
    open_keys = {key(r, o) for r, o, done in hist if done is None}
    snap_keys = {key(r, o) for r, o in snap}
    finished = open_keys - snap_keys
    out = []
    for r, o, done in hist:
        hit = r is not None and r in finished
        out.append((r, o, as_of if hit else None, True if hit else done))
    for r, o in snap:
        if key(r, o) not in open_keys:
            out.append((r, o, None, None))
    return sorted(out, key=repr)


@settings(**SETTINGS)
@given(st.lists(st.tuples(ids, rols, st.sampled_from([None, True])), max_size=8),
       st.lists(st.tuples(ids, rols), max_size=8))
def test_snapshot_merge_matches_brute_force(spark, hist, snap):
    h = spark.createDataFrame([(r, o, None, d) for r, o, d in hist],
                              "rut string, rol string, fecha_ejecucion string, proceso_finalizado boolean")
    s = spark.createDataFrame(snap, "rut string, rol string")
    got = rows(snapshot_merge(h, s, "2022-11-07"), "rut", "rol", "fecha_ejecucion", "proceso_finalizado")
    assert got == _brute_merge(hist, snap, "2022-11-07")


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["p", "q", None]), st.integers(1, 9), st.sampled_from([True, False, None]),
                          st.integers(0, 5)), min_size=1, max_size=12))
def test_rollup_rows_matches_brute_force(spark, data):
    df = spark.createDataFrame([(k, f"h{i}", "x", done, start, start + extra)
                                for i, (k, start, done, extra) in enumerate(data)],
                               "k string, id_hito string, nombre string, fin boolean, ini int, fn int")
    out = rollup_rows(df, "k", mins=["ini"], maxs=["fn"], done_col="fin", label_col="nombre", label="H0",
                      cleared=["id_hito"], order_by="ini", tie_break="id_hito")
    got = rows(out.where("nombre = 'H0'"), "k", "fin", "ini", "fn")
    groups = {}
    for i, (k, start, done, extra) in enumerate(data):
        if k is not None:
            groups.setdefault(k, []).append((start, start + extra, done))
    expected = sorted(((k, not any(dn is False for _, _, dn in g), min(a for a, _, _ in g), max(b for _, b, _ in g))
                       for k, g in groups.items()), key=repr)
    assert got == expected
    assert out.count() == len(data) + len(groups)


import unicodedata  # noqa: E402

from tidewater.functions.text import fold  # noqa: E402


def _reference_fold(s):
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii").lower()


_POOL = ("abcXYZ 019-_" + "".join(chr(c) for c in range(0xC0, 0x250)) + "ﬀﬁﬂﬃﬄﬅﬆ" + "ＡＢｃｚ０９" + "¹²³ⁿ"
         + "άέήίόύώΑΣω" + "жЁщ" + "́̈" + "ßæœøđħł")
_POOL += "½¼™…㏒𝐀𝔷𝟗🄐ĲĳǄǅǆǇǈǉǊǋǌǱǲǳİK"


@settings(**SETTINGS)
@given(st.lists(st.text(alphabet=_POOL, max_size=12), min_size=1, max_size=30))
def test_fold_matches_nfkd_ascii_lower(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(fold("t")).collect()] == [_reference_fold(t) for t in texts]


from tidewater.operators.reshape import index_values  # noqa: E402


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abcxyz", min_size=0, max_size=3)), max_size=60))
def test_index_values_numbers_distinct_values_in_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = sorted((r["v"], r["__idx"]) for r in index_values(df, "v").collect())
    expected = [(v, i) for i, v in enumerate(sorted({v for v in values if v is not None}))]
    assert got == expected
