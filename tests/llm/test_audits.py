"""Personal data, filter interactions and source divergence against brute force, and their defined results on odd input."""

import hashlib
import itertools
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.llm import divergence, filteraudit, pii
from tidewater.llm.catalog import ORACLE

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["part", "mask", "good", "spans", "term", "p", "value", "first", "h1", "w", "t", "held", "rank", "doc"]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def frame(spark, rows, clash=True):
    df = spark.createDataFrame([(d, t, a, s, None if t is None else len(t)) for d, t, a, s in rows], SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASH}) if clash else df


def luhn_ok(s):
    total = 0
    for k, d in enumerate(int(c) for c in reversed(s)):
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    card = lambda s: 13 <= len(digits(s)) <= 19 and luhn_ok(digits(s))
    rules = [(EMAIL, lambda s: True), (IP, lambda s: all(int(x[-400:]) <= 255 and not x[:-400].strip("0") for x in s.split("."))), (CARD, card),
             (PHONE, lambda s: 9 <= len(digits(s)) <= 15)]
    return [(k, m.start(), m.end()) for k, (p, ok) in enumerate(rules) for m in p.finditer(text) if ok(m.group())]


def test_base_spans_are_those_of_the_patterns():
    auto, r = pii.anchors(), random.Random(5)
    pieces = ["@", ".", "-", "+", " ", "1", "12", "255", "256", "007", "a", "b.c", "é", "日", "(", ")", "4111111111111111", "4111 1111 1111 1111", "x@y.zz", "+1 (017) 555-7713",
              "://", "mailto:", "ssn ", "account no. ", "\n", "%", "_", "DE89", "10.0.0.1"]
    for n in range(30_000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(1, 24)))
        assert [s for s in pii.personal(text, auto) if s[0] < pii.BASE] == base_spans(text), text
    for text in ("1" * 10_000, "a@" * 5_000, "1.2." * 3_000, "+1" * 3_000, "4 1-" * 4_000, "a" * 5_000 + "@" + "b." * 5_000):
        assert [s for s in pii.personal(text, auto) if s[0] < pii.BASE] == base_spans(text)


def test_added_spans():
    auto = pii.anchors()

    def added(text):
        return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.personal(text, auto) if k >= pii.BASE]

    assert added("IBAN DE89 3704 0044 0532 0130 00 please, GB82WEST12345698765432.") == [("account", "DE89 3704 0044 0532 0130 00"), ("account", "GB82WEST12345698765432")]
    assert added("IBAN DE88 3704 0044 0532 0130 00 and GB82WEST12345698765433") == []
    assert added("Account number: 1234 5678 90, acct 12345, ssn 123-45-6789, SSN 000-45-6789") == [("account", "1234 5678 90"), ("account", "123-45-6789")]
    assert added("accounts 12345678, discount 12345678 and account of 1234567890") == []
    assert added("write to josé@exämple.de or mailto:bob@localhost, or a@b.com") == [("address", "josé@exämple.de"), ("address", "bob@localhost")]
    assert added("https://user:pw@host.example/x and http://host.example/a@b and ftp://anna@10.0.0.1/") == [("address", "user:pw@host.example"), ("address", "anna@10.0.0.1")]
    assert added("we meet @ home, 3 @ 4.50, x@y and @name in plain prose; mailto: nobody") == []


def test_pii_query_on_odd_rows(spark, tmp_dir):
    long_text = "prose without anchors " * 5000 + "end@long.example"
    rows = [(1, None, None, None), (2, "", "", ""), (3, "a@b.cc, 10.1.2.3, 4111 1111 1111 1111, +44 20 7946 0958", "en", "s"), (3, "a@b.cc", "en", "s"), (3, "a@b.cc", "en", "s"),
            (None, "日本 x@y.zz 👍🏽 z@y.zz", None, None), (4, long_text, "en", "s"), (5, "12345678", "en", "s")]
    frame(spark, rows).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    got = sorted(tuple(r) for r in pii.op11_pii(spark, tmp_dir).fillna({"doc_id": -1}).collect())
    want = []
    for d, t, *_ in rows:
        spans = base_spans(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        n = Counter(k for k, *_ in spans)
        want.append((-1 if d is None else d, *[n[k] for k in range(4)], hashlib.sha256(text.encode()).hexdigest(), text))
    assert got == sorted(want)
    assert got[-2][1:5] == (1, 0, 0, 0) and any(r[1:5] == (1, 1, 1, 1) for r in got)
    assert pii.personal_spans(frame(spark, [])).collect() == []


def audit_rows(docs, labels):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    first = {}
    for d, t, *_ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    out = defaultdict(Counter)
    for d, t, lang, _ in docs:
        t, part = t or "", lang or ""
        w = words.findall(t)
        fails = {f for f, bad in zip("ABCDE", [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                                               bool(re.search(r"[#$%&*|]", t)), d is not None and d > first[t]]) if bad}
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for k, f in enumerate(order):
                here = f in fails and not gone
                c = out[part, order, k + 1]
                c["redundant"] += f in fails and gone
                gone |= f in fails
                c["kept"] += not gone
                c["removed"] += here
                c["unique_fails"] += fails == {f}
                c["good_lost"] += here and d in good
                c["toxic_lost"] += here and d in toxic
    shapley = Counter()
    for (part, order, step), c in out.items():
        shapley[part, order[step - 1]] += c["removed"]
    return sorted((p, o, s, *[c[x] for x in filteraudit.OUTCOMES], shapley[p, o[s - 1]]) for (p, o, s), c in out.items())


def test_filter_audit(spark, tmp_dir):
    r = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = [None, "", "short", " ".join(words[:250]), " ".join(words[:250]) + " #", "ABC DEF " * 150, " ".join(words[:30] * 9), " ".join(words) + " " + "X" * 200, "x " * 100_000]
    docs = [(i, r.choice(texts) if i % 3 else texts[3], r.choice(["en", "de", None, ""]), "s") for i in range(240)]
    docs += [(None, texts[3], "en", "s"), (None, texts[3], "en", "s"), (7, texts[3], "en", "s"), (7, texts[3], "en", "s"), (500, "only", "xx", None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    frame(spark, docs).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit("x"))
    marks.write.parquet(os.path.join(tmp_dir, "labels.parquet"))
    got = sorted(tuple(x) for x in filteraudit.op12_filters(spark, tmp_dir).collect())
    assert got == audit_rows(docs, labels)
    assert len(got) == 4 * 600
    assert filteraudit.audit(frame(spark, []), marks).collect() == []
    assert all(x["good_lost"] == 0 for x in filteraudit.audit(frame(spark, docs[:5]), marks.limit(0)).collect())


def test_packed_fields_do_not_run_over():
    total = (1 << 40) * sum(filteraudit.packed("removed", m) for m in range(32)) + sum(filteraudit.packed("redundant", m) for m in range(32))
    want = sum((1 << 40) * filteraudit.unpacked(filteraudit.packed("removed", m), 600) + filteraudit.unpacked(filteraudit.packed("redundant", m), 600) for m in range(32))
    assert (filteraudit.unpacked(total, 600) == want).all() and want.max() > 1 << 40


def divergence_rows(docs, min_docs=3, top=200):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t)
    count, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, t, lang, source in docs:
        g = (lang or "", source or "")
        groups.add(g)
        found = [lower(x) for x in term.findall(t or "")]
        count[g].update(found)
        held[g[0]].update(set(found))
    rows = []
    kept = {lang: {t for t, n in held[lang].items() if n >= min_docs} for lang, _ in groups}

    def shares(counts, terms):
        n = sum(counts[t] for t in terms)
        return {t: 1 + 1_000_000_000 * (counts[t] + 1) // (n + len(terms)) for t in terms}
    p = {g: shares(count[g], kept[g[0]]) for g in groups}
    for lang, source in groups:
        mine, terms = p[lang, source], kept[lang]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(count[g])
        q = shares(whole, terms)
        pairs = [(sum((mine[t] - p[lang, s][t]) ** 2 // p[lang, s][t] for t in terms), s) for x, s in groups if x == lang and s != source]
        more = [((mine[t] - q[t]) ** 2 // q[t], t) for t in terms if count[lang, source][t] and mine[t] > q[t]]
        for part, found in (("pair", pairs), ("term", more)):
            best = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            rows += [(lang, source, part, i, v, k + 1) for k, (v, i) in enumerate(best if part == "pair" else best[:top])]
    return sorted(rows)


def term_docs(seed, n):
    r = random.Random(seed)
    stems = ["ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "abcdefghijklmno", "abcdefghijklmnop", "abcdefghijklmnopq", "Über", "日本語", "日本語の文章です", "ABCD", "z" * 31, "z" * 32, "z" * 33,
             "z" * 70, "z" * 64 + "y", "q" * 64 + "ü", " ", "naïve"]
    return [(i, " ".join(r.choice(stems) + (r.choice(["", "", "x", "é"])) for _ in range(r.randrange(0, 40))) + r.choice([" 12", "\x7f", "_a_", "`", "["]),
             r.choice(["en", "en", "de", None]), r.choice(["s1", "s2", "s3", None])) for i in range(n)]


@pytest.mark.parametrize("bits, size, held", [(26, 3_000_000, 1_000_000), (6, 300, 50)])
def test_divergence(spark, monkeypatch, bits, size, held):
    monkeypatch.setattr(divergence, "PRUNE_BITS", bits)
    monkeypatch.setattr(divergence, "SLICE", size)
    monkeypatch.setattr(divergence, "HELD_ROWS", held)
    docs = term_docs(1, 120) + [(900, None, "fr", "lone"), (901, "one text alone", "it", "a"), (902, "", "it", "b"), (None, "abc abcd", "en", "s1"), (3, "abc " * 30_000, "en", "s1")]
    docs += [docs[5], docs[5]]
    got = sorted(tuple(r) for r in divergence.divergence(frame(spark, docs).repartition(3), top=25).collect())
    assert got == divergence_rows(docs, top=25)
    assert any("z" * 64 in r[3] for r in got) and any(len(r[3].encode()) == 16 for r in got)


def test_divergence_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PAIR_ROWS", 60)
    monkeypatch.setattr(divergence, "BLOCK", 4)
    docs = [(i, t, "en", f"s{i % 11}") for i, t, *_ in term_docs(2, 90)]
    got = sorted(tuple(r) for r in divergence.divergence(frame(spark, docs)).collect())
    assert got == divergence_rows(docs)
    assert divergence.divergence(frame(spark, [])).collect() == []


def test_new_oracles_are_registered():
    assert {"op12_filters", "op13_divergence"} <= set(ORACLE)


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 0, 0), (0, 0, 3), (5, 17, 4), (8_999_999_999, 9_000_000_001, 12), (9_000_000_000, 9_000_000_001, 12), (4 * 10 ** 17, 10 ** 18 + 7, 10 ** 6)]
    got = spark.createDataFrame(cases, "n long, total long, terms long").select(divergence._share("n", "total", "terms").alias("p")).collect()
    assert [r.p for r in got] == [1 if not v else 1 + 10 ** 9 * (n + 1) // (total + v) for n, total, v in cases]
