"""Training-data operators: brute force on small fixtures, and the defined results on nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names."""

import collections
import hashlib
import itertools
import os
import random
import re
import subprocess
import sys
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, langid, linededup, packing, passages, quality, secrets, simhash, tokenbin, tokens, warc
from tidewater.llm.common import connected_components, materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["fp", "key", "id", "n", "label", "class", "node", "start", "words", "__doc", "component_id"]
LANGS = {"en": "the and that this with from have which their would there about other these",
         "de": "der die und nicht eine werden schon zwischen können über gegen durch wieder",
         "fr": "les dans pour avec être cette mais nous leurs après sans entre toujours"}


def prose(seed, n, lang="en"):
    r = random.Random(seed)
    stems = LANGS[lang].split()
    return " ".join(r.choice(stems) + r.choice(["", "", "s", "er", "en", "ing", r.choice(stems)]) for _ in range(n))


def rows_of(extra=()):
    long_text = prose(1, 30_000)
    base = [(1, None), (2, ""), (3, " \n\t \n"), (4, "one"), (5, long_text), (5, long_text), (6, prose(2, 60)), (7, prose(2, 60)),
            (None, "text without a key"), (8, "naïve “quotes” – 日本語 👍🏽 ＡＢ"), *extra]
    return [(d, t, "en" if (d or 0) % 2 else None, None, None if t is None else len(t)) for d, t in base]


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASH}) if clash else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def union_find(pairs, items):
    up = {i: i for i in items}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: top(i) for i in items}


def test_connected_components(spark):
    r = random.Random(3)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(500, k) for k in range(501, 540)]
    got = {x.node: x.label for x in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = union_find(pairs, {x for p in pairs if p[0] != p[1] for x in p})
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# 1 language ID

def test_langid_held_out_accuracy_and_edges(spark):
    rows = [(i, prose(i, 80, lang), lang, None, None) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    docs = frame(spark, rows + rows_of())
    model = langid.train(docs)
    assert model.langs == ["de", "en", "fr"]
    got = langid.identify(docs, model).select("doc_id", "text", "lang", "lang_pred", "score", langid.held_out().alias("h")).collect()
    known = [x for x in got if x.doc_id is not None and x.text and len(x.text) > 200 and x.lang]
    held = [x for x in known if x.h]
    assert len(held) > 20 and sum(x.lang == x.lang_pred for x in held) / len(held) > 0.95
    for x in got:
        assert x.h == (zlib.crc32(("" if x.doc_id is None else str(x.doc_id)).encode()) % 3 == 1)
        assert 0 <= x.score <= 1 and (x.lang_pred == "und") == (not any(c.isalpha() for c in x.text or ""))
    assert len(got) == len(rows) + len(rows_of())
    kept = langid.accept(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {4, 5, 6, 7}
    assert langid.identify(empty(spark), langid.train(empty(spark))).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.train(empty(spark))).collect()} == {"und"}


def test_cross_parsing_counts_longest_matches():
    model = langid.Model({"a": b"abcab", "b": b"xyz"})
    parsed = model.phrases([b"abcabx", b"cab", b"zz", b""])
    assert parsed.tolist() == [[2, 6], [1, 3], [2, 2], [0, 0]]


# 2 SimHash

def reference_simhash(text, shingle=3):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(spark):
    extra = [(20 + i, prose(9, 300).replace("the", "THE", i)) for i in range(6)] + [(40 + i, prose(50 + i, 4)) for i in range(30)]
    extra += [(80 + i, " ".join(prose(9, 300).split()[:300 - i])) for i in range(8)]
    docs = frame(spark, rows_of(extra))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows_of(extra))
    text = {d: t for d, t, *_ in rows_of(extra)}
    fp = {d: reference_simhash(t) for d, t in text.items()}
    assert all(x.fp & (1 << 64) - 1 == fp[x.doc_id] for x in got)
    ids = sorted(i for i in fp if i is not None)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if bin(fp[a] ^ fp[b]).count("1") <= 2]
    want = union_find(pairs, ids)
    assert {x.doc_id: x.component_id for x in got if x.doc_id is not None} == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def test_trie_join_matches_all_pairs():
    r = np.random.default_rng(5)
    centre = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    leaves = np.unique(np.concatenate([centre ^ (np.uint64(1) << r.integers(0, 64, 40).astype(np.uint64)) for _ in range(8)] + [centre]))
    home = (leaves >> np.uint64(63)) == 1
    label = simhash.trie_links(leaves, home, 1, 2)
    pairs = [(i, j) for i in range(len(leaves)) for j in range(i) if bin(int(leaves[i] ^ leaves[j])).count("1") <= 2 and (home[i] or home[j])]
    want = union_find(pairs, range(len(leaves)))
    assert [want[int(x)] for x in label] == [want[i] for i in range(len(leaves))]
    assert len(set(label.tolist())) == len(set(want.values()))


# 3 quality

def reference_measures(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_cascade(spark):
    extra = [(30, "a b c d e a b c d e f a b c d e"), (31, "x " * 400), (32, "line one here\nline one here\nother\n" * 3), (33, "w### " * 30),
             (34, prose(4, 50).upper()), (35, "é\x0bü\x0cß\r\nñ | <a> & b"), (36, "a a a a a a")]
    docs = frame(spark, rows_of(extra))
    got = quality.judge(docs).collect()
    assert len(got) == len(rows_of(extra))
    want = collections.Counter((d, *reference_measures(t)) for d, t, *_ in rows_of(extra))
    assert collections.Counter(tuple(x)[:6] for x in got) == want
    for x in got:
        assert x.base_failed == (x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words)
        assert not (x.base_failed and x.kept)
    kept = {x.doc_id: x.kept for x in got}
    assert kept[6] and kept[5] and not kept[33] and not kept[34]
    assert quality.judge(empty(spark)).count() == 0
    # the verdict is the conjunction of the rules in any order, and can be filtered on
    rules = quality.default_rules()
    m = quality.measured(docs)
    a = {(r.doc_id, r.v) for r in m.select("doc_id", quality.verdict(list(rules), rules).alias("v")).collect()}
    b = {(r.doc_id, r.v) for r in m.select("doc_id", quality.verdict(list(rules)[::-1], rules).alias("v")).collect()}
    assert a == b and quality.judge(docs).where("kept").count() == sum(x.kept for x in got)


# 4 token shards

def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.tokenizer_file(tokens.TOKENIZER))


ODD = ["it's don't I'LL", "a\tb c  d", "İstanbul ΣΑΣ", "café ﬁn ½ x2y 3.14 <|endoftext|>x", "J̌ T̈. x. y, Z.. a.,b .", "É. Ö, À.\nB.", "\x1ca\x1fb", "-'s foo-'s 's,'ve", "ß ẞ K"]


def test_token_shards_round_trip(spark):
    extra = [(50 + i, t) for i, t in enumerate(ODD)]
    docs = frame(spark, rows_of(extra))
    got = tokenbin.token_shards(docs).collect()
    enc, at = tokenizer(), 0
    want = []
    for d, t, *_ in sorted(rows_of(extra), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*enc.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert tokenbin.token_shards(empty(spark)).count() == 0


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64))
    mph = tokenbin.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    prints = np.zeros(len(keys), np.uint32)
    prints[mph.slots(keys)] = tokenbin.fingerprints(keys)
    other = np.random.default_rng(2).integers(0, 1 << 63, 5000, dtype=np.uint64)
    slot = mph.slots(other)
    assert ((slot >= 0) & (prints[slot] == tokenbin.fingerprints(other))).sum() == np.isin(other, keys).sum()
    assert len(tokenbin.PerfectHash.build(np.zeros(0, np.uint64)).slots(keys[:3])) == 3


# 5 line dedup

def edit(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_banded_edit_distance():
    r = random.Random(2)
    a, b = [], []
    for _ in range(1500):
        s = [r.choice("abé👍") for _ in range(r.choice([0, 1, 2, 5, 20, 40]))]
        t = list(s)
        for _ in range(r.randint(0, 5)):
            k = r.randint(0, len(t))
            t[k:k + r.randint(0, 1)] = r.choice([[], ["a"], ["é"]])
        a.append("".join(s))
        b.append("".join(t))
    for k in range(4):
        assert linededup.within(a, b, k).tolist() == [edit(x, y) <= k for x, y in zip(a, b)]


def brute_lines(rows, least):
    occ = sorted(((d, p, x.strip(" \t\n\x0b\x0c\r")) for d, t, *_ in rows for p, x in enumerate((t or "").split("\n"))), key=lambda o: (o[0] is not None, o))
    occ = [o for o in occ if o[2]]
    u = sorted({x for _, _, x in occ if len(x) >= least})
    pairs = [(i, j) for i in range(len(u)) for j in range(i) if abs(len(u[i]) - len(u[j])) <= 2 and linededup.within([u[i]], [u[j]], 2)[0]]
    top, first, out = union_find(pairs, range(len(u))), {}, {}
    num = {x: i for i, x in enumerate(u)}
    for d, p, x in occ:
        group = top[num[x]] if x in num else x          # shorter lines: equal ones only
        first.setdefault(group, (d, p))
        out[d, p] = first[group] != (d, p)
    return out


@pytest.mark.parametrize("hot, depth", [(None, 6), (3, 1), (5, 2)])
def test_lines_against_brute_force(spark, monkeypatch, hot, depth):
    monkeypatch.setattr(linededup, "DEPTH", depth)
    r = random.Random(8)
    lines = [prose(i, 6) for i in range(12)]
    extra = []
    for i in range(40):
        own = [prose(1000 + i, 8), r.choice(["short", "}", "shirt", f"s{i}"])]
        for _ in range(3):
            x = list(r.choice(lines))
            for _ in range(r.randint(0, 2)):
                x[r.randrange(len(x))] = r.choice("abcxyz")
            own.append("".join(x))
        extra.append((100 + i, "\n".join(own)))
    rows = [x for x in rows_of(extra) if x[0] is not None]
    docs = frame(spark, rows)
    got = {(x.doc_id, x.pos): x.again for x in linededup.line_classes(docs).collect()} if hot is None else None
    if hot is None:
        assert got == brute_lines(rows, linededup.MIN_CHARS)
        out = linededup.dedup_lines(docs)
        assert out.columns == docs.columns and out.count() == docs.count()
        by = {x.doc_id: x for x in out.collect()}
        text = {d: t for d, t, *_ in rows}
        for d, x in by.items():
            parts = (text[d] or "").split("\n")
            gone = [p for p in range(len(parts)) if got.get((d, p))]
            size = sum(len(p.strip(linededup.BLANKS)) for p in parts)
            if gone and sum(len(parts[p].strip(linededup.BLANKS)) for p in gone) <= 0.5 * size:
                assert x.text == "\n".join(p for k, p in enumerate(parts) if k not in gone) and x.n_chars == len(x.text)
            else:
                assert x.text == text[d]
        assert linededup.dedup_lines(empty(spark)).count() == 0 and linededup.line_report(empty(spark)).count() == 0
        assert linededup.dedup_lines(frame(spark, rows_of())).count() == len(rows_of())
    else:       # hot keys are partitioned anew, then compared block by block, and lose no link
        few = connected_components(linededup.line_links(docs, hot=hot)).collect()
        monkeypatch.setattr(linededup, "DEPTH", 6)
        all_ = connected_components(linededup.line_links(docs)).collect()
        assert sorted(map(tuple, few)) == sorted(map(tuple, all_)) and few


def test_variants_of_one_line_meet_block_by_block(spark, monkeypatch):
    """6,000 lines that differ in a few places only, never partitioned: blocks of 500, no task sees more than two of them."""
    monkeypatch.setattr(linededup, "DEPTH", 1)
    r = random.Random(31)
    base = prose(77, 9)
    lines = set()
    while len(lines) < 6000:
        x = list(base)
        x[-1 - r.randrange(6)], x[-1 - r.randrange(6)] = r.choice("abcdefghijklmnopqrstuvwxyz0123456789"), r.choice("abcdefghijklmnopqrstuvwxyz0123456789")
        lines.add("".join(x))
    far = {prose(78, 9) + f" {i:03d}xyz" for i in range(0, 999, 111)}
    docs = spark.createDataFrame(list(enumerate([*lines, *far])), "doc_id long, text string")
    found = linededup.line_links(docs, hot=500)
    comps = collections.Counter(x.label for x in connected_components(found).collect())
    assert max(comps.values()) == 6000 and sum(comps.values()) <= 6000 + len(far)
    assert found.count() < 6000 * 40


def test_repeated_lines_go_from_mostly_repeated_documents(spark, tmp_dir):
    shared = [prose(700 + i, 12) for i in range(9)]
    text = {1: "\n".join(shared[:5]), 2: "\n".join(shared[5:]), 3: "\n".join([*shared, prose(720, 8)]), 4: "\n".join(["short", *shared])}
    rows = [(d, t, "en", None, len(t)) for d, t in text.items()]
    frame(spark, rows, clash=False).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    got = {x.doc_id: x for x in linededup.op5_lines(spark, tmp_dir).collect()}
    assert {d: got[d].removed for d in text} == {1: "", 2: "", 3: "0,1,2,3,4,5,6,7,8", 4: "1,2,3,4,5,6,7,8,9"}
    assert all(got[d].n_removed == got[d].n_repeated for d in text)


# 6 packing

@pytest.mark.parametrize("capacity", [4096, 64])
def test_packing_round_trip(spark, capacity):
    extra = [(200 + i, prose(i, 10 + 37 * i)) for i in range(25)] + [(300 + i, t) for i, t in enumerate(ODD)]
    rows = rows_of(extra)
    got = packing.pack(frame(spark, rows), capacity=capacity).collect()
    enc = tokenizer()
    ids = {d: np.array([*enc.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t, *_ in rows}
    pieces, seqs = collections.Counter(), collections.defaultdict(list)
    for x in got:
        assert zlib.crc32(ids[x.doc_id][x.start:x.start + x.length].tobytes()) == x.ids_crc32 and x.doc_tokens == len(ids[x.doc_id])
        pieces[x.doc_id] += x.length
        seqs[x.sequence_id].append(x)
    times = collections.Counter(d for d, *_ in rows)
    assert pieces == collections.Counter({d: times[d] * len(ids[d]) for d in ids})
    padding = total = 0
    for mine in seqs.values():
        at = 0
        for x in sorted(mine, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding < 0.05 * total
    assert packing.pack(empty(spark)).count() == 0


def test_cut_fills_reciprocal_classes():
    for n in range(1, 9000, 7):
        parts = packing.cut(n)
        assert sum(parts) == n and all(0 < p <= 4096 for p in parts)
        assert len(parts) - n // 4096 <= 6


# 7 WARC

def test_fixity_audit_finds_exactly_the_damage(spark, tmp_dir):
    pages = spark.createDataFrame([(i, f"http://h{i % 3}/é{i}", f"<p>{prose(i, 20 + i)}</p>") for i in range(120)] + [(None, None, None), (7, "again", "x")],
                                  "page_id long, url string, html string").withColumns({"no": F.lit(1), "file": F.lit("f")}).repartition(3)
    a, b, c = (os.path.join(tmp_dir, x) for x in "abc")
    manifest = warc.write_archive(pages, a)
    assert manifest.count() == 122
    warc.copy_archive(manifest, a, b, F.col("page_id").isin(3, 64, 119))
    bad = warc.audit(manifest, a, b).join(manifest, ["file", "no"]).collect()
    assert sorted(x.page_id for x in bad) == [3, 64, 119]
    warc.copy_archive(manifest, a, c)
    assert warc.audit(manifest, a, c).count() == 0
    name = sorted(x for x in os.listdir(c) if x.endswith(".gz"))[-1]
    os.truncate(os.path.join(c, name), os.path.getsize(os.path.join(c, name)) - 1)
    assert warc.audit(manifest, a, c).count() == 1
    import gzip
    data = gzip.decompress(open(os.path.join(a, sorted(x for x in os.listdir(a) if x.endswith(".gz"))[0]), "rb").read())
    assert data.startswith(b"WARC/1.0\r\n")
    none = warc.write_archive(pages.where("false"), os.path.join(tmp_dir, "n1"))
    assert none.count() == 0 and warc.audit(none, os.path.join(tmp_dir, "n1"), os.path.join(tmp_dir, "n2")).count() == 0


# 8 decontamination

def test_leaks_against_brute_force(spark):
    bench = [(i, prose(700 + i, 14 + 2 * i)) for i in range(20)] + [(90, None), (91, ""), (92, "too short here"), (93, "la " * 12)]
    r = random.Random(4)
    extra = []
    for i in range(20):
        item = bench[i][1].split()
        if i % 4 == 1:
            item[0] = "changed"
        if i % 4 == 2:
            item[len(item) // 2] = "changed"
        if i % 4 == 3:
            item = [w.upper() + "," for w in item]
        extra.append((100 + i, " ".join(prose(i, r.randint(0, 30)).split() + item + prose(50 + i, r.randint(0, 30)).split())))
    extra += [(150, "La la, " * 6), (151, " ".join(bench[9][1].split()[:9]))]
    rows = rows_of(extra)
    bdf = spark.createDataFrame(bench, "item_id long, text string").withColumns({"doc_id": F.lit(1), "n": F.lit(1), "fp": F.lit(1)})
    got = {(x.doc_id, x.item_id): x.similarity for x in decontaminate.leaks(frame(spark, rows), bdf).collect()}
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    want = {}
    for d, t, *_ in rows:
        w = words(t)
        if len(w) > 5000:
            continue
        for i, item in bench:
            iw = words(item)
            if len(iw) >= 5 and len(w) >= 5:
                best = max(sum((grams(iw) & grams(w[p:p + len(iw)])).values()) / max(1, sum((grams(iw) | grams(w[p:p + len(iw)])).values()))
                           for p in range(len(w)))
                if best >= 0.8:
                    want[d, i] = best
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) >= 14
    left = decontaminate.without_leaks(frame(spark, rows), bdf)
    assert left.columns == frame(spark, rows).columns
    assert {x.doc_id for x in left.collect()} == {d for d, *_ in rows} - {d for d, _ in want}
    assert decontaminate.leaks(empty(spark), bdf).count() == 0
    assert decontaminate.leaks(frame(spark, rows), bdf.where("false")).count() == 0


# 9 secrets

def base_spans(text):
    pats = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 16)]
    out = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(pats) for m in re.finditer(p, text or "") if ok(m))
    return out, ",".join(f"{pats[k][0]}:{a}:{b}" for a, k, b in out)


def test_secrets_base_spans_and_battery(spark):
    r = random.Random(6)
    key = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    b62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    many = " ".join(key("0123456789abcdef", 20) for _ in range(700))
    planted = [key(b62, 40) for _ in range(60)]
    extra = [(30, "token: password: abcdefghijklmno 👍 Secret = 'aaaa.bbbb-cccc_1' api_key=\"short\" APIKEY='0123456789ab'"),
             (31, "x AKIA" + "Q" * 14 + " AKIAAKIAQ " + "deadbeef" * 3 + "é" + "0" * 15), (32, many),
             (33, "passwd=passwd=passwd=passwd"), (34, "secret:\n" + "a" * 30)]
    extra += [(400 + i, f"ñ {p} and some_long_snake_case_name_number_{i}") for i, p in enumerate(planted)]
    extra += [(600 + i, " ".join(prose(i, 40).replace(" ", "")[k:k + 18 + k % 30] for k in range(0, 200, 20))) for i in range(40)]
    rows = rows_of(extra)
    got = secrets.scan(frame(spark, rows)).select("doc_id", "base", "spans", F.sha2(secrets._text("base").cast("binary"), 256).alias("h"))
    seen = collections.Counter()
    hit = plain = 0
    for x in got.collect():
        text = next(t for d, t, *_ in rows if d == x.doc_id)
        want, line = base_spans(text)
        assert [tuple(s) for s in x.base] == want and x.h == hashlib.sha256(line.encode()).hexdigest()
        assert set(map(tuple, x.base)) <= set(map(tuple, x.spans))
        for s in x.spans:
            if s.kind == 3:
                found = text[s.start:s.end]
                hit += found in planted
                plain += "snake_case" in found or found.isalpha()
        seen[x.doc_id] += 1
    assert seen == collections.Counter(d for d, *_ in rows)
    assert hit >= 50 and plain <= 6
    assert secrets.scan(empty(spark)).count() == 0


def test_value_after_a_name_is_a_run_of_its_own(spark):
    r = random.Random(16)
    key = lambda: "".join(r.choice("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/") for _ in range(40))
    values = {i: key() for i in range(60)}
    rows = [(i, f"AWS_SECRET_ACCESS_KEY={v} x client_key={v}== y", None, None, 0) for i, v in values.items()]
    rows += [(600 + i, " ".join(prose(i, 40).replace(" ", "")[k:k + 18 + k % 30] for k in range(0, 200, 20)), None, None, 0) for i in range(40)]
    runs = {x.doc_id: (x.text, [(q.start, q.end, q.p) for q in x.runs]) for x in secrets.scanned(frame(spark, rows)).join(frame(spark, rows).select("doc_id", "text"), "doc_id").collect()}
    for i, v in values.items():
        text, got = runs[i]
        assert {v, v + "=="} <= {text[a:b] for a, b, p in got if p is not None}
    spans = {x.doc_id: [tuple(q) for q in x.spans] for x in secrets.scan(frame(spark, rows)).collect()}
    assert sum(any(k == 3 and runs[i][0][a:b] == v for a, k, b in spans[i]) for i, v in values.items()) >= 50


# 10 passages

def test_passages_are_caught_and_clean_documents_left_alone(spark):
    shared = {k: prose(5000 + k, 55 + 5 * k) for k in range(8)}
    r = random.Random(12)
    extra, groups = [], collections.defaultdict(list)
    for i in range(48):
        k = i % 8
        extra.append((100 + i, " ".join([prose(2000 + i, r.randint(20, 90)), shared[k], prose(3000 + i, r.randint(20, 90))]).replace(" ", "\n", i % 3)))
        groups[k].append(100 + i)
    extra += [(200 + i, prose(4000 + i, 150)) for i in range(40)]
    rows = rows_of(extra)
    got = {x.doc_id: x for x in passages.passage_components(frame(spark, rows)).collect()}
    assert set(got) == {d for d, *_ in rows}
    for k, ids in groups.items():
        assert {got[i].component_id for i in ids} == {min(ids)}, k
        assert got[min(ids)].n_removed == 0 and all(got[i].n_removed == 1 for i in ids[1:])
    assert all(got[200 + i].n_passages == 0 and got[200 + i].component_id == 200 + i for i in range(40))
    assert got[7].component_id == 6 and got[None].component_id is None and got[1].n_passages == 0
    assert passages.passage_components(empty(spark)).count() == 0


def test_band_tuning_and_seeds():
    bands, rows = passages.tune_bands(0.8, 0.95)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.95
    need = passages.GRAM + passages.SPREAD - 1
    r = random.Random(5)
    for k in range(300):
        run = prose(k, need).split()
        if k % 10 == 0:
            run = [run[0]] * need
        texts = [" ".join([*prose(1000 + 2 * k + i, r.randint(30, 60)).split(), *run, *prose(9000 + 2 * k + i, r.randint(30, 60)).split()]) for i in range(2)]
        text, _, seed, _, _ = passages.seeds_of(texts)
        assert set(seed[text == 0].tolist()) & set(seed[text == 1].tolist()), k
    assert all(len(x) == 0 for x in passages.seeds_of([None, "", " ", "few words"]))


def brute_passages(rows, n=51):
    """Per (doc_id, text): runs of words that lie in n words which another doc_id has too, and of those that a smaller one has."""
    grams = collections.defaultdict(set)
    texts = {(d, t): re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t)) for d, t in rows if d is not None and t}
    for (d, _), w in texts.items():
        for i in range(len(w) - n + 1):
            grams[tuple(w[i:i + n])].add(d)
    out = {}
    for (d, t), w in texts.items():
        for earlier in (False, True):
            cover = set()
            for i in range(len(w) - n + 1):
                has = grams[tuple(w[i:i + n])]
                if len(has) > 1 and (not earlier or min(has) < d):
                    cover.update(range(i, i + n))
            starts = [i for i in sorted(cover) if i - 1 not in cover]
            spans = [(i, next(k for k in itertools.count(i) if k not in cover) - i) for i in starts]
            if spans:
                out[d, t, earlier] = spans
    return out


def test_verbatim_passages_equal_brute_force(spark):
    r = random.Random(3)
    shared = [prose(7000 + k, r.randint(40, 90)) for k in range(40)]
    rows = []
    for i in range(200):
        parts = []
        for _ in range(r.randint(0, 3)):
            parts += [prose(20_000 + 10 * i + len(parts), r.randint(1, 40)), r.choice(shared)]
        rows.append((i // 2 if i < 20 else i, "\n".join(parts).replace(" ", r.choice([" ", "  ", "\t"]))))
    rows += [(None, shared[0]), (500, None), (501, ""), (502, "a " * 300), (503, "a " * 200 + "b"), rows[30], (7, " ".join(shared[3:9]).title())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # A paragraph that is equal or alike may add to the runs, so the threshold is set to equal paragraphs alone.
    got = collections.defaultdict(list)
    names = {(d, h): t for d, t, h in docs.select("doc_id", "text", F.xxhash64("text")).collect()}
    for x in passages.repeated_passages(docs, similarity=1.0).collect():
        got[x.doc_id, names[x.doc_id, x.row], x.earlier].append((x.start, x.n_words))
    want = brute_passages(rows)
    assert len(want) > 150 and {k: sorted(v) for k, v in got.items()} == want


def test_every_passage_of_51_words_is_caught_and_none_of_50(spark):
    r = random.Random(8)
    rows = []
    for k in range(500):
        run = prose(100_000 + k, 51 if k < 400 else 50)
        for i in range(2):
            rows.append((2 * k + i, " ".join([prose(200_000 + 4 * k + i, r.randint(20, 80)) + f" x{k}{i}", run, f"y{k}{i} " + prose(400_000 + 4 * k + i, r.randint(20, 80))])))
    got = passages.passage_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all((x.component_id, x.n_passages, x.n_removed_words) == ((x.doc_id // 2 * 2, 1, 51 * (x.doc_id % 2)) if x.doc_id < 800 else (x.doc_id, 0, 0)) for x in got)


def test_passages_with_a_changed_word_are_caught(spark):
    """Paragraphs of 60 words, and stretches of 80 inside other paragraphs; no 51 words of them are equal."""
    r = random.Random(9)
    lines, inside = [], []
    for k in range(200):
        for rows, n, sep in ((lines, 60, "\n"), (inside, 80, " ")):
            run = prose(100_000 + k, n).split()
            other = list(run)
            other[r.randrange(n // 2 - 5, n // 2 + 5)] = "changed"
            rows += [(2 * k + i, sep.join([prose(200_000 + 4 * k + i, 30), " ".join(t), prose(400_000 + 4 * k + i, 30)])) for i, t in enumerate((run, other))]
    for rows in (lines, inside):
        got = {x.doc_id: x.component_id for x in passages.passage_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert sum(got[2 * k + 1] == 2 * k for k in range(200)) >= 0.95 * 200 and all(v // 2 == k // 2 for k, v in got.items())


def links_of(spark, texts, hot, similarity=0.8, bands=16, nrows=1):
    """(shingle sets by id, components by id) of whole texts as paragraphs."""
    seeds = [list(range(max(0, len(t.split()) - passages.GRAM + 1))) for t in texts]
    _, (_, _, _, ids, keys, count, flat) = passages.pieces_of(texts, seeds, bands, nrows, 31)
    sets = {int(i): frozenset(s.tolist()) for i, s in zip(ids, np.split(flat, np.cumsum(count)[:-1]))}
    marked = spark.createDataFrame([(int(i), k.tolist(), [int(v) for v in s]) for i, k, s in zip(ids, keys, np.split(flat, np.cumsum(count)[:-1]))],
                                   "id long, keys array<long>, sh array<long>")
    return sets, [tuple(x) for x in passages.paragraph_links(marked, similarity, hot).collect()]


def test_paragraph_links_equal_brute_force(spark):
    r = random.Random(4)
    texts = []
    for k in range(30):
        base = prose(k, 60).split()
        for _ in range(4):
            copy = list(base)
            for _ in range(r.randint(0, 2)):
                copy[r.randrange(60)] = r.choice(["one", "two", "three"])
            texts.append(" ".join(copy))
    for hot in (64, 2):
        sets, found = links_of(spark, texts, hot)
        alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
        want = [(a, b) for a, b in itertools.combinations(sets, 2) if alike(a, b)]
        assert len(want) > 30 and all(alike(a, b) for a, b in found)
        assert union_find(found, sets) == union_find(want, sets)


def test_hot_buckets_lose_no_link(spark):
    base = prose(11, 60)
    texts = [f"{base} {w}" for w in sorted(set(prose(9, 3000).split()))[:300]]
    sets, found = links_of(spark, texts, 128)
    assert len(sets) == len(set(texts)) and len(found) < 16 * 10 * 128        # ten pairs of blocks in 16 buckets, a forest each
    assert len(set(union_find(found, sets).values())) == 1


# pipeline

def test_pipeline_stages(spark, tmp_dir):
    import corpus_pipeline as cp
    item = prose(900, 30)
    rows = [(i, prose(i, 60 + i) + "\nthis line of boilerplate is in every text\n" + prose(500 + i, 40), "en", "s", 0) for i in range(30)]
    rows += [(50, rows[3][1], "en", "s", 0), (51, "1234 5678", None, "s", 0), (52, prose(1, 30) + " " + item + " " + prose(2, 30), "en", "s", 0), (53, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(os.path.join(tmp_dir, "benchmark.parquet"))
    docs = spark.read.parquet(os.path.join(tmp_dir, "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, tmp_dir)
        if name != cp.STAGES[-1][0]:
            assert out.columns == docs.columns
            out.write.parquet(os.path.join(tmp_dir, f"s{k}"))
            docs = spark.read.parquet(os.path.join(tmp_dir, f"s{k}"))
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
        else:
            assert {r.doc_id for r in out.collect()} == set(kept["decontamination"])
    assert set(kept["language"]) == {*range(30), 50, 52}
    assert set(kept["lines"]) == set(kept["language"])
    assert sum("boilerplate" in t for t in kept["lines"].values()) == 1 and kept["lines"][50] == kept["lines"][3]
    assert set(kept["near_duplicates"]) == {*range(30), 52}
    assert set(kept["decontamination"]) == set(range(30))
    assert {r.doc_id for r in cp.run(spark, tmp_dir).collect()} == set(range(30))


def test_pipeline_collapses_copies_of_documents_that_lose_a_line(spark, tmp_dir):
    import corpus_pipeline as cp
    line = "this line of boilerplate is in every text"
    rows = [(i, "\n".join(["short", prose(i, 60 + i), line, prose(500 + i, 40)]), "en", "s", 0) for i in range(12)]
    rows += [(50 + i, rows[i][1], "en", "s", 0) for i in range(3, 9)]
    rows += [(70, "\n".join([line, rows[1][1].split("\n")[1], prose(800, 30)]), "en", "s", 0)]
    docs = frame(spark, rows, clash=False)
    cleaned = materialize(cp.lines(spark, docs, tmp_dir), "test-lines")
    text = {r.doc_id: r.text for r in cleaned.collect()}
    assert set(text) == {d for d, *_ in rows} and sum(line in t for t in text.values()) == 1
    assert all(text[50 + i] == text[i] for i in range(3, 9)) and text[70] == prose(800, 30)
    assert {r.doc_id for r in cp.near_duplicates(spark, cleaned, tmp_dir).collect()} == {*range(12), 70}


def test_pipeline_stages_tell_rows_of_one_doc_id_apart(spark, tmp_dir):
    import corpus_pipeline as cp
    item = prose(900, 30)
    shared = "a line of boilerplate that two rows carry"
    rows = [(7, f"seven A first line of its own\n{shared}", "en", "s", 0), (7, "seven B unique first line of its own\nseven B second line of its own", "en", "s", 0),
            (6, f"{shared}\n{prose(5, 20)}", "en", "s", 0), (3, prose(3, 40), "en", "s", 0), (3, prose(1, 20) + " " + item, "en", "s", 0),
            (None, prose(2, 20) + " " + item, "en", "s", 0), (None, prose(4, 40), "en", "s", 0), (None, None, None, None, None), (9, "", None, None, 0)]
    docs = frame(spark, rows)
    out = materialize(cp.lines(spark, docs, tmp_dir), "rows-lines")
    assert out.columns == docs.columns
    texts = sorted((r.doc_id or 0, r.text or "") for r in out.collect())
    want = [(d or 0, t or "") for d, t, *_ in rows]
    want[0] = (7, "seven A first line of its own")
    assert texts == sorted(want)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(os.path.join(tmp_dir, "benchmark.parquet"))
    left = cp.decontamination(spark, docs, tmp_dir)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted((d or 0, t or "") for d, t, *_ in rows if item not in (t or ""))


# ---------------------------------------------------------------------------
# disk and memory of long jobs

def test_a_written_table_leaves_no_shuffle_files(spark):
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    before, clean = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    table = materialize(df, "test-shuffle")
    assert sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
    for _ in range(50):                                              # executors are told, not waited for
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == clean
    assert sum(r["count"] for r in df.collect()) == 1000             # what was written can still be computed


def test_an_encoder_gives_its_blocks_memory_back():
    code = """if True:
        import random, re
        import pyarrow as pa
        from tidewater.llm import tokens
        from tidewater.llm.common import release_memory
        held = lambda: int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
        r = random.Random(1)
        words = [f"word{i} " for i in range(20_000)]
        texts = pa.array(["".join(r.choices(words, k=400)) for _ in range(5000)])
        release_memory()
        enc = tokens.Encoder(tokens.TOKENIZER)
        for _ in range(2):
            enc.encode(texts)
        after = held()
        release_memory()
        print(after - held())"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(tokens.__file__)) + "/..")
    assert float(out.stdout) < 60, out.stderr
