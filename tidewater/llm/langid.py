"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of its labelled text knows every substring of that sample. A
text is parsed greedily against it into the longest phrases the sample contains; text of the same language needs fewer,
longer phrases. Phrases times the logarithm of the sample's length, per symbol, is the cross entropy estimate
of Ziv and Merhav, which makes samples of unequal length comparable; the language with the least wins.

Symbols are the UTF-8 bytes of the lower-cased letters, runs of anything else become one blank, so the automata
have at most 256 symbols whatever the script. The automaton is laid out as a table state x symbol that already
holds the restart after a mismatch, and all texts of a block, cut into windows, step through it together.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, only

UND = "und"
SAMPLE_DOCS = 64          # documents a language is learned from, at most
SAMPLE_CHARS = 600        # characters taken of each of them, from a place that its hash names
MAX_LANGUAGES = 256       # beyond that learning stops with an error
MODEL_BYTES = 192 << 20   # of all languages' tables together, which go to every worker; samples are cut alike until they keep to it
WINDOW = 1024             # symbols parsed by one lane; a phrase does not cross a window's edge
BLOCK = 8 << 20           # symbols parsed at once
SHARPNESS = 12.0
OTHER = re.compile(r"[\W\d_]+")


def symbols(text: str | None) -> bytes:
    """Lower-cased letters as UTF-8 with single blanks between words; empty if the text has no letter."""
    if not isinstance(text, str):
        return b""
    t = OTHER.sub(" ", text.lower()).strip()
    return t.encode("utf-8", "replace") if any(c.isalpha() for c in t) else b""


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions per state (0 is the start); a path from it spells a substring of ``data`` and nothing else does."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


class Model:
    """The parse tables of the learned languages over one common alphabet.

    ``alphabet`` maps a byte to its column; column 0 is a byte no sample has, the last one is padding. A cell holds
    2 * (next state * width) + 1 if a phrase begins there: past a mismatch the parse begins anew at the start state."""

    def __init__(self, samples: dict[str, bytes]):
        self.langs = sorted(samples)
        known = sorted(set(b"".join(samples.values())))
        self.alphabet = np.zeros(256, np.uint8 if len(known) < 254 else np.uint16)
        self.alphabet[known] = np.arange(1, len(known) + 1)
        self.pad, self.width = len(known) + 1, len(known) + 2
        self.tables, self.bits = [], []
        for lang in self.langs:
            states = suffix_automaton(samples[lang])
            to = np.zeros((len(states), self.width), np.int64)
            for s, edges in enumerate(states):
                if edges:
                    to[s, self.alphabet[list(edges)]] = list(edges.values())
            cell = np.where(to > 0, 2 * self.width * to, 2 * self.width * to[0] + 1)
            cell[0] = 2 * self.width * to[0] + 1
            cell[:, self.pad] = 0
            self.tables.append(cell.astype(np.int32 if cell.max() < 1 << 31 else np.int64).ravel())
            self.bits.append(math.log2(max(2, len(samples[lang]))))

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases per text and language."""
        lens = np.array([len(t) for t in texts], np.int64)
        lanes = -(-lens // WINDOW)
        owner = np.repeat(np.arange(len(texts)), lanes)
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        if not len(owner):
            return out
        grid = np.full((len(owner), WINDOW), self.pad, self.alphabet.dtype)
        at = np.concatenate([[0], np.cumsum(lanes)])
        for i, t in enumerate(texts):
            grid[at[i]:at[i + 1]].reshape(-1)[:len(t)] = self.alphabet[np.frombuffer(t, np.uint8)]
        fill = np.minimum(WINDOW, lens[owner] - WINDOW * (np.arange(len(owner)) - at[owner]))
        order = np.argsort(-fill, kind="stable")
        steps = np.ascontiguousarray(grid[order].T)
        live = np.searchsorted(-fill[order], -np.arange(WINDOW), side="left")
        for k, table in enumerate(self.tables):
            state, count = np.zeros(len(owner), table.dtype), np.zeros(len(owner), np.int32)
            for t in range(WINDOW):
                n = live[t]
                if not n:
                    break
                cell = table[state[:n] + steps[t, :n]]
                count[:n] += cell & 1
                np.right_shift(cell, 1, out=state[:n])
            out[:, k] = np.bincount(owner[order], weights=count, minlength=len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, known) per whole text: the language of the fewest normalised phrases (ties: the first
        by name), its share among all of 1 / entropy ** SHARPNESS, and the mean length of its phrases."""
        langs, score, span = [], np.zeros(len(texts)), np.zeros(len(texts))
        block: list[bytes] = []

        def flush():
            at = len(langs)
            if not block:
                return
            n = np.array([len(b) for b in block])
            if not self.langs:
                langs.extend([UND] * len(block))
            else:
                got = self.phrases(block)
                bits = got * np.array(self.bits) / np.maximum(n, 1)[:, None]
                best = bits.argmin(axis=1)
                share = (bits.min(axis=1, keepdims=True) / np.maximum(bits, 1e-12)) ** SHARPNESS
                some = n > 0
                langs.extend([self.langs[b] if ok else UND for b, ok in zip(best, some)])
                score[at:at + len(block)] = np.where(some, 1 / np.maximum(share.sum(axis=1), 1), 0)
                span[at:at + len(block)] = np.where(some, n / np.maximum(got[np.arange(len(block)), best], 1), 0)
            block.clear()

        size = 0
        for text in texts:
            block.append(symbols(text))
            size += len(block[-1]) + 64
            if size > BLOCK:
                flush()
                size = 0
        flush()
        return langs, score, span


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """A model from rows (text, lang). Rows without text or label teach nothing.

    The sample is bounded and documented: per language the document of smallest hash in each of ``sample_docs`` hash classes, and
    of it ``sample_chars`` characters (from a place named by the hash). Minima are combined before the shuffle and a
    language brings some tens of kilobytes to the driver, however much text it has. With many languages or symbols every sample is
    cut to the same share of itself, so that the tables keep to ``MODEL_BYTES``."""
    h = F.xxhash64("text")
    room = F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1
    piece = F.substring(F.col("text"), (F.pmod(F.shiftright(h, 8), room) + 1).cast("int"), F.lit(sample_chars))
    rows = (labelled.where("lang is not null and text is not null")
            .select("lang", F.pmod(h, F.lit(sample_docs)).alias("class"), h.alias("h"), piece.alias("piece"))
            .groupBy("lang", "class").agg(F.min(F.struct("h", "piece")).alias("m"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("m.h", "m.piece"))).alias("pieces"))
            .limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    samples = {r["lang"]: b" ".join(filter(None, (symbols(p["piece"]) for p in r["pieces"]))) for r in rows}
    samples = {k: v for k, v in samples.items() if v}
    # an automaton has at most two states a symbol of its sample, each a row of 4-byte cells, one per different symbol of all samples
    cell = 4 * (len(set().union(*samples.values())) + 2) if samples else 0
    share = min(1.0, MODEL_BYTES / max(1, sum(2 * len(v) * cell for v in samples.values())))
    return Model({k: v[:max(1, int(len(v) * share))] for k, v in samples.items()})


def _predicted(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a struct column of lang_pred, score and phrase_length."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))          # plain arrays: a worker needs no class to read them

    @F.pandas_udf("lang_pred string, score double, phrase_length double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        mine = Model.__new__(Model)
        vars(mine).update(shared.value)
        for texts in batches:
            lang, score, span = mine.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": lang, "score": score, "phrase_length": span})

    return docs.withColumn(name, predict("text"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and phrase_length, from the text alone; one narrow pass.

    Every whole text is parsed. Defined cases: null, or no letter in the text: ``und``, score 0; a model without languages:
    ``und`` for all; a text whose letters the model never saw is still given its nearest language, with a
    phrase_length of about 1; repeated rows are predicted alike; an empty table gives no rows. Columns of docs that have the
    names of results are replaced."""
    names = ["lang_pred", "score", "phrase_length"]
    kept, p = [c for c in docs.columns if c not in names], fresh(docs, "prediction")
    return _predicted(docs, model, p).select(*kept, *[F.col(f"{p}.{n}").alias(n) for n in names])


def held_out():
    """True where the unsigned crc32 of the doc_id as text leaves 1 when divided by 3 (a null doc_id: as the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def accept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns) that have a language: not those without a letter, nor those of which the learned
    text knows not one symbol pair (phrases of single symbols only, in more than one symbol: a script never seen)."""
    p = fresh(docs, "prediction")
    known = F.col(f"{p}.lang_pred") != UND
    return _predicted(docs, model, p).where(known & ((F.col(f"{p}.phrase_length") > 1.0) | (F.length("text") <= 4))).select(*docs.columns)


def train(docs: DataFrame) -> Model:
    """Learn from the labelled documents that are not held out."""
    return learn(only(docs.where(~held_out()), "text", "lang"))


def op1_langid(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    docs = only(read_table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return identify(docs.select("doc_id", "text"), train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
