"""Whole-text encoding with the tokenizers library, one vocabulary lookup per distinct chunk.

A text is cut at spaces and line feeds, which the tokenizers used here drop and never merge across, and before a
lone full stop or comma that ends a word, which they cut there too; A-Z are lower-cased first, as they do. The ids of a
text are the ids of its chunks in order. Chunks repeat: each is encoded once per process while it stays in a
cache of bounded size. Texts with combining marks are encoded as they are, since marks can compose.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidewater.llm.common import release_memory

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
CACHE = 700_000          # chunks kept per Python worker (some 150 MB)
BLOCK_BYTES = 8_000_000
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"([{LETTERS}]+)([.,;:!?#*$%&|()-]*)")


def tokenizer_file(name: str) -> str:
    """A path as it is; a bare file name is looked up among the installed public tokenizers."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Gives ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_file(name))
        self.known: dict[str, bytes] = {}
        vocab = self.tok.get_vocab()
        # Letter runs can be encoded many at once only where each run is known to end in a marked token.
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts straight from the tokenizer."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs(self, runs: list[str]) -> list[bytes]:
        """Ids of letter or sign runs, each of which is one pre-token."""
        ids = np.frombuffer(self.plain([" ".join(runs)])[0], "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(runs):
            return self.plain(runs)
        data, at = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [data[a:b] for a, b in zip(at, at[1:])]

    def _learn(self, chunks: list[str]) -> None:
        known, runs, parts, odd = self.known, [], [], []
        for c in chunks:
            m = PLAIN.fullmatch(c)
            if not m:
                odd.append(c)
            elif (a := m[1].lower()) == c:
                runs.append(c)
            else:
                parts.append((c, a, m[2]))
        runs = list({*runs, *(w for _, a, b in parts for w in (a, b) if w and w not in known)})
        for at in range(0, len(runs), 2000):
            known.update(zip(runs[at:at + 2000], self._runs(runs[at:at + 2000])))
        known.update({c: known[a] + known[b] if b else known[a] for c, a, b in parts})
        if odd:
            known.update(zip(odd, self.plain(odd)))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each whole text (null: empty), taken in blocks; within one, each distinct chunk is looked up once
        and the ids are gathered by chunk number. What a block needed for that is given back after it."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy())
        out, at = [], 0
        while at < len(texts):
            upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + BLOCK_BYTES)) + 1
            out += self._block(texts.slice(at, upto - at))
            release_memory()
            at = upto
        return out

    def _block(self, texts: pa.Array) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known.clear()
        bare = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        cut = pc.split_pattern(pc.replace_substring_regex(bare, rf"([{LETTERS}])([.,])( |$)", r"\1 \2\3"), " ")
        found = cut.flatten().dictionary_encode()
        distinct = found.dictionary.to_pylist()
        self._learn([c for c in distinct if c not in self.known])
        got = [self.known[c] for c in distinct]
        ids = np.frombuffer(b"".join(got), "<u4")
        lens = np.fromiter(map(len, got), np.int64, len(got)) // 4
        starts = np.cumsum(lens) - lens
        at = found.indices.to_numpy()
        n = lens[at]
        ends = np.cumsum(n)
        data = ids[np.repeat(starts[at] - ends + n, n) + np.arange(n.sum())].tobytes()
        stops = 4 * np.concatenate([[0], ends])[cut.offsets.to_numpy()]
        out = [data[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
        marked = np.flatnonzero(pc.match_substring_regex(texts, r"\p{M}|İ").to_numpy(zero_copy_only=False))
        for i in marked.tolist():
            out[i] = self.plain([texts[i].as_py()])[0]
        return out


def encoder(name: str = TOKENIZER) -> Encoder:
    """One encoder per Python worker and tokenizer, kept between tasks."""
    kept = sys.modules.setdefault("_tidewater_encoders", types.ModuleType("_tidewater_encoders")).__dict__
    if name not in kept:
        kept[name] = Encoder(name)
    return kept[name]


def document_ids(enc: Encoder, texts: pa.Array, end_id: int = END_ID) -> list[bytes]:
    """Per whole text (null: empty) its ids and the end id."""
    end = end_id.to_bytes(4, "little")
    return [ids + end for ids in enc.encode(texts)]
