r"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, ``://`` and address schemes, plus signs before a digit, digits, and
words that introduce an account. From each anchor a deterministic parser walks to the left and right over the characters its kind
may hold and checks what it has got. No parser walks over a place twice for the same kind, so a text costs time in proportion to its length.

Base kinds, each as the leftmost non-overlapping matches of its pattern, failing matches dropped:

- email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
- ip ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, parts at most 255
- card ``[0-9]([\x20-]?[0-9])+``, 13 to 19 digits that pass Luhn
- phone ``\+[0-9][\x20().0-9-]+[0-9]``, 9 to 15 digits

Added kinds:

- address: a mail address with letters beyond ASCII, or one that ``mailto:``, ``sip:`` or ``xmpp:`` introduces (its host may have no
  dot), and the ``user[:password]@host`` of a URL; none that is a base email span
- account: an IBAN (checked modulo 97), a social security number or another number of 7 to 18 digits after a cue word
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import only

KINDS = ["email", "ip", "card", "phone", "address", "account"]
BASE = 4                                   # the first so many kinds are base kinds
DIGITS = frozenset("0123456789")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
ALNUM = DIGITS | UPPER | frozenset("abcdefghijklmnopqrstuvwxyz")
LOCAL = ALNUM | frozenset("._%+-")
HOST = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
# Schemes that introduce an address, and words that introduce an account, in lower, upper and title case.
SCHEMES = ["mailto:", "sip:", "xmpp:"]
CUES = ["account", "acct", "iban", "ssn", "social security", "passport", "routing", "konto", "kontonummer", "compte", "cuenta"]
FILLERS = frozenset({"", "no", "number", "nr", "num", "id", "nummer", "is", "n"})
FOUND = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    a.add_word("://", ("url", 3))
    for d in DIGITS:
        a.add_word(d, ("digit", 1))
        a.add_word("+" + d, ("plus", 2))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for w in words:
            for form in {w, w.upper(), w.title()}:
                a.add_word(form, (kind, len(w)))
    a.make_automaton()
    return a


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The base email around the at-sign, its local part not before ``floor``."""
    start, end, n = at, at + 1, len(text)
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    while end < n and text[end] in HOST:
        end += 1
    if start == at or end == at + 1:
        return None
    first = end
    while end + 1 < n and text[end] == "." and text[end + 1] in HOST:
        end += 2
        while end < n and text[end] in HOST:
            end += 1
    return (start, end) if end > first else None


def address_at(text: str, at: int, floor: int, dots: bool) -> tuple[int, int] | None:
    """A mail address of letters and digits of any script around the at-sign; host labels neither begin nor end with a hyphen, and with
    ``dots`` there are two or more, the last of two or more letters."""
    start, end, n = at, at + 1, len(text)
    while start > floor and (text[start - 1].isalnum() or text[start - 1] in LOCAL):
        start -= 1
    while start < at and text[start] in ".-":
        start += 1
    while end < n and (text[end].isalnum() or text[end] in "-."):
        end += 1
    while end > at + 1 and text[end - 1] in "-.":
        end -= 1
    labels = text[at + 1:end].split(".")
    if start == at or not all(x and x[0] != "-" and x[-1] != "-" for x in labels):
        return None
    if dots and (len(labels) < 2 or len(labels[-1]) < 2 or not labels[-1].isalpha()):
        return None
    return start, end


def login_at(text: str, begin: int) -> tuple[int, int] | None:
    """``user[:password]@host`` at the start of a URL's authority."""
    end, at, n = begin, -1, len(text)
    while end < n and not text[end].isspace() and text[end] not in "/?#\"'<>":
        at = end if text[end] == "@" else at
        end += 1
    while end > at and end > begin and text[end - 1] in ".,;:)]}":
        end -= 1
    return (begin, end) if begin < at < end - 1 else None


def chain(text: str, at: int, joints: str) -> tuple[int, list[tuple[int, int]]]:
    """The end of the digits from ``at`` on that single ``joints`` join, and the runs of digits."""
    runs, n = [], len(text)
    while True:
        start = at
        while at < n and text[at] in DIGITS:
            at += 1
        runs.append((start, at))
        if not (at + 1 < n and text[at] in joints and text[at + 1] in DIGITS):
            return at, runs
        at += 1


def octet(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += int(d) * 2 - 9 * (d > "4")
    return total % 10 == 0


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    """The match of the phone pattern at a plus sign: to the last digit of the run, at least one character after the first digit."""
    end, n = plus + 2, len(text)
    while end < n and text[end] in PHONE:
        end += 1
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (plus, end) if end > plus + 3 else None


def iban_at(text: str, start: int) -> int | None:
    """The end of an IBAN of 15 to 34 characters that begins here, single blanks between groups taken; None if the check fails."""
    got, ends, at, n = [], [], start, len(text)
    while at < n and len(got) <= 34:
        c = text[at]
        if c in DIGITS or c in UPPER:
            got.append(c)
            ends.append(at + 1)
        elif not (c == " " and at + 1 < n and (text[at + 1] in DIGITS or text[at + 1] in UPPER)):
            break
        at += 1
    for size in range(min(len(got), 34), 14, -1):       # a capital word may follow the last group
        end = ends[size - 1]
        if end == n or text[end] not in ALNUM:
            body = "".join(got[4:size] + got[:4])
            if int("".join(str(int(c, 36)) for c in body)) % 97 == 1:
                return end
    return None


def account_after(text: str, at: int) -> tuple[int, int] | None:
    """The number that a cue introduces, after at most two filler words: digits joined by single blanks or hyphens, 7 to 18 in all; of
    the form 3-2-4 only as a possible social security number."""
    n, fillers = len(text), 0
    while at < n and fillers < 3:
        while at < n and text[at] in " .:#=":
            at += 1
        if at < n and text[at] in DIGITS:
            end, runs = chain(text, at, " -")
            if end < n and text[end] in ALNUM:
                return None
            parts = [text[a:b] for a, b in runs]
            if [len(p) for p in parts] == [3, 2, 4]:
                good = parts[0] not in ("000", "666") and parts[0][0] != "9" and parts[1] != "00" and parts[2] != "0000"
            else:
                good = 7 <= sum(map(len, parts)) <= 18
            return (at, end) if good else None
        start = at
        while at < n and at - start < 8 and text[at].isalpha():
            at += 1
        if at == start or text[start:at].lower() not in FILLERS:
            return None
        fillers += 1
    return None


def personal(text: str, auto: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start; offsets in code points, ends exclusive."""
    found: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    email, ip, card, phone, address, account = found
    done = dict.fromkeys(("email", "ip", "card", "phone", "address", "iban"), 0)

    def extend(at: int, floor: int, dots: bool) -> None:
        span = address_at(text, at, max(floor, done["address"]), dots)
        if span and not (email and email[-1] == span):
            address.append(span)
            done["address"] = span[1]

    for last, (what, size) in auto.iter(text):
        at = last + 1 - size
        if what == "digit":
            if at >= done["card"]:
                done["card"], runs = chain(text, at, " -")
                digits = "".join(text[a:b] for a, b in runs) if len(runs) <= 19 and done["card"] - at <= 37 else ""
                if 13 <= len(digits) <= 19 and luhn(digits):
                    card.append((at, done["card"]))
            if at >= done["ip"]:
                done["ip"], runs = chain(text, at, ".")
                for k in range(0, len(runs) - 3, 4):
                    if all(octet(text[a:b]) for a, b in runs[k:k + 4]):
                        ip.append((runs[k][0], runs[k + 3][1]))
            if at >= 2 and at - 2 >= done["iban"] and text[at - 1] in UPPER and text[at - 2] in UPPER and (at == 2 or text[at - 3] not in ALNUM):
                end = iban_at(text, at - 2)
                if end:
                    account.append((at - 2, end))
                    done["iban"] = end
        elif what == "at":
            span = email_at(text, at, done["email"])
            if span:
                email.append(span)
                done["email"] = span[1]
            if at >= done["address"]:
                extend(at, 0, True)
        elif what == "plus":
            span = phone_at(text, at) if at >= done["phone"] else None
            if span:
                done["phone"] = span[1]
                if 9 <= sum(c in DIGITS for c in text[at:span[1]]) <= 15:
                    phone.append(span)
        elif what == "scheme":
            stop = last + 1
            while stop < len(text) and (text[stop].isalnum() or text[stop] in LOCAL):
                stop += 1
            if stop < len(text) and text[stop] == "@" and (at == 0 or not text[at - 1].isalnum()) and "." not in _host(text, stop):
                extend(stop, last + 1, False)
        elif what == "url":
            span = login_at(text, last + 1)
            if span:
                address.append(span)
                done["address"] = max(done["address"], span[1])
        elif (at == 0 or not text[at - 1].isalnum()) and (last + 1 == len(text) or not text[last + 1].isalpha()):
            span = account_after(text, last + 1)
            if span:
                account.append(span)
    return [(k, a, b) for k, spans in enumerate(found) for a, b in (sorted(set(spans)) if k >= BASE else spans)]


def _host(text: str, at: int) -> str:
    end = at + 1
    while end < len(text) and (text[end].isalnum() or text[end] in "-."):
        end += 1
    return text[at + 1:end].rstrip("-.")


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (array of kind number, start, end; by kind and start).

    Defined cases: a null text is empty and has no spans; repeated rows and null doc_ids are scanned like others; a very long text is
    scanned whole; an empty table gives no rows; other columns are ignored."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = anchors()
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in personal(t.as_py() or "", auto)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, FOUND)], names=["doc_id", "spans"])

    docs = only(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(find, f"doc_id {kind}, spans array<struct<kind:int,start:int,end:int>>")


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_pii(spark, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import read_table

    found = personal_spans(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    base = _text(F.filter("spans", lambda s: s["kind"] < BASE))
    return found.select("doc_id", *map(count, range(BASE)), F.sha2(base.cast("binary"), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
