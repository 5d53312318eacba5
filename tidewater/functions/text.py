"""String column functions (X1-X17). All are built-in expressions (JVM side)."""

from __future__ import annotations

import itertools
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ascii_fold(ch: str) -> str:
    return unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")


def _code_points():
    return itertools.chain(range(0x80, 0xD800), range(0xE000, 0x110000))


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Translate table for accent folding, built by rule from Unicode: every character whose NFKD form keeps exactly
    one ASCII character (accented letters, fullwidth forms, superscripts, ...) maps to it."""
    pairs = [(chr(cp), t) for cp in _code_points() if len(t := _ascii_fold(chr(cp))) == 1]
    return "".join(s for s, _ in pairs), "".join(t for _, t in pairs)


@lru_cache(maxsize=1)
def _expansions() -> dict[str, str]:
    """Characters that NFKD expands to several ASCII ones (ligatures, fractions, signs, ...), built by rule."""
    return {chr(cp): t for cp in _code_points() if len(t := _ascii_fold(chr(cp))) > 1}


def fold(c: ColumnOrName) -> Column:
    """X11: fold to ASCII lowercase as ``NFKD -> drop non-ASCII -> lower``; null stays null.

    A text of ASCII characters alone (as many bytes as characters) only needs ``lower``. In others, one-to-one foldings use a
    rule-built ``translate`` table (cost independent of its size), and a text that holds a character with a longer form
    has its characters looked up one by one.
    """
    x, longer = _c(c), _expansions()
    pairs = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in longer.items())), F.lit("\x01"), F.lit("\x02"))
    spelled = F.array_join(F.transform(F.split(x, ""), lambda ch: F.coalesce(F.try_element_at(pairs, ch), ch)), "")
    some = F.length(F.translate(x, "".join(longer), "")) != F.length(x)
    src, dst = _accent_table()
    full = F.lower(F.regexp_replace(F.translate(F.when(some, spelled).otherwise(x), src, dst), r"[^\x00-\x7F]", ""))
    return F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(full)


def capitalize_first(c: ColumnOrName) -> Column:
    """First character upper, the rest lower (Python ``str.capitalize``)."""
    col = _c(c)
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2147483647)))


def proper(c: ColumnOrName) -> Column:
    """Proper text, every word capitalised."""
    return F.initcap(_c(c))


def collapse_spaces(c: ColumnOrName) -> Column:
    """Collapse runs of spaces to one."""
    return F.regexp_replace(_c(c), " +", " ")


def full_name(*parts: ColumnOrName) -> Column:
    """Join parts with one space, null parts as empty, then collapse spaces."""
    return collapse_spaces(F.concat_ws(" ", *[F.coalesce(_c(p), F.lit("")) for p in parts]))


def first_word(c: ColumnOrName) -> Column:
    """First space-separated word of the folded text."""
    return F.element_at(F.split(fold(c), " "), 1)


def tax_id(c: ColumnOrName, width: int = 10) -> Column:
    """Upper, drop ``-``, left-pad with zeros to ``width`` only when shorter."""
    x = F.replace(F.upper(_c(c)), F.lit("-"), F.lit(""))
    return F.when(F.length(x) < width, F.lpad(x, width, "0")).otherwise(x)


def strip_dash_upper(c: ColumnOrName) -> Column:
    """X4 as used on tax ids: drop ``-`` and uppercase."""
    return F.upper(F.regexp_replace(_c(c), "-", ""))


def sha256_text(c: ColumnOrName) -> Column:
    """SHA-256 hex of the text form; null stays null."""
    return F.sha2(_c(c).cast("string"), 256)


def tax_id_with_dv(number: ColumnOrName, dv: ColumnOrName) -> Column:
    """``number-dv``; null when either part is null."""
    return F.concat(_c(number).cast("string"), F.lit("-"), _c(dv))


def nan_to_null(c: ColumnOrName) -> Column:
    """The text ``'nan'`` becomes null."""
    return F.nullif(_c(c), F.lit("nan"))


def fallback_key(c: ColumnOrName, other: ColumnOrName, prefix: str) -> Column:
    """``coalesce(c, prefix || other)``."""
    return F.coalesce(_c(c), F.concat(F.lit(prefix), _c(other)))


def concat_null_empty(*parts: ColumnOrName) -> Column:
    """Separator-less concat where null counts as empty (T-SQL ``CONCAT``)."""
    return F.concat_ws("", *[_c(p) for p in parts])


def split_part(c: ColumnOrName, sep: str, index: int) -> Column:
    """N-th piece after splitting on a literal separator; ``index`` is 1-based, negative counts from the end; null
    where there are fewer pieces."""
    return F.try_element_at(F.split(_c(c), _quote_regex(sep)), F.lit(index))


def contains_any(c: ColumnOrName, words: list[str]) -> Column:
    """F8: lowercased text contains any of ``words`` (regex alternation)."""
    return F.lower(_c(c)).rlike("|".join(_quote_regex(w) for w in words))


def _quote_regex(s: str) -> str:
    special = set(r".^$*+?()[]{}|\/")
    return "".join("\\" + ch if ch in special else ch for ch in s)
