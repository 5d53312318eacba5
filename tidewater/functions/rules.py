"""Conditional column functions: brackets, ordered rules, null-aware predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import ColumnOrName, _c


def first_rule(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """CASE WHEN in the given order; the first true condition wins; null conditions fall through."""
    if not rules:
        return F.lit(default)
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def later_wins(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Overwrite rules applied in order where a later match overwrites an earlier one."""
    return first_rule(list(reversed(list(rules))), default)


def brackets(c: ColumnOrName, edges: Sequence[float], labels: Sequence[object], otherwise=None,
             right_closed: bool = True) -> Column:
    """Bin a value into ``labels`` by upper ``edges`` (``len(labels) == len(edges) + 1``).

    With ``right_closed`` the bins are ``x <= e0``, ``e0 < x <= e1``, ..., ``x > e_last``.
    Null falls to ``otherwise`` (the reference's age brackets send null to the last label:
    pass ``otherwise=labels[-1]`` for that).
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    x = _c(c)
    rules = [((x <= e) if right_closed else (x < e), lab) for e, lab in zip(edges, labels[:-1])]
    rules.append((x.isNotNull(), labels[-1]))
    return first_rule(rules, otherwise)


def not_in_keep_null(c: ColumnOrName, values: Sequence[object]) -> Column:
    """``~isin`` where null counts as not in the list (kept)."""
    return F.coalesce(~_c(c).isin(list(values)), F.lit(True))


def not_true(c: ColumnOrName) -> Column:
    """Keeps false and null."""
    return ~_c(c).eqNullSafe(F.lit(True))


def not_equal_keep_null(c: ColumnOrName, value) -> Column:
    """``c != value`` keeping nulls (object-dtype pandas behaviour)."""
    return ~_c(c).eqNullSafe(F.lit(value))


def in_range_or_null(c: ColumnOrName, low, high) -> Column:
    """false only when the value is outside [low, high]; null counts as valid."""
    x = _c(c)
    return F.when((x > high) | (x < low), False).otherwise(True)


def flag(cond: Column) -> Column:
    """A boolean that is false (never null) unless ``cond`` is true."""
    return F.when(cond, True).otherwise(False)


def positive_flag(c: ColumnOrName) -> Column:
    """``coalesce(c > 0, false)``."""
    return F.coalesce(_c(c) > 0, F.lit(False))


def blank_if_null(c: ColumnOrName) -> Column:
    """Text form, null -> empty string."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def yes_no_nonzero(*cols: ColumnOrName) -> Column:
    """V1: 'Si' when any value is non-zero, else 'No'; null counts as zero."""
    cond = None
    for c in cols:
        nz = F.coalesce(_c(c), F.lit(0)) != 0
        cond = nz if cond is None else (cond | nz)
    return F.when(cond, "Si").otherwise("No")
