"""Joins: lookups, roles, hops, existence flags, exclusion, folded-name joins, branch counts.

No join here carries a broadcast hint. Spark plans every join from its size
statistics, and AQE re-plans it at runtime from the measured shuffle output:
a side smaller than ``spark.sql.adaptive.autoBroadcastJoinThreshold`` is
broadcast, anything bigger stays a sort-merge join, and a skewed partition is
split (``spark.sql.adaptive.skewJoin.enabled``). That is the size check.
Literal tables built in code (month names, labels) are the only ones whose size
is fixed by construction; ``sources.literal_table`` marks them for broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import fold


def _on_pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(c, c) if isinstance(c, str) else tuple(c) for c in on]


def lookup_join(df: DataFrame, dim: DataFrame, on, how: str = "left", select: Sequence[str] | None = None,
                defaults: Mapping[str, object] | None = None, null_safe: bool = False) -> DataFrame:
    """Join ``dim`` onto ``df``.

    ``on``: a column name, a list of names, or ``{left_col: dim_col}``. ``select`` limits the
    dim columns brought over (column pruning reaches the dim scan). ``defaults`` fills the
    brought columns where nothing matched (unknown member, J15). ``null_safe`` matches null
    keys to each other, as pandas ``merge`` does (N1); the default is SQL semantics.
    """
    pairs = _on_pairs(on)
    right_names = [r for _, r in pairs]
    keep = list(select) if select is not None else [c for c in dim.columns if c not in right_names]
    renamed = {r: f"__k{i}" for i, r in enumerate(right_names)}
    d = dim.select(*[F.col(r).alias(renamed[r]) for r in right_names], *keep)
    conds = []
    for left, right in pairs:
        l, r = df[left], d[renamed[right]]
        conds.append(l.eqNullSafe(r) if null_safe else l == r)
    cond = reduce(lambda a, b: a & b, conds)
    out = df.join(d, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    out = out.drop(*renamed.values())
    if defaults:
        out = out.withColumns(
            {k: F.coalesce(F.col(k), v if isinstance(v, Column) else F.lit(v)) for k, v in defaults.items()})
    return out


def role_join(df: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str], attrs: Sequence[str],
              how: str = "left") -> DataFrame:
    """The same dimension in several roles; brings ``{role}_{attr}`` for each role."""
    out = df
    for role, fk in roles.items():
        d = dim.select(F.col(dim_key).alias(f"__{role}_key"), *[F.col(a).alias(f"{role}_{a}") for a in attrs])
        out = out.join(d, out[fk] == d[f"__{role}_key"], how).drop(f"__{role}_key")
    return out


def hop(edges: DataFrame, nodes: DataFrame, src: str, dst: str, node_key: str, attrs: Sequence[str],
        dst_filter: Column | None = None) -> DataFrame:
    """Node -> edge -> node. Returns the edges with ``src_<attr>`` and ``dst_<attr>``.

    ``dst_filter`` is written on the ``dst_<attr>`` names and is applied before the second
    join, so Spark pushes it into the destination-node scan.
    """
    s = nodes.select(F.col(node_key).alias("__s"), *[F.col(a).alias(f"src_{a}") for a in attrs])
    t = nodes.select(F.col(node_key).alias("__t"), *[F.col(a).alias(f"dst_{a}") for a in attrs])
    if dst_filter is not None:
        t = t.where(dst_filter)
    out = edges.join(s, edges[src] == s["__s"], "inner").join(t, edges[dst] == t["__t"], "inner")
    return out.drop("__s", "__t")


def exists_flag(df: DataFrame, other: DataFrame, on, name: str) -> DataFrame:
    """``name`` is true where the key occurs in ``other``, else false (never null)."""
    pairs = _on_pairs(on)
    keys = other.select(*[F.col(r).alias(l) for l, r in pairs]).distinct().withColumn(name, F.lit(True))
    out = df.join(keys, [l for l, _ in pairs], "left")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def exclude(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other`` (keeps repeats)."""
    pairs = _on_pairs(on)
    cond = reduce(lambda a, b: a & b, [df[l] == other[r] for l, r in pairs])
    return df.join(other, cond, "left_anti")


def keep_only(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``."""
    pairs = _on_pairs(on)
    cond = reduce(lambda a, b: a & b, [df[l] == other[r] for l, r in pairs])
    return df.join(other, cond, "left_semi")


def folded_join(df: DataFrame, dim: DataFrame, left_col: str, right_col: str, how: str = "left",
                select: Sequence[str] | None = None) -> DataFrame:
    """Accent- and case-insensitive equi-join on the X11-folded text.

    Both sides get a folded key column, so the join stays an equi-join (hash or sort-merge),
    never a nested loop over a function predicate.
    """
    keep = list(select) if select is not None else [c for c in dim.columns if c != right_col]
    d = dim.select(fold(right_col).alias("__fold"), *keep)
    out = df.withColumn("__fold", fold(left_col)).join(d, "__fold", how)
    return out.drop("__fold")


def branch_counts(parent: DataFrame, key: str, branches: Mapping[str, tuple[DataFrame, str]],
                  keep_any: bool = True, fan_out: bool = False) -> DataFrame:
    """Per parent key, the number of child rows in each branch.

    Each branch is counted on its own (``groupBy(fk).count()``, partially aggregated) and
    left-joined, so no join ever multiplies rows. ``fan_out=True`` returns the numbers the
    chained-left-join form reports (each branch count times the product of the other
    branches' ``max(n, 1)``), computed arithmetically. ``keep_any`` keeps parents with any
    count above zero (the HAVING ... OR ... of the reference).
    """
    out = parent
    names = list(branches)
    for name, (child, fk) in branches.items():
        counts = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias(name))
        out = out.join(counts, key, "left")
    out = out.fillna(0, subset=names)
    if fan_out:
        factors = {n: F.greatest(F.col(n), F.lit(1)) for n in names}
        out = out.withColumns({
            n: F.col(n) * reduce(lambda a, b: a * b, [factors[m] for m in names if m != n], F.lit(1))
            for n in names})
    if keep_any:
        out = out.where(reduce(lambda a, b: a | b, [F.col(n) > 0 for n in names]))
    return out
