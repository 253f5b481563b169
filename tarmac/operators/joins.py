"""Joins J1-J7 (J8, the k-nearest-neighbour join, lives in ``knn.py``).

Broadcast policy: a side is broadcast only when its size is bounded by
definition (a dimension keyed by a small code set, a one-row aggregate) or
after an explicit row-count check; otherwise the planner keeps a shuffle
join and AQE may still convert it at runtime from real sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows under which a dimension is broadcast after a count check.
BROADCAST_MAX_ROWS = 1_000_000


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows, else return it as is.

    The check reads at most ``max_rows + 1`` rows of the small side only.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def lookup(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
           bounded: bool = False, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Dimension lookup (left outer equi-join, unmatched -> nulls)."""
    d = F.broadcast(dim) if bounded else broadcast_checked(dim, max_rows)
    return fact.join(d, on, how)


def semi_join(df: DataFrame, groups: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keep rows of qualifying groups (``groups`` is one row per group)."""
    return df.join(groups, on, "left_semi")


def reattach(features: DataFrame, raw: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Re-attach a dropped column by row key (inner)."""
    return features.join(raw.select(key, *cols), key, "inner")


def unordered_pairs(groups: DataFrame, key: str) -> DataFrame:
    """All pairs a < b of a *group-level* table (one row per group).

    The input is an aggregate with one row per group, never the fact table,
    so its size is the number of groups.
    """
    a = groups.select([F.col(c).alias(f"{c}_a") for c in groups.columns])
    b = groups.select([F.col(c).alias(f"{c}_b") for c in groups.columns])
    return a.join(b, F.col(f"{key}_a") < F.col(f"{key}_b"), "inner")


def scheme_gap(a: DataFrame, b: DataFrame, keys: Sequence[str], metric: str,
               suffix_a: str = "a", suffix_b: str = "b") -> DataFrame:
    """Inner join of two result sets on ``keys``; gap = a - b."""
    aa = a.select(*keys, F.col(metric).alias(f"{metric}_{suffix_a}"))
    bb = b.select(*keys, F.col(metric).alias(f"{metric}_{suffix_b}"))
    j = aa.join(bb, list(keys), "inner")
    return j.withColumn("gap", F.col(f"{metric}_{suffix_a}") - F.col(f"{metric}_{suffix_b}"))


def with_global(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Compare every row to a one-row aggregate (broadcast, size 1)."""
    return df.crossJoin(F.broadcast(stats))


def complete_groups(labels: DataFrame, agg: DataFrame, on: str, fill: dict | None = None) -> DataFrame:
    """Reindex results to a full label list; missing -> null (or ``fill``)."""
    out = labels.join(agg, on, "left")
    return out.fillna(fill) if fill else out
