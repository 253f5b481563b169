"""Window-style operators W1-W9.

No operator here runs an un-partitioned ``Window`` over the fact table:
keyed dedup is a partial aggregate (``max_by``), ranks and ECDFs work on
pre-aggregated ``(value, count)`` tables with range-partitioned prefix
sums (``ranks.py``), and rolling windows run over one row per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], order: str, tie: str) -> DataFrame:
    """Keep the last row per ``key`` ordered by (``order``, ``tie``).

    Written as ``groupBy(key).agg(max_by(struct(*), struct(order, tie)))`` so
    Spark combines map-side before the shuffle (a key repeated many times
    costs one row per map task, not one row per copy).
    """
    others = [c for c in df.columns]
    packed = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(F.col(order), F.col(tie))
    agg = df.groupBy(*key).agg(F.max_by(packed, ordering).alias("_last"))
    return agg.select("_last.*")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in a stable order (``min_by`` partial aggregate)."""
    packed = F.struct(*[F.col(c) for c in df.columns])
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*key).agg(F.min_by(packed, ordering).alias("_first")).select("_first.*")


def rolling_median(daily: DataFrame, order: str, value: str, half: int = 3, min_periods: int = 3,
                   out: str = "rolling_median") -> DataFrame:
    """Centred rolling median over ``2*half+1`` *rows* (dates present).

    ``daily`` has one row per date (a few thousand rows even at 100 TB), so a
    single ordered window over it is bounded.  ``percentile`` accepts a row
    frame (``median`` refuses one); the result is nulled below ``min_periods``
    non-null values, as the rolling median of the source does.
    """
    w = Window.orderBy(order).rowsBetween(-half, half)
    med = F.percentile(F.col(value), F.lit(0.5)).over(w)
    n = F.count(F.col(value)).over(w)
    return daily.withColumn(out, F.when(n >= min_periods, med))


def competition_rank(df: DataFrame, score: str, out: str = "rank", partition: Sequence[str] = ()) -> DataFrame:
    """1,2,2,4 ranking of candidates by descending score (small candidate tables)."""
    w = Window.partitionBy(*partition).orderBy(F.col(score).desc()) if partition else \
        Window.orderBy(F.col(score).desc())
    return df.withColumn(out, F.rank().over(w))


def argmax_per_group(df: DataFrame, group: Sequence[str], score: str, tie: str) -> DataFrame:
    """The best row per group (``max_by`` with a deterministic tie key)."""
    packed = F.struct(*[F.col(c) for c in df.columns])
    # On equal scores the larger tie value wins.
    return (df.groupBy(*group)
            .agg(F.max_by(packed, F.struct(F.col(score), F.col(tie))).alias("_b"))
            .select("_b.*"))


def hash_key(c: str | Column, seed: int) -> Column:
    """Seeded 31-bit mixing key (LCG step; overflow-free integer arithmetic, same in SQL)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.pmod(F.pmod(x.cast("long"), F.lit(2147483648)) * F.lit(1103515245) + F.lit(seed * 97 + 13),
                  F.lit(2147483648))


def hash_key_sql(c: str, seed: int) -> str:
    return f"((({c} % 2147483648) * 1103515245 + {seed * 97 + 13}) % 2147483648)"
