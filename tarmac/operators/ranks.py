"""Distributed mid-ranks, ECDF and KDE (W3, W4, A10 density).

Everything starts from the pre-aggregated ``(keys, value, cnt)`` table: a
value repeated by a third of all rows is one row here, so hot values do not
pile up in one task.  Cumulative counts come from a two-pass prefix sum over
a range-partitioned copy of that table:

1. Spark's range partitioning deals the table by ``(keys, value)``; it is
   written once with the range's number as a column.
2. Per partition (and key) totals — at most ``partitions x keys`` rows — give
   each partition its offset through a small window.
3. A window inside ``(partition, key)`` gives the local running count.

No step sends a whole group or the whole table to one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from .aggregates import value_counts_table


#: start and span of ``xxhash64``
HASH64 = (-(1 << 63), 1 << 64)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))


def ranged(df: DataFrame, cols: Sequence[str], hashed: tuple[int, int] | None = None, parts: int | None = None) -> DataFrame:
    """``df`` with ``_pid``, the number of its contiguous range of ``cols``.

    The rows are dealt by Spark's range partitioning and written once to the
    checkpoint folder with their range's number, so every later branch, and
    every task that is run again, sees the same ranges.  ``hashed``: the first
    column is uniform from the given start over the given span, and the range
    follows by arithmetic, in place.
    """
    p = parts or _parts(df)
    if hashed:
        start, span = hashed
        place = (F.col(cols[0]).cast("double") - float(start)) / float(span)
        return df.withColumn("_pid", F.least(F.floor(place * p), F.lit(p - 1)).cast("int"))
    return checkpoint(df.repartitionByRange(p, *cols).withColumn("_pid", F.spark_partition_id()))


def prefix_counts(vc: DataFrame, value: str | Sequence[str], keys: Sequence[str] = (), cnt: str = "cnt",
                  partitions: int | None = None, hashed: tuple[int, int] | None = None) -> DataFrame:
    """Add ``before`` (count of rows with a strictly smaller ``value`` within ``keys``) and ``total``.

    ``value`` may be several columns (lexicographic order), e.g. ``(ts, row_id)``
    for a global row number that stays balanced when one timestamp is hot.
    Rows are cut into ``partitions`` contiguous ranges of ``(keys, value)``;
    per-range totals (a few rows) give each range its offset, and a window
    inside each range gives the local running count.  ``hashed``: the first
    of ``value`` is a hash, uniform from the given start over the given span,
    so the ranges follow by arithmetic, without a sample, a count or bounds on
    the driver.
    """
    keys = list(keys)
    vals = [value] if isinstance(value, str) else list(value)
    r = ranged(vc, vals if hashed else [*keys, *vals], hashed, partitions)
    tot = r.groupBy("_pid", *keys).agg(F.sum(cnt).alias("_ptot"))
    wo = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_pid")
    off = tot.select("_pid", *keys,
                     F.coalesce(F.sum("_ptot").over(wo.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("_off"),
                     F.sum("_ptot").over(wo.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                     .alias("total"))
    wl = Window.partitionBy("_pid", *keys).orderBy(*vals).rowsBetween(Window.unboundedPreceding, -1)
    loc = r.withColumn("_loc", F.coalesce(F.sum(cnt).over(wl), F.lit(0)))
    # ``off`` has one row per (range, key): small, broadcast by the planner/AQE.
    out = loc.join(off, ["_pid", *keys])
    rest = [c for c in vc.columns if c not in keys and c not in vals and c != cnt]
    return out.select(*keys, *vals, cnt, *rest, (F.col("_off") + F.col("_loc")).alias("before"), "total")


def mid_rank_table(vc: DataFrame, value: str, keys: Sequence[str] = (), cnt: str = "cnt") -> DataFrame:
    """W4 on a value-count table: ``rank = before + (cnt + 1) / 2`` (average rank of ties)."""
    p = prefix_counts(vc, value, keys, cnt)
    return p.withColumn("rank", F.col("before") + (F.col(cnt) + 1) / 2.0)


def mid_ranks(df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """W4 on rows: every row gets the mid-rank of its value (pooled, or within ``keys``).

    The join back is on ``value`` against a distinct-value table; AQE's skew
    handling splits a hot value on the row side.
    """
    vc = value_counts_table(df, value, keys)
    t = mid_rank_table(vc, value, keys).select(*keys, value, F.col("rank").alias(out), F.col("cnt").alias("tie_size"))
    return df.filter(F.col(value).isNotNull()).join(t, [*keys, value])


def ecdf(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per distinct value, count and share of rows ``<= value``."""
    vc = value_counts_table(df, value, keys)
    p = prefix_counts(vc, value, keys)
    return p.select(*keys, value, "cnt", ((F.col("before") + F.col("cnt")) / F.col("total")).alias("ecdf"))


def tie_term(vc: DataFrame, cnt: str = "cnt") -> DataFrame:
    """One row: ``sum(t^3 - t)`` over tie groups and ``N``."""
    t = F.col(cnt).cast("double")
    return vc.agg(F.sum(t * t * t - t).alias("ties"), F.sum(cnt).alias("N"))


def gaussian_kde(df: DataFrame, value: str, points: int = 80, digits: int = 9) -> DataFrame:
    """A10: Gaussian KDE with Scott's bandwidth (std_samp * n^-1/5) at ``points`` bin centres.

    Sums over the distinct-value table against a fixed-size broadcast grid.
    """
    spark = df.sparkSession
    base = df.filter(F.col(value).isNotNull())
    stats = base.agg(F.count(F.lit(1)).alias("_n"),
                     (F.stddev_samp(value) * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("_h"),
                     F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    grid = spark.range(points).select(F.col("id").cast("int").alias("bin"))
    g = grid.crossJoin(stats).select(
        "bin", "_n", "_h", (F.col("_mn") + (F.col("bin") + 0.5) * ((F.col("_mx") - F.col("_mn")) / float(points))).alias("x"))
    vc = value_counts_table(base, value)
    j = vc.crossJoin(F.broadcast(g))   # grid: fixed ``points`` rows
    z = (F.col("x") - F.col(value)) / F.col("_h")
    dens = F.sum(F.col("cnt") * F.exp(F.lit(-0.5) * z * z)) / (F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi)))
    return j.groupBy("bin", "x", "_n", "_h").agg(F.round(dens, digits).alias("density")).select("bin", "x", "density")


def global_row_number(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), out: str = "rn",
                      hashed: tuple[int, int] | None = None) -> DataFrame:
    """1-based row number in ``order`` (within ``keys``) without a single-task window.

    ``order`` must be unique within ``keys`` (add the row key as the last column).
    """
    p = prefix_counts(df.withColumn("_one", F.lit(1)), list(order), keys, cnt="_one", hashed=hashed)
    return p.withColumn(out, F.col("before") + 1).drop("_one", "before")


def prefix_sums(df: DataFrame, order: Sequence[str], cols: Sequence[str], keys: Sequence[str] = (),
                partitions: int | None = None, hashed: tuple[int, int] | None = None) -> DataFrame:
    """Running sums of several columns in one ordering: adds ``before_<c>`` (sum of ``c``
    over rows strictly earlier in ``order`` within ``keys``) for every ``c``.

    Same range-bucket scheme as ``prefix_counts``; one sort serves all columns.
    """
    keys, vals = list(keys), list(order)
    r = ranged(df, vals if hashed else [*keys, *vals], hashed, partitions)
    tot = r.groupBy("_pid", *keys).agg(*[F.sum(c).alias(f"_pt_{c}") for c in cols])
    wo = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_pid", *keys, *[F.coalesce(F.sum(f"_pt_{c}").over(wo), F.lit(0)).alias(f"_off_{c}")
                                      for c in cols])
    wl = Window.partitionBy("_pid", *keys).orderBy(*vals).rowsBetween(Window.unboundedPreceding, -1)
    loc = r.select("*", *[F.coalesce(F.sum(c).over(wl), F.lit(0)).alias(f"_loc_{c}") for c in cols])
    out = loc.join(off, ["_pid", *keys])
    return out.select(*df.columns, *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"before_{c}") for c in cols])
