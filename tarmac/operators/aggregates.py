"""Aggregations A1-A22 and top-k helpers T1-T7.

Every aggregate of one grouping goes into one ``agg`` (one shuffle, map-side
partial aggregation).  Exact medians/quantiles use ``percentile`` (a count
per distinct value — bounded for minute-level delays).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quantile(c: str | Column, q, exact: bool = True) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(q, (list, tuple)):
        qq = F.array(*[F.lit(float(x)) for x in q])
    else:
        qq = F.lit(float(q))
    return F.percentile(col, qq) if exact else F.percentile_approx(col, qq, 10000)


def median(c: str | Column, exact: bool = True) -> Column:
    return quantile(c, 0.5, exact)


def safe_name(label: str) -> str:
    """Column-safe form of a level label ('1-15' -> '1_15', '60+' -> '60_plus')."""
    s = label.replace("+", "_plus").replace("<", "lt").replace(">", "gt")
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_")
    return s.lower()


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """A1: value counts (order by ``n`` desc at the consumer)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def top_groups(df: DataFrame, key: str, top_n: int, min_n: int) -> DataFrame:
    """The ``top_n`` largest groups with at least ``min_n`` rows (tie: key asc)."""
    return (group_counts(df, [key]).filter(F.col("n") >= min_n)
            .orderBy(F.col("n").desc(), F.col(key)).limit(top_n).select(key))


def rate_by(df: DataFrame, key: str | Sequence[str], flag: str, n_mode: str = "size",
            pct: bool = True, out: str = "rate") -> DataFrame:
    """A3/A4: mean of a 0/1 flag (x100) and n per group.

    ``n_mode='size'`` counts rows, ``'count'`` counts non-null flags.
    """
    keys = [key] if isinstance(key, str) else list(key)
    m = F.avg(F.col(flag))
    n = F.count(F.lit(1)) if n_mode == "size" else F.count(F.col(flag))
    return df.groupBy(*keys).agg((m * 100 if pct else m).alias(out), n.alias("n"))


def box_stats(df: DataFrame, key: str | Sequence[str], value: str) -> DataFrame:
    """Q1, median, Q3, Tukey whiskers (most extreme value inside 1.5 IQR), outliers.

    Works on the pre-aggregated ``(group, value, cnt)`` table: one shuffle of
    the fact rows (map-side combined), then quartiles with the frequency form
    of ``percentile`` and the whisker pass over distinct values only.
    """
    keys = [key] if isinstance(key, str) else list(key)
    vc = value_counts_table(df, value, keys)
    qexpr = F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("cnt"))
    q = vc.groupBy(*keys).agg(qexpr.alias("_q"), F.sum("cnt").alias("n"))
    q = q.select(*keys, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    j = vc.join(q.select(*keys, lo.alias("_lo"), hi.alias("_hi")), keys)
    x = F.col(value)
    inside = (x >= F.col("_lo")) & (x <= F.col("_hi"))
    w = j.groupBy(*keys).agg(
        F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"),
        F.sum(F.when(~inside, F.col("cnt")).otherwise(F.lit(0))).alias("n_outliers"),
    )
    return q.join(w, keys)


def histogram(df: DataFrame, value: str, bins: int = 80) -> DataFrame:
    """A10: equal-width bins over [min, max]; the maximum falls in the last bin."""
    base = df.filter(F.col(value).isNotNull())
    ext = base.agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    width = (F.col("_mx") - F.col("_mn")) / F.lit(float(bins))
    idx = F.least(F.floor(F.try_divide((F.col(value) - F.col("_mn")) * F.lit(float(bins)),
                                       F.col("_mx") - F.col("_mn"))), F.lit(bins - 1))
    j = base.select(value).crossJoin(F.broadcast(ext))
    h = j.groupBy(F.coalesce(idx, F.lit(0)).cast("int").alias("bin"), "_mn", "_mx").agg(
        F.count(F.lit(1)).alias("n"))
    return h.select("bin", (F.col("_mn") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("_mn") + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def value_counts_table(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, value, cnt) with nulls removed — the pre-aggregate behind ranks, ECDF, KDE."""
    return (df.filter(F.col(value).isNotNull())
            .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt")))


def crosstab_row_pct(df: DataFrame, row: str, col: str, levels: Sequence[str]) -> DataFrame:
    """Row-normalised contingency table (%), columns in level order."""
    names = {lv: f"pct_{safe_name(lv)}" for lv in levels}
    p = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row).pivot(col, list(levels)).count()
    total = sum((F.coalesce(F.col(f"`{lv}`"), F.lit(0)) for lv in levels), F.lit(0))
    return p.select(row, *[(F.coalesce(F.col(f"`{lv}`"), F.lit(0)) * 100.0 / total).alias(names[lv])
                           for lv in levels])


def pivot_median_masked(df: DataFrame, row: str, col: str, value: str, col_levels: Sequence,
                        min_n: int = 5, prefix: str = "h", exact: bool = True) -> DataFrame:
    """Row x col median with cells of fewer than ``min_n`` rows nulled."""
    cell = (df.groupBy(row, col)
            .agg(median(value, exact).alias("_m"), F.count(F.lit(1)).alias("_n"))
            .withColumn("_v", F.when(F.col("_n") >= min_n, F.col("_m"))))
    p = cell.groupBy(row).pivot(col, list(col_levels)).agg(F.first("_v"))
    return p.select(row, *[F.col(f"`{c}`").alias(f"{prefix}{int(c):02d}") for c in col_levels])


def binned_median(df: DataFrame, x: str, y: str, width: float = 250.0, exact: bool = True) -> DataFrame:
    """Right-closed bins (lo, hi] of ``width`` from 0 on ``x`` (x = 0 dropped); median of ``y``."""
    b = F.ceil(F.col(x) / F.lit(width)).cast("int")
    d = df.filter(F.col(x) > 0).withColumn("bin", b)
    a = d.groupBy("bin").agg(median(y, exact).alias("median_delay"), F.count(F.lit(1)).alias("n"))
    return a.select("bin", ((F.col("bin") - 1) * width).alias("bin_lo"), (F.col("bin") * width).alias("bin_hi"),
                    ((F.col("bin") - 0.5) * width).alias("bin_mid"), "median_delay", "n")
