"""Statistical tests H1-H13 as distributed aggregates.

Each test reduces the rows to a small table with one shared pass (sums,
counts, value-count tables and mid-ranks from ``ranks.py``); the statistic is
a Spark column, and only the p-value of the few result rows goes through an
Arrow-batched pandas UDF (``functions.special``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import special as SP
from . import joins as J
from .aggregates import value_counts_table
from .ranks import mid_rank_table, prefix_counts

Z975 = 1.959963984540054


# ---------------------------------------------------------------------------
# p-value UDFs (tiny result tables only)
# ---------------------------------------------------------------------------
@F.pandas_udf(T.DoubleType())
def p_norm2(z: pd.Series) -> pd.Series:
    return z.map(lambda v: float("nan") if pd.isna(v) else SP.norm_two_sided(float(v)))


@F.pandas_udf(T.DoubleType())
def p_chi2(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([float("nan") if pd.isna(a) or pd.isna(b) else SP.chi2_sf(float(a), float(b))
                      for a, b in zip(x, df)])


@F.pandas_udf(T.DoubleType())
def p_t2(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([float("nan") if pd.isna(a) or pd.isna(b) else SP.t_two_sided(float(a), float(b))
                      for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def p_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([float("nan") if pd.isna(a) else SP.f_sf(float(a), float(b), float(c))
                      for a, b, c in zip(f, d1, d2)])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def proportion_ci_udf(k: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([list(SP.proportion_ci(int(a), int(b))) for a, b in zip(k, n)])


def share_ci(df: DataFrame, group: str, flag: str) -> DataFrame:
    """Bootstrap CI of a 0/1 share per group (closed form, one aggregate + a UDF on k rows)."""
    a = df.filter(F.col(flag).isNotNull()).groupBy(group).agg(
        F.sum(F.col(flag)).cast("long").alias("k"), F.count(F.lit(1)).alias("n"))
    return a.withColumn("_ci", proportion_ci_udf("k", "n")).select(
        group, "k", "n", (F.col("k") / F.col("n") * 100).alias("pct"),
        (F.col("_ci")[0] * 100).alias("ci_lo"), (F.col("_ci")[1] * 100).alias("ci_hi"))


@F.pandas_udf(T.ArrayType(T.LongType()))
def median_ci_rank_udf(n: pd.Series) -> pd.Series:
    return n.map(lambda v: list(SP.median_ci_ranks(int(v))) if v and v >= 2 else None)


# ---------------------------------------------------------------------------
# H1 distribution shape
# ---------------------------------------------------------------------------
def distribution_shape(df: DataFrame, value: str) -> DataFrame:
    """H1: n, mean, biased skewness, excess kurtosis, Jarque-Bera on all rows.

    Moments are computed from sums of centred powers in two passes (the mean
    first, as a one-row broadcast), which keeps precision at any n.
    """
    x = df.filter(F.col(value).isNotNull()).select(F.col(value).alias("_x"))
    m = x.agg(F.avg("_x").alias("_mu"))
    c = J.with_global(x, m).select((F.col("_x") - F.col("_mu")).alias("_d"))
    s = c.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("_d") ** 2).alias("m2"),
              F.avg(F.col("_d") ** 3).alias("m3"), F.avg(F.col("_d") ** 4).alias("m4"))
    s = J.with_global(s, m)
    skew = F.col("m3") / F.pow(F.col("m2"), 1.5)
    kurt = F.col("m4") / (F.col("m2") * F.col("m2")) - 3.0
    out = s.select("n", F.col("_mu").alias("mean"), skew.alias("skewness"), kurt.alias("kurtosis"))
    jb = F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0)
    return out.withColumn("jarque_bera", jb)


def with_shape_p(shape: DataFrame) -> DataFrame:
    return shape.withColumn("p", F.exp(-F.col("jarque_bera") / 2.0)).withColumn(
        "normal", F.col("p") >= 0.05)


# ---------------------------------------------------------------------------
# rank machinery shared by H2-H5
# ---------------------------------------------------------------------------
def group_rank_sums(df: DataFrame, group: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(per-group n / rank sum / mean rank, one-row N / tie term).

    ``gvc`` = (group, value, cnt) is the only pass over the rows; the pooled
    value-count table and the mid-ranks are computed from it.
    """
    d = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    gvc = value_counts_table(d, value, [group])
    vc = gvc.groupBy(value).agg(F.sum("cnt").alias("cnt"))
    ranks = mid_rank_table(vc, value).select(value, "rank", F.col("cnt").alias("tie"))
    j = gvc.join(ranks, value)
    g = j.groupBy(group).agg(F.sum("cnt").alias("n"), F.sum(F.col("cnt") * F.col("rank")).alias("rank_sum"))
    g = g.withColumn("mean_rank", F.col("rank_sum") / F.col("n"))
    t = F.col("tie").cast("double")
    glob = ranks.agg(F.sum("tie").alias("N"), F.sum(t * t * t - t).alias("ties"))
    return g, glob


def kruskal(df: DataFrame, group: str, value: str) -> DataFrame:
    """H2: tie-corrected Kruskal-Wallis H, df = k - 1, epsilon^2 = H / (N - 1)."""
    g, glob = group_rank_sums(df, group, value)
    s = g.agg(F.sum(F.col("rank_sum") ** 2 / F.col("n")).alias("_ss"), F.count(F.lit(1)).alias("k"))
    s = J.with_global(s, glob)
    N = F.col("N").cast("double")
    h0 = F.lit(12.0) / (N * (N + 1)) * F.col("_ss") - 3 * (N + 1)
    corr = F.lit(1.0) - F.col("ties") / (N * N * N - N)
    h = h0 / corr
    return s.select(h.alias("H"), (F.col("k") - 1).alias("df"), F.col("N").alias("n"),
                    (h / (N - 1)).alias("eps2"))


def dunn(df: DataFrame, group: str, value: str, exact: bool = True) -> DataFrame:
    """H3: Dunn's pairwise z on mean ranks, tie-corrected, Bonferroni x k(k-1)/2 (cap 1).

    Pairs come from a self-join of the *group* table (k rows), never the rows.
    """
    g, glob = group_rank_sums(df, group, value)
    d = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    med = d.groupBy(group).agg((F.percentile(value, 0.5) if exact else F.percentile_approx(value, 0.5))
                               .alias("median"))
    g = g.join(med, group)
    k = g.agg(F.count(F.lit(1)).alias("k"))
    pairs = J.unordered_pairs(g.select(group, "n", "mean_rank", "median"), group)
    pairs = J.with_global(J.with_global(pairs, glob), k)
    N = F.col("N").cast("double")
    var = (N * (N + 1) / 12.0 - F.col("ties") / (12.0 * (N - 1))) * (1.0 / F.col("n_a") + 1.0 / F.col("n_b"))
    z = (F.col("mean_rank_a") - F.col("mean_rank_b")) / F.sqrt(var)
    m = F.col("k") * (F.col("k") - 1) / 2.0
    return pairs.select(F.col(f"{group}_a").alias("group_a"), F.col(f"{group}_b").alias("group_b"),
                        F.concat(F.col(f"{group}_a"), F.lit(" vs "), F.col(f"{group}_b")).alias("pair"),
                        F.col("median_a"), F.col("median_b"), z.alias("z"), m.alias("m"))


def with_dunn_p(pairs: DataFrame) -> DataFrame:
    p = p_norm2(F.col("z"))
    return pairs.withColumn("p_adj", F.least(F.lit(1.0), p * F.col("m")))


def mann_whitney(df: DataFrame, flag: str, value: str, first: int = 0) -> DataFrame:
    """H4: U of group ``flag == first``, rank-biserial 2U/(n1 n2) - 1, tie-corrected z."""
    d = df.withColumn("_g", F.when(F.col(flag) == first, F.lit(1)).otherwise(F.lit(2)))
    g, glob = group_rank_sums(d.filter(F.col(flag).isNotNull()), "_g", value)
    piv = g.agg(F.sum(F.when(F.col("_g") == 1, F.col("n"))).alias("n1"),
                F.sum(F.when(F.col("_g") == 2, F.col("n"))).alias("n2"),
                F.sum(F.when(F.col("_g") == 1, F.col("rank_sum"))).alias("r1"))
    s = J.with_global(piv, glob)
    n1, n2, N = F.col("n1").cast("double"), F.col("n2").cast("double"), F.col("N").cast("double")
    u = F.col("r1") - n1 * (n1 + 1) / 2.0
    mu = n1 * n2 / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((N + 1) - F.col("ties") / (N * (N - 1))))
    diff = u - mu
    z = (diff - F.signum(diff) * 0.5) / sigma    # continuity correction
    return s.select(F.col("n1"), F.col("n2"), u.alias("U"), z.alias("z"),
                    (2.0 * u / (n1 * n2) - 1.0).alias("rank_biserial"))


def _weighted_corr(t: DataFrame, x: str, y: str, w: str = "cnt") -> DataFrame:
    """Pearson r of (x, y) with frequency weights, from centred sums (two passes)."""
    m = t.agg((F.sum(F.col(w) * F.col(x)) / F.sum(w)).alias("_mx"),
              (F.sum(F.col(w) * F.col(y)) / F.sum(w)).alias("_my"), F.sum(w).alias("n"))
    c = J.with_global(t, m)
    dx, dy = F.col(x) - F.col("_mx"), F.col(y) - F.col("_my")
    s = c.groupBy("n").agg(F.sum(F.col(w) * dx * dy).alias("_sxy"), F.sum(F.col(w) * dx * dx).alias("_sxx"),
                           F.sum(F.col(w) * dy * dy).alias("_syy"))
    return s.select("n", (F.col("_sxy") / F.sqrt(F.col("_sxx") * F.col("_syy"))).alias("r"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """H5: Pearson correlation of pooled mid-ranks, Fisher-z 95 % CI.

    Works on the (x, y, cnt) pair table; each margin is ranked on its own
    value-count table.
    """
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    pair = d.groupBy(x, y).agg(F.count(F.lit(1)).alias("cnt"))
    rx = mid_rank_table(pair.groupBy(x).agg(F.sum("cnt").alias("cnt")), x).select(x, F.col("rank").alias("_rx"))
    ry = mid_rank_table(pair.groupBy(y).agg(F.sum("cnt").alias("cnt")), y).select(y, F.col("rank").alias("_ry"))
    t = pair.join(rx, x).join(ry, y)
    return with_fisher_ci(_weighted_corr(t, "_rx", "_ry"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r (centred two-pass sums) and n."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), F.lit(1).alias("cnt"))
    return _weighted_corr(d, "_x", "_y")


def with_fisher_ci(r: DataFrame) -> DataFrame:
    z = F.atanh(F.col("r"))
    se = F.lit(1.0) / F.sqrt(F.col("n") - 3.0)
    return r.withColumn("ci_lo", F.tanh(z - Z975 * se)).withColumn("ci_hi", F.tanh(z + Z975 * se))


def with_corr_p(r: DataFrame) -> DataFrame:
    t = F.col("r") * F.sqrt((F.col("n") - 2.0) / (F.lit(1.0) - F.col("r") ** 2))
    return r.withColumn("p", p_t2(t, F.col("n") - 2.0))


def chi2_independence(df: DataFrame, x: str, y: str, yates: bool = True) -> DataFrame:
    """H6: Pearson chi-square, dof, Cramer's V (Yates-corrected when dof = 1).

    Only observed cells are looked at: what the others add is their expected
    counts, the total less the observed cells' ones.  In a 2 x 2 table all
    cells differ from their expectation by the same amount, which Yates'
    correction lowers.
    """
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    obs = d.groupBy(x, y).agg(F.count(F.lit(1)).alias("o"))
    rows = obs.groupBy(x).agg(F.sum("o").alias("rt"))
    cols = obs.groupBy(y).agg(F.sum("o").alias("ct"))
    tot = rows.agg(F.sum("rt").alias("n"), F.count(F.lit(1)).alias("r"), F.sum(1.0 / F.col("rt")).alias("ir"))
    nc = cols.agg(F.count(F.lit(1)).alias("c"), F.sum(1.0 / F.col("ct")).alias("ic"))
    cells = J.with_global(J.with_global(obs.join(rows, x).join(cols, y), tot), nc)
    e = F.col("rt") * (F.col("ct") / F.col("n"))
    diff = F.abs(F.col("o") - e)
    s = cells.groupBy("n", "r", "c", "ir", "ic").agg(F.sum(diff * diff / e).alias("seen"), F.sum(e).alias("es"), F.max(diff).alias("d"))
    dof = (F.col("r") - 1) * (F.col("c") - 1)
    less = F.col("d") - F.least(F.col("d"), F.lit(0.5))
    plain = F.col("seen") + F.greatest(F.col("n") - F.col("es"), F.lit(0.0))
    chi2 = F.when(F.lit(yates) & (dof == 1), less * less * F.col("n") * F.col("ir") * F.col("ic")).otherwise(plain)
    s = s.withColumns({"chi2": chi2, "dof": dof})
    v = F.sqrt(F.col("chi2") / (F.col("n") * (F.least(F.col("r"), F.col("c")) - 1)))
    return s.select("chi2", "dof", "n", v.alias("cramers_v"))


def two_proportion_z(df: DataFrame, in_group1: Column, flag: str) -> DataFrame:
    """H7: pooled two-proportion z (group 1 = rows where ``in_group1``; group 2 = the rest)."""
    d = df.filter(F.col(flag).isNotNull())
    a = d.agg(F.sum(F.when(in_group1, F.col(flag))).alias("x1"), F.count_if(in_group1).alias("n1"),
              F.sum(F.when(~in_group1, F.col(flag))).alias("x2"), F.count_if(~in_group1).alias("n2"))
    p1, p2 = F.col("x1") / F.col("n1"), F.col("x2") / F.col("n2")
    p = (F.col("x1") + F.col("x2")) / (F.col("n1") + F.col("n2"))
    z = (p1 - p2) / F.sqrt(p * (1 - p) * (1.0 / F.col("n1") + 1.0 / F.col("n2")))
    return a.select((p1 * 100).alias("pct1"), "n1", (p2 * 100).alias("pct2"), "n2", z.alias("z"))


def welch_t(df: DataFrame, flag: str, value: str, first: int = 0) -> DataFrame:
    """H8: Welch's t (group ``flag == first`` minus the other) and Welch-Satterthwaite df."""
    d = df.filter(F.col(flag).isNotNull() & F.col(value).isNotNull())
    g1 = F.col(flag) == first
    a = d.agg(F.avg(F.when(g1, F.col(value))).alias("m1"), F.var_samp(F.when(g1, F.col(value))).alias("v1"),
              F.count_if(g1).alias("n1"), F.avg(F.when(~g1, F.col(value))).alias("m2"),
              F.var_samp(F.when(~g1, F.col(value))).alias("v2"), F.count_if(~g1).alias("n2"))
    s1, s2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    t = (F.col("m1") - F.col("m2")) / F.sqrt(s1 + s2)
    dfw = (s1 + s2) ** 2 / (s1 ** 2 / (F.col("n1") - 1) + s2 ** 2 / (F.col("n2") - 1))
    return a.select("n1", "n2", "m1", "m2", t.alias("t"), dfw.alias("df"))


def anova_f(df: DataFrame, group: str, value: str) -> DataFrame:
    """H9: one-way ANOVA F over non-empty groups (between / within sums of squares)."""
    d = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    g = d.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"),
                             (F.var_pop(value) * F.count(F.lit(1))).alias("ssw"))
    grand = g.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("_gm"))
    j = J.with_global(g, grand)
    s = j.agg(F.sum(F.col("n") * (F.col("m") - F.col("_gm")) ** 2).alias("ssb"), F.sum("ssw").alias("ssw"),
              F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"))
    f = (F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k")))
    return s.select(f.alias("F"), (F.col("k") - 1).alias("df1"), (F.col("N") - F.col("k")).alias("df2"))


# ---------------------------------------------------------------------------
# H13 median CI, order-statistic form
# ---------------------------------------------------------------------------
def median_ci(df: DataFrame, group: str, value: str) -> DataFrame:
    """95 % percentile-bootstrap CI of the median per group, in closed form.

    The bootstrap distribution of the median depends on the sample only
    through its order statistics, and which ones bound the CI depends on n
    only; the ranks come from ``special.median_ci_ranks`` per *distinct n*
    and the values are picked from the per-group prefix counts (range
    partitioned, so a hot group is spread over many tasks).
    """
    d = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    gvc = value_counts_table(d, value, [group])
    pc = prefix_counts(gvc, value, [group])
    ns = pc.select(group, F.col("total").alias("n")).distinct()
    ks = ns.select("n").distinct().withColumn("_k", median_ci_rank_udf(F.col("n")))
    gk = ns.join(ks, "n").select(group, "n", F.posexplode("_k").alias("_which", "_rank"))
    j = pc.join(gk, group).filter((F.col("before") < F.col("_rank")) &
                                  (F.col("_rank") <= F.col("before") + F.col("cnt")))
    v = j.groupBy(group, "n").agg(
        ((F.sum(F.when(F.col("_which") < 2, F.col(value))) / 2.0)).alias("ci_lo"),
        ((F.sum(F.when(F.col("_which") >= 2, F.col(value))) / 2.0)).alias("ci_hi"))
    return v
