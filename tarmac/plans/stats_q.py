"""Statistics queries (H1-H13, A13, A14, S11) over the enriched table and transit.

Oracle-checked queries return the test statistics; the ``*_report`` queries
add p-values, verdicts and effect labels (rows-only check: the oracle engine
has no distribution functions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import bootstrap as BS
from ..operators import joins as J
from ..operators import selection as SEL
from ..operators import stats as ST
from ..sources import tables as TB
from . import sql as Q
from .enrich import enriched
from .registry import register
from .views import R, completed, rnd, top_carrier_rows, top_sql

CARRIER_VS_REST = "C07"   # the "one carrier vs all the others" comparison


def _big_carriers(df: DataFrame, min_n: int = S.MIN_FLIGHTS) -> DataFrame:
    """Completed rows of carriers with at least ``min_n`` non-null clipped delays."""
    c = completed(df).filter(F.col("delay_min").isNotNull())
    big = A.group_counts(c, ["carrier"]).filter(F.col("n") >= min_n).select("carrier")
    return J.semi_join(c, big, "carrier")


_CD = "cd AS (SELECT * FROM enriched WHERE is_cancelled = 0)"
_BIG = f"""{_CD},
big AS (SELECT * FROM cd WHERE delay_min IS NOT NULL AND carrier IN
        (SELECT carrier FROM cd WHERE delay_min IS NOT NULL GROUP BY carrier HAVING count(*) >= {S.MIN_FLIGHTS}))"""


def _ranked(src: str, g: str, v: str) -> str:
    """CTEs r (row mid-ranks), grp (n, rank sum per group), tt (N, tie term)."""
    return f"""
d AS (SELECT {g} AS g, {v} AS v FROM {src} WHERE {g} IS NOT NULL AND {v} IS NOT NULL),
r AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM d),
grp AS (SELECT g, count(*) AS n, sum(rk) AS rs FROM r GROUP BY g),
tt AS (SELECT sum(t) AS nn, sum(t * t * t - t) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM d GROUP BY v))"""


def _kruskal_body() -> str:
    return f"""
SELECT round(h, {R}) AS H, df, n, round(h / (n - 1), {R}) AS eps2 FROM (
  SELECT (12.0 / (nn * (nn + 1)) * sum(rs * rs / n) - 3 * (nn + 1)) / (1 - ties / (nn * nn * nn - nn)) AS h,
         count(*) - 1 AS df, CAST(nn AS BIGINT) AS n
  FROM grp, tt GROUP BY nn, ties)"""


def _kr_df(k: DataFrame) -> DataFrame:
    return k.select(rnd("H"), "df", F.col("n").cast("long").alias("n"), rnd("eps2"))


# --- H1 ----------------------------------------------------------------------------
@register("shape", Q.q_enriched(f"""
SELECT n, round(mu, {R}) AS mean, round(m3 / pow(m2, 1.5), {R}) AS skewness,
       round(m4 / (m2 * m2) - 3, {R}) AS kurtosis,
       round(n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4), 4) AS jarque_bera
FROM (SELECT count(*) AS n, any_value(mu) AS mu, avg(pow(x - mu, 2)) AS m2, avg(pow(x - mu, 3)) AS m3,
             avg(pow(x - mu, 4)) AS m4
      FROM (SELECT delay_signed AS x, avg(delay_signed) OVER () AS mu FROM cd WHERE delay_signed IS NOT NULL))""",
                                    extra=_CD))
def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = ST.distribution_shape(completed(enriched(spark, sf_dir)), "delay_signed")
    return s.select("n", rnd("mean"), rnd("skewness"), rnd("kurtosis"), F.round("jarque_bera", 4).alias("jarque_bera"))


@register("shape_report")
def shape_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 with the Jarque-Bera p-value and normality decision (whole column, no sample)."""
    return ST.with_shape_p(ST.distribution_shape(completed(enriched(spark, sf_dir)), "delay_signed"))


# --- A13 / A14 ---------------------------------------------------------------------
@register("describe_by_carrier", Q.q_enriched(f"""
SELECT b.carrier, b.n, b.median, b.mean, b.iqr, round(l.pct_late, {R}) AS pct_late, round(c.pct_cancelled, {R}) AS pct_cancelled
FROM (SELECT carrier, count(*) AS n, quantile_cont(delay_min, 0.5) AS median, round(avg(delay_min), {R}) AS mean,
             quantile_cont(delay_min, 0.75) - quantile_cont(delay_min, 0.25) AS iqr FROM big GROUP BY carrier) b
JOIN (SELECT carrier, avg(is_late) * 100 AS pct_late FROM cd GROUP BY carrier) l USING (carrier)
JOIN (SELECT carrier, avg(is_cancelled) * 100 AS pct_cancelled FROM enriched GROUP BY carrier) c USING (carrier)""",
                                                  extra=_BIG))
def describe_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One grouping per population, conditional aggregates where they share one."""
    df = enriched(spark, sf_dir)
    big = _big_carriers(df)
    q = A.quantile("delay_min", [0.25, 0.5, 0.75])
    b = big.groupBy("carrier").agg(F.count(F.lit(1)).alias("n"), q.alias("_q"), F.avg("delay_min").alias("mean"))
    b = b.select("carrier", "n", F.col("_q")[1].alias("median"), rnd("mean"),
                 (F.col("_q")[2] - F.col("_q")[0]).alias("iqr"))
    allc = df.groupBy("carrier").agg(
        (F.avg(F.when(F.col("is_cancelled") == 0, F.col("is_late"))) * 100).alias("pct_late"),
        (F.avg("is_cancelled") * 100).alias("pct_cancelled"))
    return b.join(allc, "carrier").select("carrier", "n", "median", "mean", "iqr", rnd("pct_late"),
                                          rnd("pct_cancelled"))


@register("overall_summary", Q.q_enriched(f"""
SELECT count(delay_min) AS n, quantile_cont(delay_min, 0.5) AS median, round(avg(delay_min), {R}) AS mean,
       count(*) AS n_rows, (SELECT count(*) FROM enriched WHERE is_cancelled = 1) AS n_cancelled,
       (SELECT count(*) FROM enriched WHERE is_outlier = 1) AS n_outliers
FROM cd""", extra=_CD))
def overall_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-null n, median, mean of completed delays, plus row / cancellation / outlier counts."""
    df = enriched(spark, sf_dir)
    cm = F.col("is_cancelled") == 0
    median = SEL.quantiles(df, {"d": (F.when(cm, F.col("delay_min")), [0.5])})["d"][0]
    a = df.agg(F.count(F.when(cm, F.col("delay_min"))).alias("n"), F.lit(median).cast("double").alias("median"),
               F.avg(F.when(cm, F.col("delay_min"))).alias("mean"),
               F.count_if(cm).alias("n_rows"), F.count_if(~cm).alias("n_cancelled"),
               F.count_if(F.col("is_outlier") == 1).alias("n_outliers"))
    return a.select("n", "median", rnd("mean"), "n_rows", "n_cancelled", "n_outliers")


# --- H2 Kruskal-Wallis ---------------------------------------------------------------
@register("kruskal_carrier", Q.q_enriched(_kruskal_body(), extra=_BIG + "," + _ranked("big", "carrier", "delay_min")))
def kruskal_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kr_df(ST.kruskal(_big_carriers(enriched(spark, sf_dir)), "carrier", "delay_min"))


@register("kruskal_day_part", Q.q_enriched(_kruskal_body(), extra=_CD + "," + _ranked("cd", "day_part", "delay_min")))
def kruskal_day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kr_df(ST.kruskal(completed(enriched(spark, sf_dir)), "day_part", "delay_min"))


@register("kruskal_priority", Q.q_transit(_kruskal_body(), extra=_ranked("transit", "o_orderpriority", "value")))
def kruskal_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 on transit days by order priority (many ties, signed values)."""
    return _kr_df(ST.kruskal(TB.transit(spark, sf_dir), "o_orderpriority", "value"))


def kruskal_report_df(df: DataFrame, group: str, value: str, label: str) -> DataFrame:
    k = ST.kruskal(df, group, value)
    k = k.withColumn("p", ST.p_chi2(F.col("H"), F.col("df")))
    return k.select(F.lit(label).alias("group"), "H", "df", "p", "n", "eps2",
                    C.eps2_label("eps2").alias("effect"), C.verdict("p").alias("verdict"))


@register("kruskal_report")
def kruskal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = enriched(spark, sf_dir)
    return kruskal_report_df(_big_carriers(df), "carrier", "delay_min", "carrier").unionByName(
        kruskal_report_df(completed(df), "day_part", "delay_min", "day_part"))


# --- H3 Dunn ---------------------------------------------------------------------------
def _dunn_sql(src: str, g: str) -> str:
    return f"""
SELECT a.g AS group_a, b.g AS group_b, a.g || ' vs ' || b.g AS pair, a.med AS median_a, b.med AS median_b,
       round((a.rs / a.n - b.rs / b.n) / sqrt((nn * (nn + 1) / 12.0 - ties / (12.0 * (nn - 1))) * (1.0 / a.n + 1.0 / b.n)), {R}) AS z,
       k * (k - 1) / 2.0 AS m
FROM gm a JOIN gm b ON a.g < b.g, tt, (SELECT count(*) AS k FROM grp)"""


def _dunn_extra(src: str, g: str, v: str) -> str:
    return _ranked(src, g, v) + f""",
gm AS (SELECT grp.*, med FROM grp JOIN (SELECT g, quantile_cont(v, 0.5) AS med FROM d GROUP BY g) USING (g))"""


def _dunn_df(p: DataFrame) -> DataFrame:
    return p.select("group_a", "group_b", "pair", "median_a", "median_b", rnd("z"), "m")


@register("dunn_day_part", Q.q_enriched(_dunn_sql("cd", "day_part"), extra=_CD + "," + _dunn_extra("cd", "day_part", "delay_min")))
def dunn_day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dunn_df(ST.dunn(completed(enriched(spark, sf_dir)), "day_part", "delay_min"))


@register("dunn_carrier", Q.q_enriched(_dunn_sql("big", "carrier"), extra=_BIG + "," + _dunn_extra("big", "carrier", "delay_min")))
def dunn_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dunn_df(ST.dunn(_big_carriers(enriched(spark, sf_dir)), "carrier", "delay_min"))


@register("dunn_report")
def dunn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 + T3: every pair with its Bonferroni p, smallest first, and the top-10 flag."""
    p = ST.with_dunn_p(ST.dunn(_big_carriers(enriched(spark, sf_dir)), "carrier", "delay_min"))
    from pyspark.sql import Window
    w = Window.orderBy("p_adj", "pair")   # one row per pair of groups: small
    return p.withColumn("order", F.row_number().over(w)).withColumn("top10", F.col("order") <= 10).withColumn(
        "verdict", C.verdict("p_adj"))


# --- H4 Mann-Whitney -------------------------------------------------------------------
@register("mann_whitney", Q.q_enriched(f"""
SELECT n1, n2, u AS U, round((u - n1 * n2 / 2.0 - sign(u - n1 * n2 / 2.0) * 0.5)
                               / sqrt(n1 * n2 / 12.0 * ((nn + 1) - ties / (nn * (nn - 1)))), {R}) AS z,
       round(2.0 * u / (n1 * n2) - 1, {R}) AS rank_biserial
FROM (SELECT sum(n) FILTER (WHERE g = 0) AS n1, sum(n) FILTER (WHERE g = 1) AS n2,
             sum(rs) FILTER (WHERE g = 0) - sum(n) FILTER (WHERE g = 0) * (sum(n) FILTER (WHERE g = 0) + 1) / 2.0 AS u,
             any_value(nn) AS nn, any_value(ties) AS ties FROM grp, tt)""",
                                      extra=_CD + "," + _ranked("cd", "is_weekend", "delay_min")))
def mann_whitney(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ST.mann_whitney(completed(enriched(spark, sf_dir)), "is_weekend", "delay_min", first=0)
    return m.select("n1", "n2", "U", rnd("z"), rnd("rank_biserial"))


# --- H5 Spearman / H10 Pearson -----------------------------------------------------------
def _spearman_sql(x: str) -> str:
    return Q.q_enriched(f"""
SELECT count(*) AS n, round(r, {R}) AS r, round(tanh(atanh(r) - 1.959963984540054 / sqrt(count(*) - 3)), {R}) AS ci_lo,
       round(tanh(atanh(r) + 1.959963984540054 / sqrt(count(*) - 3)), {R}) AS ci_hi
FROM (SELECT *, corr(rx, ry) OVER () AS r FROM (
  SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
  FROM (SELECT {x} AS x, delay_min AS y FROM cd WHERE {x} IS NOT NULL AND delay_min IS NOT NULL)))
GROUP BY r""", extra=_CD)


def _spearman_df(df: DataFrame, x: str) -> DataFrame:
    s = ST.spearman(completed(df), x, "delay_min")
    return s.select("n", rnd("r"), rnd("ci_lo"), rnd("ci_hi"))


@register("spearman_hour", _spearman_sql("planned_hour"))
def spearman_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spearman_df(enriched(spark, sf_dir), "planned_hour")


@register("spearman_distance", _spearman_sql("distance_km"))
def spearman_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spearman_df(enriched(spark, sf_dir), "distance_km")


def _pearson_sql(x: str) -> str:
    return Q.q_enriched(f"""
SELECT count(*) AS n, round(corr(x, y), {R}) AS r
FROM (SELECT CAST({x} AS DOUBLE) AS x, delay_min AS y FROM cd WHERE {x} IS NOT NULL AND delay_min IS NOT NULL)""",
                        extra=_CD)


@register("pearson_hour", _pearson_sql("planned_hour"))
def pearson_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.pearson(completed(enriched(spark, sf_dir)), "planned_hour", "delay_min").select("n", rnd("r"))


@register("pearson_distance", _pearson_sql("distance_km"))
def pearson_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.pearson(completed(enriched(spark, sf_dir)), "distance_km", "delay_min").select("n", rnd("r"))


# --- H6 chi-square ------------------------------------------------------------------------
def _chi2_sql(src: str, x: str, y: str) -> str:
    return f"""
SELECT round(sum(pow(abs(o - e) - CASE WHEN dof = 1 THEN least(abs(o - e), 0.5) ELSE 0 END, 2) / e), {R}) AS chi2,
       any_value(dof) AS dof, any_value(n) AS n,
       round(sqrt(sum(pow(abs(o - e) - CASE WHEN dof = 1 THEN least(abs(o - e), 0.5) ELSE 0 END, 2) / e)
                  / (any_value(n) * (least(any_value(r), any_value(c)) - 1))), {R}) AS cramers_v
FROM (SELECT coalesce(ob.o, 0) AS o, rt * ct * 1.0 / n AS e, (r - 1) * (c - 1) AS dof, n, r, c
      FROM (SELECT x, count(*) AS rt FROM cc GROUP BY x) rr
      CROSS JOIN (SELECT y, count(*) AS ct FROM cc GROUP BY y) cl
      LEFT JOIN (SELECT x, y, count(*) AS o FROM cc GROUP BY x, y) ob USING (x, y)
      CROSS JOIN (SELECT count(*) AS n, count(DISTINCT x) AS r, count(DISTINCT y) AS c FROM cc))"""


def _chi2_df(d: DataFrame, x: str, y: str) -> DataFrame:
    c = ST.chi2_independence(d, x, y)
    return c.select(rnd("chi2"), "dof", "n", rnd("cramers_v"))


@register("chi2_day_part_late", Q.q_enriched(_chi2_sql("cd", "day_part", "is_late"), extra=_CD + """,
cc AS (SELECT day_part AS x, is_late AS y FROM cd WHERE day_part IS NOT NULL AND is_late IS NOT NULL)"""))
def chi2_day_part_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chi2_df(completed(enriched(spark, sf_dir)), "day_part", "is_late")


@register("chi2_weekend_late", Q.q_enriched(_chi2_sql("cd", "is_weekend", "is_late"), extra=_CD + """,
cc AS (SELECT is_weekend AS x, is_late AS y FROM cd WHERE is_weekend IS NOT NULL AND is_late IS NOT NULL)"""))
def chi2_weekend_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chi2_df(completed(enriched(spark, sf_dir)), "is_weekend", "is_late")


@register("chi2_carrier_cancel", Q.q_enriched(_chi2_sql("enriched", "carrier", "is_cancelled"), extra=f"""
cc AS (SELECT carrier AS x, is_cancelled AS y FROM enriched WHERE carrier IN
       (SELECT carrier FROM enriched GROUP BY carrier HAVING count(*) >= {S.MIN_FLIGHTS}))"""))
def chi2_carrier_cancel(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = enriched(spark, sf_dir)
    big = A.group_counts(df, ["carrier"]).filter(F.col("n") >= S.MIN_FLIGHTS).select("carrier")
    return _chi2_df(J.semi_join(df, big, "carrier"), "carrier", "is_cancelled")


# --- H7 two proportions -----------------------------------------------------------------------
def _prop_sql(src: str, cond: str, flag: str) -> str:
    return f"""
SELECT round(x1 * 100.0 / n1, {R}) AS pct1, n1, round(x2 * 100.0 / n2, {R}) AS pct2, n2,
       round((x1 * 1.0 / n1 - x2 * 1.0 / n2) / sqrt(((x1 + x2) * 1.0 / (n1 + n2)) * (1 - (x1 + x2) * 1.0 / (n1 + n2))
             * (1.0 / n1 + 1.0 / n2)), {R}) AS z
FROM (SELECT sum({flag}) FILTER (WHERE {cond}) AS x1, count(*) FILTER (WHERE {cond}) AS n1,
             sum({flag}) FILTER (WHERE NOT ({cond})) AS x2, count(*) FILTER (WHERE NOT ({cond})) AS n2
      FROM {src} WHERE {flag} IS NOT NULL)"""


def _prop_df(p: DataFrame) -> DataFrame:
    return p.select(rnd("pct1"), "n1", rnd("pct2"), "n2", rnd("z"))


@register("two_proportions_weekend", Q.q_enriched(_prop_sql("cd", "is_weekend = 1", "is_late"), extra=_CD))
def two_proportions_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = completed(enriched(spark, sf_dir))
    return _prop_df(ST.two_proportion_z(d, F.col("is_weekend") == 1, "is_late"))


@register("two_proportions_carrier", Q.q_enriched(_prop_sql("enriched", f"carrier = '{CARRIER_VS_REST}'", "is_cancelled")))
def two_proportions_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = enriched(spark, sf_dir)
    return _prop_df(ST.two_proportion_z(d, F.col("carrier") == CARRIER_VS_REST, "is_cancelled"))


# --- H8 Welch / H9 ANOVA -------------------------------------------------------------------------
@register("welch_weekend", Q.q_enriched(f"""
SELECT n1, n2, round(m1, {R}) AS m1, round(m2, {R}) AS m2, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), {R}) AS t,
       round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 4) AS df
FROM (SELECT avg(delay_min) FILTER (WHERE is_weekend = 0) AS m1, var_samp(delay_min) FILTER (WHERE is_weekend = 0) AS v1,
             count(*) FILTER (WHERE is_weekend = 0) AS n1,
             avg(delay_min) FILTER (WHERE is_weekend = 1) AS m2, var_samp(delay_min) FILTER (WHERE is_weekend = 1) AS v2,
             count(*) FILTER (WHERE is_weekend = 1) AS n2
      FROM cd WHERE delay_min IS NOT NULL AND is_weekend IS NOT NULL)""", extra=_CD))
def welch_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = ST.welch_t(completed(enriched(spark, sf_dir)), "is_weekend", "delay_min", first=0)
    return w.select("n1", "n2", rnd("m1"), rnd("m2"), rnd("t"), F.round("df", 4).alias("df"))


@register("anova_day_part", Q.q_enriched(f"""
SELECT round((ssb / (k - 1)) / (ssw / (nn - k)), {R}) AS F, k - 1 AS df1, nn - k AS df2
FROM (SELECT sum(n * pow(m - gm, 2)) AS ssb, sum(ssw) AS ssw, count(*) AS k, sum(n) AS nn FROM (
        SELECT n, m, ssw, sum(n * m) OVER () / sum(n) OVER () AS gm FROM (
          SELECT day_part, count(*) AS n, avg(delay_min) AS m, var_pop(delay_min) * count(*) AS ssw
          FROM cd WHERE day_part IS NOT NULL AND delay_min IS NOT NULL GROUP BY day_part)))""", extra=_CD))
def anova_day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = ST.anova_f(completed(enriched(spark, sf_dir)), "day_part", "delay_min")
    return a.select(rnd("F"), "df1", "df2")


# --- H13 median CI --------------------------------------------------------------------------------
def _median_ci_sql(rows: str, group: str, value: str) -> str:
    """Ends of the median's percentile bootstrap interval in SQL: binomial tails summed term by term."""
    return f"""
v AS (SELECT {group} AS g, {value} AS x, row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS r
      FROM {rows} WHERE {value} IS NOT NULL),
ns AS (SELECT g, count(*) AS n FROM v GROUP BY g),
ms AS (SELECT DISTINCT n, unnest([(n + 1) // 2, n // 2 + 1]) AS m FROM ns WHERE n > 1),
ks AS (SELECT n, m, unnest(range(1, n + 1)) AS k FROM ms),
ps AS (SELECT n, m, k, CASE WHEN k = n THEN 1.0 ELSE list_sum(list_transform(range(m, n + 1), lambda j:
         exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(k * 1.0 / n) + (n - j) * ln(1 - k * 1.0 / n)))) END AS p
       FROM ks),
ends AS (SELECT n, m, min(k) FILTER (p >= 0.025) AS lo, min(k) FILTER (p >= 0.975) AS hi FROM ps GROUP BY n, m),
ci AS (SELECT ns.g, ns.n, avg(a.x) AS ci_lo, avg(b.x) AS ci_hi FROM ns JOIN ends USING (n)
       JOIN v a ON a.g = ns.g AND a.r = ends.lo JOIN v b ON b.g = ns.g AND b.r = ends.hi GROUP BY ns.g, ns.n)"""


@register("median_ci_ranks", Q.q_enriched("SELECT g AS carrier, n, ci_lo, ci_hi FROM ci",
                                          extra=_BIG + "," + _median_ci_sql("big", "carrier", "delay_min")))
def median_ci_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H13 per carrier with >= 30 delays (closed-form percentile bootstrap)."""
    return ST.median_ci(_big_carriers(enriched(spark, sf_dir)), "carrier", "delay_min")


# --- H11 / H12 / S11 --------------------------------------------------------------------------------
def _tests_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test as (question, test, kind, statistic, p, effect, effect_value)."""
    df = enriched(spark, sf_dir)
    cd = completed(df)
    rows = []
    w = ST.welch_t(cd, "is_weekend", "delay_min")
    rows.append(w.select(F.lit("weekend vs weekday").alias("question"), F.lit("Welch t").alias("test"),
                         F.lit("parametric").alias("kind"), F.col("t").alias("statistic"),
                         ST.p_t2(F.col("t"), F.col("df")).alias("p"), F.lit(None).cast("double").alias("effect_value")))
    m = ST.mann_whitney(cd, "is_weekend", "delay_min")
    rows.append(m.select(F.lit("weekend vs weekday").alias("question"), F.lit("Mann-Whitney").alias("test"),
                         F.lit("rank").alias("kind"), F.col("U").alias("statistic"), ST.p_norm2(F.col("z")).alias("p"),
                         F.col("rank_biserial").alias("effect_value")))
    a = ST.anova_f(cd, "day_part", "delay_min")
    rows.append(a.select(F.lit("day part").alias("question"), F.lit("ANOVA").alias("test"),
                         F.lit("parametric").alias("kind"), F.col("F").alias("statistic"),
                         ST.p_f(F.col("F"), F.col("df1"), F.col("df2")).alias("p"),
                         F.lit(None).cast("double").alias("effect_value")))
    k = ST.kruskal(cd, "day_part", "delay_min")
    rows.append(k.select(F.lit("day part").alias("question"), F.lit("Kruskal-Wallis").alias("test"),
                         F.lit("rank").alias("kind"), F.col("H").alias("statistic"),
                         ST.p_chi2(F.col("H"), F.col("df")).alias("p"), F.col("eps2").alias("effect_value")))
    for x, q in (("planned_hour", "hour vs delay"), ("distance_km", "distance vs delay")):
        pe = ST.with_corr_p(ST.pearson(cd, x, "delay_min"))
        rows.append(pe.select(F.lit(q).alias("question"), F.lit("Pearson").alias("test"),
                              F.lit("parametric").alias("kind"), F.col("r").alias("statistic"), "p",
                              F.col("r").alias("effect_value")))
        sp = ST.with_corr_p(ST.spearman(cd, x, "delay_min"))
        rows.append(sp.select(F.lit(q).alias("question"), F.lit("Spearman").alias("test"),
                              F.lit("rank").alias("kind"), F.col("r").alias("statistic"), "p",
                              F.col("r").alias("effect_value")))
    out = rows[0]
    for r_ in rows[1:]:
        out = out.unionByName(r_)
    return out


@register("robustness")
def robustness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parametric vs rank verdict per question; flag disagreements."""
    t = _tests_long(spark, sf_dir).withColumn("verdict", C.verdict("p"))
    par = t.filter(F.col("kind") == "parametric").select(
        "question", F.concat_ws("", F.col("test"), F.lit(": "), F.col("verdict"), F.lit(" (p="),
                                C.format_p("p"), F.lit(")")).alias("parametric"), F.col("verdict").alias("_v1"))
    rk = t.filter(F.col("kind") == "rank").select(
        "question", F.concat_ws("", F.col("test"), F.lit(": "), F.col("verdict"), F.lit(" (p="),
                                C.format_p("p"), F.lit(")")).alias("rank_based"), F.col("verdict").alias("_v2"))
    j = par.join(rk, "question")
    return j.select("question", "parametric", "rank_based",
                    F.when(F.col("_v1") != F.col("_v2"), "yes - trust the rank test").otherwise("no").alias("disagree"))


@register("effect_guard")
def effect_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Significant results whose effect is too small to matter."""
    t = _tests_long(spark, sf_dir).filter(F.col("kind") == "rank")
    cut = (F.when(F.col("test") == "Kruskal-Wallis", F.col("effect_value") < 0.06)
           .when(F.col("test") == "Mann-Whitney", F.abs(F.col("effect_value")) < 0.1)
           .when(F.col("test") == "Spearman", F.abs(F.col("effect_value")) < 0.1).otherwise(F.lit(False)))
    d = completed(enriched(spark, sf_dir))
    chi = ST.chi2_independence(d, "day_part", "is_late")
    chi = chi.select(F.lit("day part x late").alias("question"), F.lit("chi-square").alias("test"),
                     F.lit("rank").alias("kind"), F.col("chi2").alias("statistic"),
                     ST.p_chi2(F.col("chi2"), F.col("dof")).alias("p"), F.col("cramers_v").alias("effect_value"))
    t = t.withColumn("_small", cut).unionByName(chi.withColumn("_small", F.col("effect_value") < 0.1))
    return t.filter((F.col("p") < S.ALPHA) & F.col("_small")).drop("_small")


@register("stats_report")
def stats_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test result collected into one long table (section, item, metric, value)."""
    t = _tests_long(spark, sf_dir)
    long = t.select(F.lit("tests").alias("section"), F.concat_ws(" / ", "question", "test").alias("item"),
                    F.expr("stack(3, 'statistic', statistic, 'p', p, 'effect', effect_value) AS (metric, value)"))
    d = describe_by_carrier(spark, sf_dir)
    dl = d.select(F.lit("describe_by_carrier").alias("section"), F.col("carrier").alias("item"),
                  F.expr("stack(4, 'n', CAST(n AS DOUBLE), 'median', median, 'mean', mean, 'iqr', iqr) AS (metric, value)"))
    return long.unionByName(dl)


@register("late_share_ci_day_part", Q.q_enriched(f"""
SELECT day_part, k, n, round(k * 100.0 / n, {R}) AS pct,
       round(min(j) FILTER (cdf >= 0.025) * 100.0 / n, {R}) AS ci_lo, round(min(j) FILTER (cdf >= 0.975) * 100.0 / n, {R}) AS ci_hi
FROM (SELECT day_part, k, n, j, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(k * 1.0 / n)
             + (n - j) * ln(1 - k * 1.0 / n))) OVER (PARTITION BY day_part ORDER BY j) AS cdf
      FROM (SELECT day_part, k, n, unnest(range(0, n + 1)) AS j FROM (
              SELECT day_part, sum(is_late)::BIGINT AS k, count(*) AS n FROM cd WHERE is_late IS NOT NULL GROUP BY day_part)))
GROUP BY day_part, k, n""", extra=_CD))
def late_share_ci_day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E06 interval: percentile-bootstrap CI of the late share per day part, in closed
    form (a resampled count of late flights is Binomial(n, k/n))."""
    c = ST.share_ci(completed(enriched(spark, sf_dir)), "day_part", "is_late")
    return c.select("day_part", "k", "n", *[rnd(x) for x in ("pct", "ci_lo", "ci_hi")])


@register("median_by_carrier_ci", Q.q_enriched("""
SELECT g AS carrier, ci.n, quantile_cont(delay_min, 0.5) AS median_delay, ci_lo, ci_hi
FROM ci JOIN tc ON tc.carrier = ci.g GROUP BY ALL""", extra=top_sql() + "," + _median_ci_sql("tc", "carrier", "delay_min")))
def median_by_carrier_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E03 with its interval: median delay per top carrier and the limit of its percentile bootstrap interval."""
    d = top_carrier_rows(enriched(spark, sf_dir))
    m = d.groupBy("carrier").agg(A.median("delay_min").alias("median_delay"))
    return m.join(ST.median_ci(d, "carrier", "delay_min"), "carrier").select("carrier", "n", "median_delay", "ci_lo", "ci_hi")


@register("median_ci_bootstrap")
def median_ci_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H13 by drawing: 2000 seeded resamples of every top carrier's median."""
    return BS.bootstrap_ci(top_carrier_rows(enriched(spark, sf_dir)), "carrier", "delay_min", BS.Quantile(0.5))


@register("mean_ci_bootstrap")
def mean_ci_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the bootstrap with another statistic passed to it, the mean delay of every top carrier."""
    return BS.bootstrap_ci(top_carrier_rows(enriched(spark, sf_dir)), "carrier", "delay_min", BS.MEAN)
