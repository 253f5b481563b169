"""Named result sets E01-E15 (analysis views) and V1-V6 (board views).

Each view is a lazy plan over the enriched table (E*) or over the raw table
of every status (V*).  Floating outputs are rounded to 6 decimals in both
the Spark plan and the oracle so last-bit differences of sums do not count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import ranks as RK
from ..operators.windows import rolling_median
from ..sources import tables as TB
from . import sql as Q
from .enrich import enriched
from .registry import register

R = 6  # rounding of floating outputs

# Dates of the fixture marked as synthetic in the daily trend.
SYNTHETIC_DATES = ["2024-01-06", "2024-01-07", "2024-01-09", "2024-01-10", "2024-01-11"]


def rnd(c, alias: str | None = None):
    col = F.round(F.col(c) if isinstance(c, str) else c, R)
    return col.alias(alias or (c if isinstance(c, str) else "value"))


def completed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_cancelled") == 0)


def completed_normal(df: DataFrame) -> DataFrame:
    return df.filter((F.col("is_cancelled") == 0) & (F.col("is_outlier") == 0))


def top_carrier_rows(df: DataFrame, top_n: int = S.TOP_N, min_n: int = S.MIN_FLIGHTS) -> DataFrame:
    """T1 + J2: completed rows of the top-N carriers by completed count (floor ``min_n``)."""
    c = completed(df)
    return J.semi_join(c, A.top_groups(c, "carrier", top_n, min_n), "carrier")


def top_sql(min_n: int = S.MIN_FLIGHTS) -> str:
    return f"""
top AS (
  SELECT carrier FROM enriched WHERE is_cancelled = 0 GROUP BY carrier HAVING count(*) >= {min_n}
  ORDER BY count(*) DESC, carrier LIMIT {S.TOP_N}
),
tc AS (SELECT * FROM enriched WHERE is_cancelled = 0 AND carrier IN (SELECT carrier FROM top))"""


# --- E01 histogram + KDE -------------------------------------------------------
@register("histogram", Q.q_enriched(f"""
SELECT bin, round(mn + bin * ((mx - mn) / 80.0), {R}) AS bin_lo,
       round(mn + (bin + 1) * ((mx - mn) / 80.0), {R}) AS bin_hi, n
FROM (SELECT CAST(coalesce(least(floor((delay_signed - mn) * 80.0 / nullif(mx - mn, 0)), 79), 0) AS INTEGER) AS bin,
             mn, mx, count(*) AS n
      FROM c, ext GROUP BY 1, 2, 3)""", extra="""
c AS (SELECT delay_signed FROM enriched WHERE is_cancelled = 0 AND delay_signed IS NOT NULL),
ext AS (SELECT min(delay_signed) AS mn, max(delay_signed) AS mx FROM c)"""))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = A.histogram(completed(enriched(spark, sf_dir)), "delay_signed", 80)
    return h.select("bin", rnd("bin_lo"), rnd("bin_hi"), "n")


@register("kde", Q.q_enriched(f"""
SELECT g.bin, round(g.x, {R}) AS x,
       round(sum(v.cnt * exp(-0.5 * pow((g.x - v.delay_signed) / s.h, 2))) / (s.n * s.h * sqrt(2 * pi())), 9) AS density
FROM grid g, vc v, stats s GROUP BY g.bin, g.x, s.n, s.h""", extra=f"""
c AS (SELECT delay_signed FROM enriched WHERE is_cancelled = 0 AND delay_signed IS NOT NULL),
stats AS (SELECT count(*) AS n, stddev_samp(delay_signed) * pow(count(*), -0.2) AS h,
                 min(delay_signed) AS mn, max(delay_signed) AS mx FROM c),
grid AS (SELECT i AS bin, mn + (i + 0.5) * ((mx - mn) / 80.0) AS x FROM stats, range(80) t(i)),
vc AS (SELECT delay_signed, count(*) AS cnt FROM c GROUP BY 1)"""))
def kde(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 density: Gaussian KDE (Scott bandwidth) at the 80 bin centres.

    Exact, computed over the distinct-value table (a count per minute value),
    so the work is grid x distinct values, not grid x rows.
    """
    c = completed(enriched(spark, sf_dir)).filter(F.col("delay_signed").isNotNull())
    return RK.gaussian_kde(c, "delay_signed", points=80, digits=9).select("bin", rnd("x"), "density")


# --- E02 ECDF ---------------------------------------------------------------------
@register("ecdf", Q.q_enriched(f"""
SELECT delay_signed AS value, cnt AS n,
       round(sum(cnt) OVER (ORDER BY delay_signed ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 1.0
             / sum(cnt) OVER (), {R}) AS ecdf
FROM (SELECT delay_signed, count(*) AS cnt FROM enriched
      WHERE is_cancelled = 0 AND delay_signed IS NOT NULL GROUP BY 1)"""))
def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = completed(enriched(spark, sf_dir))
    e = RK.ecdf(c, "delay_signed")
    return e.select(F.col("delay_signed").alias("value"), F.col("cnt").alias("n"), rnd("ecdf"))


# --- E03 median per top carrier ---------------------------------------------------
@register("median_by_carrier", Q.q_enriched(f"""
SELECT carrier, count(*) AS n, quantile_cont(delay_min, 0.5) AS median_delay
FROM tc GROUP BY carrier""", extra=top_sql()))
def median_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = top_carrier_rows(enriched(spark, sf_dir))
    return d.groupBy("carrier").agg(F.count(F.lit(1)).alias("n"), A.median("delay_min").alias("median_delay"))


# --- E04 late share per top carrier (flagship) ------------------------------------
def late_share_by_carrier_df(df: DataFrame, min_n: int = S.MIN_FLIGHTS) -> DataFrame:
    d = top_carrier_rows(df, S.TOP_N, min_n)
    a = A.rate_by(d, "carrier", "is_late", n_mode="size", out="late_pct")
    return a.select("carrier", rnd("late_pct"), "n")


@register("late_share_by_carrier", Q.q_enriched(f"""
SELECT carrier, round(avg(is_late) * 100, {R}) AS late_pct, count(*) AS n FROM tc GROUP BY carrier""",
                                                extra=top_sql()))
def late_share_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_share_by_carrier_df(enriched(spark, sf_dir))


@register("late_share_by_carrier_floor300", Q.q_enriched(f"""
SELECT carrier, round(avg(is_late) * 100, {R}) AS late_pct, count(*) AS n FROM tc GROUP BY carrier""",
                                                         extra=top_sql(300)))
def late_share_by_carrier_floor300(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same view with a floor of 300 completed flights (HAVING drops groups at sf0.01)."""
    return late_share_by_carrier_df(enriched(spark, sf_dir), 300)


# --- E05 / E08 box statistics -----------------------------------------------------
def _box_sql(source: str, key: str, value: str) -> tuple[str, str]:
    extra = f"""
vc AS (SELECT {key}, {value} AS v, count(*) AS cnt FROM {source} WHERE {value} IS NOT NULL GROUP BY 1, 2),
q2 AS (SELECT {key}, count(*) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
              quantile_cont({value}, 0.75) AS q3 FROM {source} WHERE {value} IS NOT NULL GROUP BY 1),
w AS (SELECT vc.{key},
             min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_lo,
             max(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_hi,
             sum(CASE WHEN v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) THEN 0 ELSE cnt END) AS n_outliers
      FROM vc JOIN q2 USING ({key}) GROUP BY vc.{key})"""
    body = f"""
SELECT q2.{key}, q2.n, round(q1, {R}) AS q1, round(median, {R}) AS median, round(q3, {R}) AS q3,
       round(q3 - q1, {R}) AS iqr, whisker_lo, whisker_hi, n_outliers
FROM q2 JOIN w USING ({key})"""
    return body, extra


def _box_df(d: DataFrame, key: str, value: str) -> DataFrame:
    b = A.box_stats(d, key, value)
    return b.select(key, "n", rnd("q1"), rnd("median"), rnd("q3"), rnd("iqr"), "whisker_lo", "whisker_hi",
                    "n_outliers")


_b5, _e5 = _box_sql("tc", "carrier", "delay_signed")


@register("box_by_carrier", Q.q_enriched(_b5, extra=top_sql() + "," + _e5))
def box_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _box_df(top_carrier_rows(enriched(spark, sf_dir)), "carrier", "delay_signed")


_b8, _e8 = _box_sql("cmp", "planned_hour", "delay_min")


@register("box_by_hour", Q.q_enriched(_b8, extra="cmp AS (SELECT * FROM enriched WHERE is_cancelled = 0)," + _e8))
def box_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box statistics of the clipped delay per planned hour (median = cascade line)."""
    return _box_df(completed(enriched(spark, sf_dir)), "planned_hour", "delay_min")


# --- E06 late share by day part ----------------------------------------------------
_DP_ORDER = "CASE day_part " + " ".join(f"WHEN '{p}' THEN {i + 1}" for i, p in enumerate(S.DAY_PARTS)) + " END"


@register("late_by_day_part", Q.q_enriched(f"""
SELECT day_part, {_DP_ORDER} AS level, round(avg(is_late) * 100, {R}) AS late_pct, count(*) AS n,
       round(avg(is_late) * 100 - 1.959963984540054 * stddev_samp(is_late) / sqrt(count(is_late)) * 100, {R}) AS ci_lo,
       round(avg(is_late) * 100 + 1.959963984540054 * stddev_samp(is_late) / sqrt(count(is_late)) * 100, {R}) AS ci_hi
FROM enriched WHERE is_cancelled = 0 AND day_part IS NOT NULL GROUP BY day_part"""))
def late_by_day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late share per day part with a normal-approximation 95 % CI of the mean."""
    d = completed(enriched(spark, sf_dir)).filter(F.col("day_part").isNotNull())
    z = 1.959963984540054
    se = F.stddev_samp("is_late") / F.sqrt(F.count("is_late"))
    a = d.groupBy("day_part").agg(
        (F.avg("is_late") * 100).alias("late_pct"), F.count(F.lit(1)).alias("n"),
        ((F.avg("is_late") - F.lit(z) * se) * 100).alias("ci_lo"),
        ((F.avg("is_late") + F.lit(z) * se) * 100).alias("ci_hi"))
    return a.select("day_part", C.level_index("day_part", S.DAY_PARTS).alias("level"), rnd("late_pct"), "n",
                    rnd("ci_lo"), rnd("ci_hi"))


# --- E07 delay-band mix by day part -------------------------------------------------
def _band_mix_sql() -> str:
    cols = ",\n       ".join(
        f"round(count(*) FILTER (WHERE delay_band = '{b}') * 100.0 / count(*), {R}) AS pct_{A.safe_name(b)}"
        for b in S.DELAY_BANDS)
    return Q.q_enriched(f"""
SELECT day_part,
       {cols}
FROM enriched WHERE is_cancelled = 0 AND day_part IS NOT NULL AND delay_band IS NOT NULL GROUP BY day_part""")


@register("band_mix_by_day_part", _band_mix_sql())
def band_mix_by_day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = A.crosstab_row_pct(completed(enriched(spark, sf_dir)), "day_part", "delay_band", S.DELAY_BANDS)
    return t.select("day_part", *[rnd(c) for c in t.columns if c != "day_part"])


# --- E09 volume vs median per hour ---------------------------------------------------
@register("volume_vs_median", Q.q_enriched("""
SELECT planned_hour, count(*) AS volume, quantile_cont(delay_min, 0.5) AS median_delay
FROM enriched WHERE is_cancelled = 0 GROUP BY planned_hour"""))
def volume_vs_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = completed(enriched(spark, sf_dir))
    return d.groupBy("planned_hour").agg(F.count(F.lit(1)).alias("volume"), A.median("delay_min").alias("median_delay"))


# --- E10 weekday x hour median, masked ------------------------------------------------
def _heatmap_sql() -> str:
    cols = ",\n       ".join(f"max(CASE WHEN planned_hour = {h} AND n >= 5 THEN m END) AS h{h:02d}" for h in range(24))
    return Q.q_enriched(f"""
SELECT dow,
       {cols}
FROM cell GROUP BY dow""", extra="""
cell AS (SELECT dow, planned_hour, quantile_cont(delay_min, 0.5) AS m, count(*) AS n
         FROM enriched WHERE is_cancelled = 0 AND is_outlier = 0 GROUP BY 1, 2)""")


@register("heatmap_masked", _heatmap_sql())
def heatmap_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = completed_normal(enriched(spark, sf_dir))
    return A.pivot_median_masked(d, "dow", "planned_hour", "delay_min", list(range(24)), min_n=5, prefix="h")


# --- E11 / E12 cancellation rate -----------------------------------------------------
def _cancel_rate(df: DataFrame, key: str, top_n: int) -> DataFrame:
    a = A.rate_by(df, key, "is_cancelled", n_mode="size", out="cancel_pct")
    a = a.filter(F.col("n") >= S.MIN_FLIGHTS).orderBy(F.col("cancel_pct").desc(), F.col(key)).limit(top_n)
    return a.select(key, rnd("cancel_pct"), "n")


def _cancel_sql(key: str, top_n: int) -> str:
    return Q.q_enriched(f"""
SELECT {key}, round(cancel_pct, {R}) AS cancel_pct, n FROM (
  SELECT {key}, avg(is_cancelled) * 100 AS cancel_pct, count(*) AS n FROM enriched GROUP BY {key}
  HAVING count(*) >= {S.MIN_FLIGHTS} ORDER BY cancel_pct DESC, {key} LIMIT {top_n})""")


@register("cancel_rate_route", _cancel_sql("route", 10))
def cancel_rate_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cancel_rate(enriched(spark, sf_dir), "route", 10)


@register("cancel_rate_carrier", _cancel_sql("carrier", S.TOP_N))
def cancel_rate_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cancel_rate(enriched(spark, sf_dir), "carrier", S.TOP_N)


# --- E13 slowest routes --------------------------------------------------------------
@register("slow_routes", Q.q_enriched(f"""
SELECT route, median_delay, n FROM (
  SELECT route, quantile_cont(delay_min, 0.5) AS median_delay, count(*) AS n
  FROM enriched WHERE is_cancelled = 0 AND is_outlier = 0 GROUP BY route
  HAVING count(*) >= {S.MIN_FLIGHTS} ORDER BY median_delay DESC, route LIMIT 15)"""))
def slow_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = completed_normal(enriched(spark, sf_dir))
    a = d.groupBy("route").agg(A.median("delay_min").alias("median_delay"), F.count(F.lit(1)).alias("n"))
    return a.filter(F.col("n") >= S.MIN_FLIGHTS).orderBy(F.col("median_delay").desc(), "route").limit(15)


# --- E14 delay vs distance ------------------------------------------------------------
@register("delay_by_distance", Q.q_enriched("""
SELECT bin, (bin - 1) * 250.0 AS bin_lo, bin * 250.0 AS bin_hi, (bin - 0.5) * 250.0 AS bin_mid,
       quantile_cont(delay_min, 0.5) AS median_delay, count(*) AS n
FROM (SELECT CAST(ceil(distance_km / 250.0) AS INTEGER) AS bin, delay_min FROM enriched
      WHERE is_cancelled = 0 AND is_outlier = 0 AND distance_km IS NOT NULL AND distance_km > 0)
GROUP BY bin"""))
def delay_by_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = completed_normal(enriched(spark, sf_dir)).filter(F.col("distance_km").isNotNull())
    return A.binned_median(d, "distance_km", "delay_min", 250.0)


# --- E15 daily trend + rolling median + synthetic tag ------------------------------------
_SYN_SQL = ", ".join(f"DATE '{d}'" for d in SYNTHETIC_DATES)


@register("daily_trend", Q.q_enriched(f"""
SELECT flight_date, median_delay, cancellations,
       CASE WHEN count(median_delay) OVER w >= 3 THEN quantile_cont(median_delay, 0.5) OVER w END AS rolling_median,
       CAST(flight_date IN ({_SYN_SQL}) AS INTEGER) AS is_synthetic
FROM (SELECT flight_date, quantile_cont(delay_min, 0.5) AS median_delay, sum(is_cancelled) AS cancellations
      FROM enriched GROUP BY flight_date)
WINDOW w AS (ORDER BY flight_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"""))
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per date median (all rows; cancelled ones have null delay) and cancellations.

    The rolling step runs over one row per date (bounded: a few thousand
    dates), so its single ordered window is cheap at any scale.
    """
    d = enriched(spark, sf_dir)
    daily = d.groupBy("flight_date").agg(A.median("delay_min").alias("median_delay"),
                                         F.sum("is_cancelled").alias("cancellations"))
    out = rolling_median(daily, "flight_date", "median_delay", 3, 3)
    return out.withColumn("is_synthetic", C.is_synthetic_date("flight_date", SYNTHETIC_DATES))


# ======================================================================================
# V1-V6: board views over every raw row (no status filter, no rollover)
# ======================================================================================
def board(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(all rows, valid rows) with the board's own delay and ``>= 15`` late flag."""
    raw = TB.departures_raw(spark, sf_dir)
    df = raw.select(
        "row_id", "carrier", "route", "status",
        C.delay_raw("planned_ts", "actual_ts").alias("delay"),
        F.hour("planned_ts").alias("hour"),
        C.weekday_mon0("planned_ts").alias("dow_num"),
        C.cancelled_startswith("status").alias("cancelled"),
    )
    valid = df.filter(~F.col("cancelled")).withColumn("delayed", C.late_flag_inclusive("delay", 15))
    return df, valid


BOARD_SQL = """
brd AS (
  SELECT row_id, carrier, route, status,
         date_diff('second', planned_ts, actual_ts) / 60.0 AS delay,
         hour(planned_ts) AS hour, isodow(planned_ts) - 1 AS dow_num,
         starts_with(status, 'Cancelled') AS cancelled
  FROM departures_raw
),
valid AS (SELECT *, CAST(coalesce(delay >= 15, false) AS INTEGER) AS delayed FROM brd WHERE NOT cancelled)"""


def _hist_case() -> str:
    e, labs = S.HIST_EDGES, S.HIST_LABELS
    parts = " ".join(f"WHEN delay > {lo} AND delay <= {hi} THEN '{lab}'" for lo, hi, lab in zip(e[:-1], e[1:], labs))
    return f"CASE {parts} END"


_LABELS_SQL = " UNION ALL ".join(f"SELECT {i} AS pos, '{lab}' AS band" for i, lab in enumerate(S.HIST_LABELS))


@register("bands_complete", Q.q_raw(f"""
SELECT l.pos, l.band, c.n FROM labels_t l LEFT JOIN cnt c ON c.band = l.band""", extra=f"""{BOARD_SQL},
labels_t AS ({_LABELS_SQL}),
cnt AS (SELECT {_hist_case()} AS band, count(*) AS n FROM valid GROUP BY 1)"""))
def bands_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 (A1 + P15 + J7): counts per histogram band, reindexed to the full band list."""
    _, valid = board(spark, sf_dir)
    counts = A.group_counts(valid.withColumn("band", C.delay_histogram_band("delay")).filter(F.col("band").isNotNull()),
                            ["band"])
    labels = spark.createDataFrame([(i, b) for i, b in enumerate(S.HIST_LABELS)], "pos int, band string")
    return J.complete_groups(F.broadcast(labels), counts, "band").select("pos", "band", "n")


@register("late_by_hour_board", Q.q_raw(f"""
SELECT hour, round(pct, {R}) AS pct, n,
       CASE WHEN pct >= 35 THEN 'large' WHEN pct >= 20 THEN 'small' ELSE 'ok' END AS band
FROM (SELECT hour, avg(delayed) * 100 AS pct, count(delayed) AS n FROM valid GROUP BY hour) WHERE hour >= 5""",
                                          extra=BOARD_SQL))
def late_by_hour_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 (A3 + P24): late share per hour from 05:00, banded 35/20."""
    _, valid = board(spark, sf_dir)
    a = A.rate_by(valid, "hour", "delayed", n_mode="count", out="pct").filter(F.col("hour") >= 5)
    return a.select("hour", rnd("pct"), "n", C.band_by_threshold("pct", 35, 20).alias("band"))


@register("weekday_mean_of_rates", Q.q_raw(f"""
SELECT dow_num, round(pct, {R}) AS pct, n, CASE WHEN dow_num >= 4 THEN 'large' ELSE 'small' END AS band,
       round(avg(pct) OVER (), {R}) AS mean_pct
FROM (SELECT dow_num, avg(delayed) * 100 AS pct, count(delayed) AS n FROM valid GROUP BY dow_num)""", extra=BOARD_SQL))
def weekday_mean_of_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 (A17): late share per weekday and the unweighted mean of the 7 rates."""
    _, valid = board(spark, sf_dir)
    a = A.rate_by(valid, "dow_num", "delayed", n_mode="count", out="pct")
    mean = a.agg(F.avg("pct").alias("mean_pct"))      # one row
    out = J.with_global(a, mean)
    return out.select("dow_num", rnd("pct"), "n",
                      F.when(F.col("dow_num") >= 4, "large").otherwise("small").alias("band"), rnd("mean_pct"))


@register("late_by_carrier_board", Q.q_raw(f"""
SELECT carrier, round(pct, {R}) AS pct, n,
       CASE WHEN pct >= 40 THEN 'large' WHEN pct >= 25 THEN 'small' ELSE 'ok' END AS band
FROM (SELECT carrier, avg(delayed) * 100 AS pct, count(delayed) AS n FROM valid GROUP BY carrier) WHERE n >= 10""",
                                             extra=BOARD_SQL))
def late_by_carrier_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 (A3 + P24): late share per carrier with >= 10 flights, banded 40/25."""
    _, valid = board(spark, sf_dir)
    a = A.rate_by(valid, "carrier", "delayed", n_mode="count", out="pct").filter(F.col("n") >= 10)
    return a.select("carrier", rnd("pct"), "n", C.band_by_threshold("pct", 40, 25).alias("band"))


@register("late_by_route_top", Q.q_raw(f"""
SELECT route, regexp_replace(route, '\\s*\\(.*\\)', '') AS label, round(pct, {R}) AS pct, n,
       CASE WHEN pct >= 55 THEN 'large' ELSE 'small' END AS band
FROM (SELECT route, avg(delayed) * 100 AS pct, count(delayed) AS n FROM valid GROUP BY route
      HAVING count(delayed) >= 10 ORDER BY pct DESC, route LIMIT 20)""", extra=BOARD_SQL))
def late_by_route_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 (T7 + P20): top-20 routes by late share (>= 10 flights), short labels, re-sorted ascending."""
    _, valid = board(spark, sf_dir)
    a = A.rate_by(valid, "route", "delayed", n_mode="count", out="pct").filter(F.col("n") >= 10)
    top = a.orderBy(F.col("pct").desc(), "route").limit(20).orderBy("pct")
    return top.select("route", C.strip_parenthetical("route").alias("label"), rnd("pct"), "n",
                      F.when(F.col("pct") >= 55, "large").otherwise("small").alias("band"))


@register("kpis", Q.q_raw(f"""
SELECT (SELECT count(*) FROM brd) AS n_total,
       (SELECT count(*) FILTER (WHERE cancelled) FROM brd) AS n_cancelled,
       sum(delayed) AS n_delayed,
       round(avg(delayed) * 100, {R}) AS pct_delayed,
       round(avg(delay), {R}) AS mean_delay,
       count(DISTINCT carrier) AS n_carriers,
       count(DISTINCT route) AS n_routes
FROM valid""", extra=BOARD_SQL))
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 (A16): headline numbers in one pass over all rows (conditional aggregates)."""
    df, _ = board(spark, sf_dir)
    valid = ~F.col("cancelled")
    delayed = F.coalesce(F.col("delay") >= 15, F.lit(False)).cast("int")
    a = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("cancelled")).alias("n_cancelled"),
        F.sum(F.when(valid, delayed)).alias("n_delayed"),
        (F.avg(F.when(valid, delayed)) * 100).alias("pct_delayed"),
        F.avg(F.when(valid, F.col("delay"))).alias("mean_delay"),
        F.count_distinct(F.when(valid, F.col("carrier"))).alias("n_carriers"),
        F.count_distinct(F.when(valid, F.col("route"))).alias("n_routes"),
    )
    return a.select("n_total", "n_cancelled", "n_delayed", rnd("pct_delayed"), rnd("mean_delay"),
                    "n_carriers", "n_routes")


@register("class_shares", Q.q_raw(f"""
SELECT cls, n, round(n * 100.0 / sum(n) OVER (), {R}) AS share FROM (
  SELECT 'on_time' AS cls, count(*) FILTER (WHERE NOT cancelled AND NOT coalesce(delay >= 15, false)) AS n FROM brd
  UNION ALL SELECT 'delayed', count(*) FILTER (WHERE NOT cancelled AND coalesce(delay >= 15, false)) FROM brd
  UNION ALL SELECT 'cancelled', count(*) FILTER (WHERE cancelled) FROM brd)""", extra=BOARD_SQL))
def class_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 pie: on-time / delayed / cancelled counts and shares (one aggregate, then unpivot)."""
    df, _ = board(spark, sf_dir)
    late = F.coalesce(F.col("delay") >= 15, F.lit(False))
    a = df.agg(F.count_if(~F.col("cancelled") & ~late).alias("on_time"),
               F.count_if(~F.col("cancelled") & late).alias("delayed"),
               F.count_if(F.col("cancelled")).alias("cancelled"))
    long = a.select(F.expr("stack(3, 'on_time', on_time, 'delayed', delayed, 'cancelled', cancelled) AS (cls, n)"))
    tot = a.select((F.col("on_time") + F.col("delayed") + F.col("cancelled")).alias("_tot"))
    return J.with_global(long, tot).select("cls", "n", F.round(F.col("n") * 100.0 / F.col("_tot"), R).alias("share"))


@register("rolling_median", Q.q_enriched("""
SELECT flight_date, median_delay,
       CASE WHEN count(median_delay) OVER w >= 3 THEN quantile_cont(median_delay, 0.5) OVER w END AS rolling_median
FROM (SELECT flight_date, quantile_cont(delay_min, 0.5) AS median_delay FROM enriched GROUP BY flight_date)
WINDOW w AS (ORDER BY flight_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"""))
def rolling_median_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centred 7-row rolling median (min 3 values) of the daily median delay."""
    daily = enriched(spark, sf_dir).groupBy("flight_date").agg(A.median("delay_min").alias("median_delay"))
    return rolling_median(daily, "flight_date", "median_delay", 3, 3)
