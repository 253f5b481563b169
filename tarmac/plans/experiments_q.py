"""Experiment grid over the departures table and its result analytics.

The grid (5 late thresholds x 3 runs x 3 group-rate models, stratified
5-fold CV; plus an out-of-time scheme) is computed by Spark from the given
tables.  Its per-fold score table feeds the result analytics of the
reference's experiment track: run summaries (A18), run lists (A19),
parameter effects (A20), score pivots (A21), best rows (T4), top runs (T5),
winners (W9), candidate ranks (W5), scheme gaps (J5) and common strategies
(U3).  Run-log documents (S5 / S7 / S10) round-trip the same scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import joins as J
from ..operators import ranks as RK
from ..operators import validation as V
from ..operators.windows import argmax_per_group, competition_rank, hash_key_sql
from ..sources import tables as TB
from . import sql as Q
from .registry import register
from .views import R, rnd

THRESHOLDS = [5, 10, 15, 20, 25]
RUNS = [1, 2, 3]
MODELS = ["carrier", "hour", "dow"]
K = 5


# ---------------------------------------------------------------------------
# Spark plan
# ---------------------------------------------------------------------------
def _labelled_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(threshold, _seed, fold, carrier, hour, dow, y) for every row and configuration.

    One ordering per run seed serves all thresholds: the within-class rank of
    a row for threshold t is a running count of its class in that ordering, so
    the rows are expanded x runs (not x runs x thresholds) before the sort,
    and x thresholds only after, where the aggregation combines map-side.
    """
    d = TB.scan_departures(spark, sf_dir).select(
        "row_id", "carrier", F.hour("planned_ts").alias("hour"), C.weekday_mon0("planned_ts").alias("dow"),
        C.delay_raw("planned_ts", "actual_ts").alias("_d"))
    x = d.select("*", F.explode(F.array(*[F.lit(r) for r in RUNS])).alias("_seed"))
    x = x.withColumn("_h", F.pmod(F.pmod(F.col("row_id"), F.lit(2147483648)) * F.lit(1103515245)
                                  + F.col("_seed") * 97 + 13, F.lit(2147483648)))
    ys = []
    for t in THRESHOLDS:
        y = C.late_flag_strict(F.col("_d"), t)
        x = x.withColumn(f"y{t}", y).withColumn(f"n{t}", 1 - y)
        ys += [f"y{t}", f"n{t}"]
    p = RK.prefix_sums(x, ["_h", "row_id"], ys, keys=["_seed"], hashed=(0, 1 << 31))
    per_t = F.explode(F.array(*[
        F.struct(F.lit(t).alias("threshold"), F.col(f"y{t}").alias("y"),
                 F.pmod(F.when(F.col(f"y{t}") == 1, F.col(f"before_y{t}")).otherwise(F.col(f"before_n{t}")),
                        F.lit(K)).cast("int").alias("fold"))
        for t in THRESHOLDS])).alias("_t")
    return p.select("carrier", "hour", "dow", "_seed", per_t).select(
        "_t.threshold", "_seed", "_t.fold", "carrier", "hour", "dow", "_t.y")


def _cells(f: DataFrame) -> DataFrame:
    """(threshold, run, model, fold, g, pos, n): the only aggregate over the rows."""
    c = f.groupBy("threshold", "_seed", "fold", "carrier", "hour", "dow").agg(
        F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
    long = c.select("threshold", F.col("_seed").alias("run"), "fold", "pos", "n",
                    F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("string").alias("g"))
                                        for m in MODELS])).alias("_m"))
    long = long.select("threshold", "run", "fold", "_m.model", "_m.g", "pos", "n")
    return long.groupBy("threshold", "run", "model", "fold", "g").agg(F.sum("pos").alias("pos"),
                                                                      F.sum("n").alias("n"))


def _inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("events", "nation")]


def fold_scores_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid's per-fold scores, computed once per session and data version and
    written to the shared folder (like the reference's run logs, analysed many times)."""
    from ..session import materialised

    def build():
        f = _labelled_folds(spark, sf_dir)
        s = V.group_rate_cv(_cells(f), ["threshold", "run", "model"])
        return s.select("threshold", "model", "run", "fold", "tp", "fp", "fn", "tn", rnd("f1"),
                        rnd("balanced_accuracy"))
    return materialised(spark, "fold_scores", _inputs(sf_dir), build)


def oot_scores_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M18 scheme: fit the group rates on the earliest 80 %, score the last 20 % (W6 split)."""
    from ..session import materialised
    return materialised(spark, "oot_scores", _inputs(sf_dir), lambda: _oot_scores(spark, sf_dir))


def _oot_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = TB.scan_departures(spark, sf_dir).select(
        "row_id", "planned_ts", "carrier", F.hour("planned_ts").alias("hour"),
        C.weekday_mon0("planned_ts").alias("dow"), C.delay_raw("planned_ts", "actual_ts").alias("_d"))
    rn = RK.global_row_number(d, ["planned_ts", "row_id"])
    k = F.greatest(F.lit(1), F.bround(F.col("total") * 0.2, 0).cast("long"))
    d = rn.withColumn("fold", (F.col("rn") > F.col("total") - k).cast("int"))
    cfg = F.explode(F.array(*[F.lit(t) for t in THRESHOLDS])).alias("threshold")
    x = d.select("*", cfg).withColumn("y", C.late_flag_strict(F.col("_d"), F.col("threshold")))
    c = x.groupBy("threshold", "fold", "carrier", "hour", "dow").agg(F.sum("y").alias("pos"),
                                                                      F.count(F.lit(1)).alias("n"))
    long = c.select("threshold", "fold", "pos", "n",
                    F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).cast("string").alias("g"))
                                        for m in MODELS])).alias("_m"))
    long = long.select("threshold", "fold", "pos", "n", "_m.model", "_m.g")
    cells = long.groupBy("threshold", "model", "fold", "g").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    s = V.group_rate_cv(cells, ["threshold", "model"])
    # only the held-out future (fold 1) is a test set in this scheme
    return s.filter(F.col("fold") == 1).select("threshold", "model", "tp", "fp", "fn", "tn", rnd("f1"),
                                               rnd("balanced_accuracy"))


def run_summary_df(scores: DataFrame) -> DataFrame:
    """Mean / population std of both metrics, mean of means, run count."""
    runs = scores.groupBy("threshold", "model", "run").agg(F.avg("f1").alias("f1"),
                                                            F.avg("balanced_accuracy").alias("ba"))
    a = runs.groupBy("threshold", "model").agg(
        F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"),
        F.avg("ba").alias("mean_balanced_accuracy"), F.stddev_pop("ba").alias("std_balanced_accuracy"),
        F.count(F.lit(1)).alias("runs"))
    a = a.withColumn("mean_of_means", (F.col("mean_f1") + F.col("mean_balanced_accuracy")) / 2)
    return a.select("threshold", "model", rnd("mean_f1"), rnd("std_f1"), rnd("mean_balanced_accuracy"),
                    rnd("std_balanced_accuracy"), rnd("mean_of_means"), "runs")


# ---------------------------------------------------------------------------
# oracle SQL
# ---------------------------------------------------------------------------
_CFG = " UNION ALL ".join(f"SELECT {t} AS threshold, {r} AS run" for t in THRESHOLDS for r in RUNS)
_MOD_UNION = " UNION ALL ".join(
    f"SELECT threshold, run, '{m}' AS model, fold, CAST({m} AS VARCHAR) AS g, y FROM f" for m in MODELS)

_CV_CTES = f"""
lab AS (SELECT row_id, carrier, hour(planned_ts) AS hour, isodow(planned_ts) - 1 AS dow,
               date_diff('second', planned_ts, actual_ts) / 60.0 AS d FROM departures),
cfg AS ({_CFG}),
x AS (SELECT cfg.threshold, cfg.run, lab.*, CAST(coalesce(d > cfg.threshold, false) AS INTEGER) AS y,
             ((((row_id % 2147483648) * 1103515245) + cfg.run * 97 + 13) % 2147483648) AS h
      FROM lab, cfg),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY threshold, run, y ORDER BY h, row_id) - 1) % {K} AS INTEGER) AS fold FROM x),
cells AS (SELECT threshold, run, model, fold, g, sum(y) AS pos, count(*) AS n FROM ({_MOD_UNION}) GROUP BY ALL),
gt AS (SELECT threshold, run, model, g, sum(pos) AS gpos, sum(n) AS gn FROM cells GROUP BY ALL),
ft AS (SELECT threshold, run, model, fold, sum(pos) AS fpos, sum(n) AS fnn FROM cells GROUP BY ALL),
tot_a AS (SELECT threshold, run, model, sum(pos) AS apos, sum(n) AS an FROM cells GROUP BY ALL),
pr AS (SELECT c.*, coalesce(CAST(gpos - pos AS DOUBLE) / nullif(gn - n, 0) > CAST(apos - fpos AS DOUBLE) / nullif(an - fnn, 0), false) AS pred
       FROM cells c JOIN gt USING (threshold, run, model, g) JOIN ft USING (threshold, run, model, fold)
       JOIN tot_a USING (threshold, run, model)),
conf AS (SELECT threshold, model, run, fold,
                sum(CASE WHEN pred THEN pos ELSE 0 END) AS tp, sum(CASE WHEN pred THEN n - pos ELSE 0 END) AS fp,
                sum(CASE WHEN pred THEN 0 ELSE pos END) AS fn, sum(CASE WHEN pred THEN 0 ELSE n - pos END) AS tn
         FROM pr GROUP BY ALL),
scores AS (SELECT threshold, model, run, fold, tp, fp, fn, tn,
                  round(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0), {R}) AS f1,
                  round((coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) + coalesce(tn * 1.0 / nullif(tn + fp, 0), 0)) / 2, {R}) AS balanced_accuracy
           FROM conf),
runs AS (SELECT threshold, model, run, avg(f1) AS f1, avg(balanced_accuracy) AS ba FROM scores GROUP BY ALL),
summary AS (SELECT threshold, model, round(avg(f1), {R}) AS mean_f1, round(stddev_pop(f1), {R}) AS std_f1,
                   round(avg(ba), {R}) AS mean_balanced_accuracy, round(stddev_pop(ba), {R}) AS std_balanced_accuracy,
                   round((avg(f1) + avg(ba)) / 2, {R}) AS mean_of_means, count(*) AS runs
            FROM runs GROUP BY ALL)"""


def _q(body: str, extra: str = "") -> str:
    return Q.q_raw(body, extra=_CV_CTES + ("," + extra if extra else ""))


@register("fold_scores", _q("SELECT * FROM scores"))
def fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 + M17: per-fold confusion counts, F1 and balanced accuracy of the grid."""
    return fold_scores_df(spark, sf_dir)


@register("run_summary", _q("SELECT * FROM summary"))
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary_df(fold_scores_df(spark, sf_dir))


@register("run_collect", _q("""
SELECT threshold, model, string_agg(CAST(run AS VARCHAR), ',' ORDER BY run) AS runs, count(*) AS n_runs
FROM (SELECT DISTINCT threshold, model, run FROM scores) GROUP BY ALL"""))
def run_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted list of run ids per configuration."""
    s = fold_scores_df(spark, sf_dir).select("threshold", "model", "run").distinct()
    a = s.groupBy("threshold", "model").agg(F.sort_array(F.collect_list("run")).alias("_r"),
                                            F.count(F.lit(1)).alias("n_runs"))
    return a.select("threshold", "model", F.array_join(F.col("_r").cast("array<string>"), ",").alias("runs"), "n_runs")


@register("pivot_scores", _q(f"""
SELECT threshold, {", ".join(f"max(CASE WHEN model = '{m}' THEN mean_f1 END) AS f1_{m}" for m in MODELS)},
       {", ".join(f"max(CASE WHEN model = '{m}' THEN std_f1 END) AS std_{m}" for m in MODELS)}
FROM summary GROUP BY threshold"""))
def pivot_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold x model pivot of mean and std F1 (explicit model list: no extra job)."""
    s = run_summary_df(fold_scores_df(spark, sf_dir))
    p = s.groupBy("threshold").pivot("model", MODELS).agg(F.first("mean_f1").alias("f1"), F.first("std_f1").alias("std"))
    return p.select("threshold", *[F.col(f"{m}_f1").alias(f"f1_{m}") for m in MODELS],
                    *[F.col(f"{m}_std").alias(f"std_{m}") for m in MODELS])


@register("best_rows", _q("""
SELECT * FROM (SELECT 'by_f1' AS ordering, * FROM summary ORDER BY mean_f1 DESC, mean_balanced_accuracy DESC, threshold, model LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'by_balanced_accuracy', * FROM summary ORDER BY mean_balanced_accuracy DESC, mean_f1 DESC, threshold, model LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'by_mean_of_means', * FROM summary ORDER BY mean_of_means DESC, mean_f1 DESC, threshold, model LIMIT 1)"""))
def best_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: the best configuration under three two-key orderings."""
    s = run_summary_df(fold_scores_df(spark, sf_dir))
    orders = [("by_f1", ["mean_f1", "mean_balanced_accuracy"]),
              ("by_balanced_accuracy", ["mean_balanced_accuracy", "mean_f1"]),
              ("by_mean_of_means", ["mean_of_means", "mean_f1"])]
    parts = [s.orderBy(*[F.col(c).desc() for c in cols], "threshold", "model").limit(1)
             .select(F.lit(name).alias("ordering"), *s.columns) for name, cols in orders]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("top_runs", _q("""
SELECT * FROM (SELECT threshold, model, run, round(avg(f1), 6) AS mean_f1 FROM scores WHERE threshold = 15
               GROUP BY ALL ORDER BY mean_f1 DESC, model, run LIMIT 3)"""))
def top_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the top-3 runs for one threshold."""
    s = fold_scores_df(spark, sf_dir).filter(F.col("threshold") == 15)
    a = s.groupBy("threshold", "model", "run").agg(F.round(F.avg("f1"), R).alias("mean_f1"))
    return a.orderBy(F.col("mean_f1").desc(), "model", "run").limit(3)


@register("winners", _q("""
SELECT threshold, arg_max(model, (mean_f1, model)) AS model, max(mean_f1) AS mean_f1 FROM summary GROUP BY threshold"""))
def winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winning model per threshold (max_by, ties to the larger name)."""
    s = run_summary_df(fold_scores_df(spark, sf_dir))
    return argmax_per_group(s.select("threshold", "model", "mean_f1"), ["threshold"], "mean_f1", "model")


@register("candidate_ranks", _q("""
SELECT threshold, model, mean_f1, rank() OVER (ORDER BY mean_f1 DESC) AS rank_test_f1 FROM summary"""))
def candidate_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competition rank of the candidates (a 15-row table) by mean F1."""
    s = run_summary_df(fold_scores_df(spark, sf_dir)).select("threshold", "model", "mean_f1")
    return competition_rank(s, "mean_f1", "rank_test_f1")


_OOT_CTES = f"""
o_lab AS (SELECT row_id, carrier, hour(planned_ts) AS hour, isodow(planned_ts) - 1 AS dow,
                 date_diff('second', planned_ts, actual_ts) / 60.0 AS d,
                 row_number() OVER (ORDER BY planned_ts, row_id) AS rn, count(*) OVER () AS tot FROM departures),
o_x AS (SELECT t.threshold, o_lab.*, CAST(coalesce(d > t.threshold, false) AS INTEGER) AS y,
               CAST(rn > tot - greatest(1, CAST(round_even(0.2 * tot, 0) AS BIGINT)) AS INTEGER) AS fold
        FROM o_lab, (SELECT DISTINCT threshold FROM cfg) t),
o_cells AS (SELECT threshold, model, fold, g, sum(y) AS pos, count(*) AS n FROM (
   {" UNION ALL ".join(f"SELECT threshold, '{m}' AS model, fold, CAST({m} AS VARCHAR) AS g, y FROM o_x" for m in MODELS)})
   GROUP BY ALL),
o_gt AS (SELECT threshold, model, g, sum(pos) AS gpos, sum(n) AS gn FROM o_cells GROUP BY ALL),
o_ft AS (SELECT threshold, model, fold, sum(pos) AS fpos, sum(n) AS fnn FROM o_cells GROUP BY ALL),
o_at AS (SELECT threshold, model, sum(pos) AS apos, sum(n) AS an FROM o_cells GROUP BY ALL),
o_pr AS (SELECT c.*, coalesce(CAST(gpos - pos AS DOUBLE) / nullif(gn - n, 0) > CAST(apos - fpos AS DOUBLE) / nullif(an - fnn, 0), false) AS pred
         FROM o_cells c JOIN o_gt USING (threshold, model, g) JOIN o_ft USING (threshold, model, fold)
         JOIN o_at USING (threshold, model)),
oot AS (SELECT threshold, model, tp, fp, fn, tn,
               round(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0), {R}) AS f1,
               round((coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) + coalesce(tn * 1.0 / nullif(tn + fp, 0), 0)) / 2, {R}) AS balanced_accuracy
        FROM (SELECT threshold, model,
                     sum(CASE WHEN pred THEN pos ELSE 0 END) AS tp, sum(CASE WHEN pred THEN n - pos ELSE 0 END) AS fp,
                     sum(CASE WHEN pred THEN 0 ELSE pos END) AS fn, sum(CASE WHEN pred THEN 0 ELSE n - pos END) AS tn
              FROM o_pr WHERE fold = 1 GROUP BY ALL))"""


@register("out_of_time_scores", _q("SELECT * FROM oot", extra=_OOT_CTES))
def out_of_time_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M18 with the group-rate models: train on the past 80 %, score the future 20 %."""
    return oot_scores_df(spark, sf_dir)


@register("scheme_gap", _q(f"""
SELECT s.threshold, s.model, s.mean_f1 AS f1_kfold, o.f1 AS f1_oot, round(s.mean_f1 - o.f1, {R}) AS gap
FROM summary s JOIN oot o USING (threshold, model)""", extra=_OOT_CTES))
def scheme_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-fold vs out-of-time F1 per configuration, gap = k-fold - OOT."""
    s = run_summary_df(fold_scores_df(spark, sf_dir)).select("threshold", "model", F.col("mean_f1").alias("f1"))
    o = oot_scores_df(spark, sf_dir).select("threshold", "model", "f1")
    g = J.scheme_gap(s, o, ["threshold", "model"], "f1", "kfold", "oot")
    return g.select("threshold", "model", "f1_kfold", "f1_oot", rnd("gap"))


@register("common_strategies", _q("""
SELECT threshold, model FROM (SELECT threshold, model FROM summary WHERE mean_f1 > 0
                              INTERSECT SELECT threshold, model FROM oot WHERE f1 > 0)""", extra=_OOT_CTES))
def common_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations with a non-zero F1 under both schemes."""
    s = run_summary_df(fold_scores_df(spark, sf_dir)).filter(F.col("mean_f1") > 0)
    o = oot_scores_df(spark, sf_dir).filter(F.col("f1") > 0)
    from ..operators.upsert import intersect_keys
    return intersect_keys(s, o, ["threshold", "model"])


@register("param_effect", _q(f"""
SELECT param, value, round(avg(f1), {R}) AS mean_f1, round(stddev_samp(f1), {R}) AS std_f1, count(*) AS n
FROM (SELECT 'threshold' AS param, CAST(threshold AS VARCHAR) AS value, f1 FROM scores
      UNION ALL SELECT 'model', model, f1 FROM scores
      UNION ALL SELECT 'run', CAST(run AS VARCHAR), f1 FROM scores)
GROUP BY ALL"""))
def param_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score mean / sample std / count per value of each parameter (map explode)."""
    s = fold_scores_df(spark, sf_dir)
    m = s.select("f1", F.create_map(F.lit("threshold"), F.col("threshold").cast("string"),
                                    F.lit("model"), F.col("model"),
                                    F.lit("run"), F.col("run").cast("string")).alias("params"))
    e = m.select("f1", F.explode("params").alias("param", "value"))
    a = e.groupBy("param", "value").agg(F.avg("f1").alias("mean_f1"), F.stddev_samp("f1").alias("std_f1"),
                                        F.count(F.lit(1)).alias("n"))
    return a.select("param", "value", rnd("mean_f1"), rnd("std_f1"), "n")
