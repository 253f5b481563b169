"""Learning queries: scalers, class weights, k-NN, sampling, resampling, estimators, validation.

Inputs (FIXTURES §2.5): the delay classifier (departures + locations through
M1) and an imbalanced binary table (labels joined to documents, label =
1 - quality).  Scalers, class weights and the exact k-NN join have oracles;
model runs are checked by invariants (rows only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import joins as J
from ..operators import resample as RS
from ..operators import scaling as SC
from ..operators import validation as V
from ..operators.knn import knn
from ..operators.windows import hash_key_sql
from ..sources import tables as TB
from . import grid as GR
from . import ml as ML
from . import sql as Q
from .enrich import BASE_FEATURES, load_xy
from .registry import register
from .views import R, rnd

LANG_VOCAB = ["de", "en", "es", "fr"]
SOURCE_VOCAB = [f"src{i}" for i in range(20)]
DOC_FEATURES = ["n_chars", "n_words", *[f"lang_{v}" for v in LANG_VOCAB], "source_code"]


def departures_xy(spark: SparkSession, sf_dir: str, threshold: float = 15, encoding: str = "onehot") -> DataFrame:
    x = load_xy(TB.scan_departures(spark, sf_dir), TB.locations(spark, sf_dir), threshold, encoding)
    return x.withColumnRenamed("is_late", ML.LABEL)


def documents_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imbalanced binary fixture: whole-text word counts, language one-hot, source ordinal."""
    lab = TB.table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = TB.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    j = lab.join(docs, "doc_id")
    return j.select(
        F.col("doc_id").alias("row_id"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim("text"), r"\s+")).cast("double").alias("n_words"),
        *C.one_hot("lang", LANG_VOCAB, "lang"),
        C.ordinal("source", SOURCE_VOCAB).alias("source_code"),
        (1 - F.col("quality")).cast("int").alias(ML.LABEL),
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents_xy``, written once for models that read it many times."""
    from ..session import materialised
    return materialised(spark, "documents_xy", [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("documents", "labels")],
                        lambda: documents_xy(spark, sf_dir))


_FEAT_SQL = f"""
feat AS (SELECT d.row_id, l.lat, l.lon, l.elev, {Q.haversine_sql('l.lat', 'l.lon')} AS distance_km,
                day(d.planned_ts) AS day_of_month,
                CAST(coalesce(date_diff('second', d.planned_ts, d.actual_ts) / 60.0 > 15, false) AS INTEGER) AS label
         FROM departures d JOIN locations l ON l.code = upper(trim(replace(split_part(d.route, '(', -1), ')', ''))))"""


def _scaled(spark, sf_dir, cols, **groups) -> DataFrame:
    x = departures_xy(spark, sf_dir).select("row_id", *cols)
    p = SC.fit(x, **{**dict(standard=[], robust=[], log=[], minmax=[]), **groups})
    t = SC.transform(x, p, **{**dict(standard=[], robust=[], log=[], minmax=[]), **groups})
    return t.select("row_id", *[rnd(c) for c in cols])


@register("scale_standard", Q.q_raw(f"""
SELECT row_id, round((lat - avg(lat) OVER ()) / stddev_pop(lat) OVER (), {R}) AS lat FROM feat""", extra=_FEAT_SQL))
def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: z-score with the population std."""
    return _scaled(spark, sf_dir, ["lat"], standard=["lat"])


@register("scale_robust", Q.q_raw(f"""
SELECT row_id,
       round((lon - quantile_cont(lon, 0.5) OVER ()) / (quantile_cont(lon, 0.75) OVER () - quantile_cont(lon, 0.25) OVER ()), {R}) AS lon,
       round((elev - quantile_cont(elev, 0.5) OVER ()) / (quantile_cont(elev, 0.75) OVER () - quantile_cont(elev, 0.25) OVER ()), {R}) AS elev
FROM feat""", extra=_FEAT_SQL))
def scale_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: (x - median) / IQR, exact quantiles."""
    return _scaled(spark, sf_dir, ["lon", "elev"], robust=["lon", "elev"])


@register("scale_log", Q.q_raw(f"""
SELECT row_id, round((ln(1 + distance_km) - avg(ln(1 + distance_km)) OVER ()) / stddev_pop(ln(1 + distance_km)) OVER (), {R}) AS distance_km
FROM feat""", extra=_FEAT_SQL))
def scale_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: log1p then z-score."""
    return _scaled(spark, sf_dir, ["distance_km"], log=["distance_km"])


@register("scale_minmax", Q.q_raw(f"""
SELECT row_id, round((day_of_month - min(day_of_month) OVER ()) * 1.0
                     / (max(day_of_month) OVER () - min(day_of_month) OVER ()), {R}) AS day_of_month
FROM feat""", extra=_FEAT_SQL))
def scale_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: min-max to [0, 1] (a constant column maps to 0)."""
    return _scaled(spark, sf_dir, ["day_of_month"], minmax=["day_of_month"])


@register("class_weights", Q.q_raw(f"""
SELECT label, n_c, round(sum(n_c) OVER () * 1.0 / (count(*) OVER () * n_c), {R}) AS weight
FROM (SELECT label, count(*) AS n_c FROM feat GROUP BY label)""", extra=_FEAT_SQL))
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 'balanced' weights N / (k n_c) of the delay label."""
    w = V.class_weights(departures_xy(spark, sf_dir), ML.LABEL)
    return w.select(ML.LABEL, "n_c", rnd("weight"))


@register("knn_exact", """
SELECT vec_id, CAST(j AS INTEGER) AS j, round(d, 6) AS distance FROM (
  SELECT a.vec_id, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), b.vec_id) AS j
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
WHERE j <= 5""")
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest same-label neighbours of every embedding (exact, pivot-pruned)."""
    e = TB.table(spark, sf_dir, "embeddings")
    nn = knn(e, "vec_id", "embedding", 5, group="label")
    return nn.select("vec_id", "j", F.round("distance", 6).alias("distance"))


# ---------------------------------------------------------------------------
# sampling / resampling (rows only: invariants are in the tests)
# ---------------------------------------------------------------------------
_LABELLED_SQL = f"""
WITH x AS (SELECT doc_id AS row_id, CAST(n_chars AS DOUBLE) AS n_chars, CAST(1 - quality AS INTEGER) AS label,
                  {hash_key_sql('doc_id', 42)} AS h FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, row_id) AS nth, count(*) OVER (PARTITION BY label) AS n_c,
             count(*) OVER () AS n FROM x)"""


@register("sample_n", Q.q_raw(f"""
SELECT row_id, carrier, route FROM departures ORDER BY {hash_key_sql('row_id', 42)}, row_id LIMIT 1000"""))
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: 1000 departures without replacement (seed 42) — a sampling operator."""
    return RS.sample_n(TB.scan_departures(spark, sf_dir).select("row_id", "carrier", "route"), 1000, 42)


@register("stratified_sample", f"""{_LABELLED_SQL},
s AS (SELECT *, row_number() OVER (ORDER BY h, row_id) AS pos FROM r
      WHERE n <= 100 OR nth <= least(n_c, greatest(1, CAST(round_even(n_c * 100.0 / n, 0) AS BIGINT))))
SELECT row_id, label, n_chars FROM s WHERE pos <= 100""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: class-proportional sample of 100 labelled documents."""
    return RS.stratified_sample(documents_xy(spark, sf_dir).select("row_id", ML.LABEL, "n_chars"), ML.LABEL, 100, 42)


@register("undersample", f"""{_LABELLED_SQL}
SELECT row_id, label, n_chars FROM r WHERE nth <= (SELECT min(n_c) FROM r)""")
def undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: every class of the labelled documents cut to the smallest one's size."""
    return RS.undersample(documents_xy(spark, sf_dir).select("row_id", ML.LABEL, "n_chars"), ML.LABEL, 42)


@register("smote")
def smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RS.smote(documents_xy(spark, sf_dir), ML.LABEL, DOC_FEATURES, 5, 42)


@register("smote_enn")
def smote_enn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RS.smote_enn(documents_xy(spark, sf_dir), ML.LABEL, DOC_FEATURES, 42)


@register("smote_tomek")
def smote_tomek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RS.smote_tomek(documents_xy(spark, sf_dir), ML.LABEL, DOC_FEATURES, 42)


# ---------------------------------------------------------------------------
# estimators and validation schemes
# ---------------------------------------------------------------------------
FOLD_SCHEMA = "fold int, tp long, fp long, fn long, tn long, f1 double, balanced_accuracy double"


def _cv_frame(spark: SparkSession, rows: list[dict], extra: dict | None = None) -> DataFrame:
    extra = extra or {}
    data = [{**extra, **r} for r in rows]
    cols = list(extra) + ["fold", "tp", "fp", "fn", "tn", "f1", "balanced_accuracy"]
    return spark.createDataFrame([tuple(d[c] for c in cols) for d in data],
                                 ", ".join([f"{c} string" for c in extra] + [FOLD_SCHEMA]))


def _cv_query(model: str, resampling=None, weight=None):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        xy = documents_xy(spark, sf_dir)
        rows = ML.cross_validate(xy, DOC_FEATURES, model, resampling, weight, 5, 42)
        return _cv_frame(spark, rows, {"model": model})
    q.__doc__ = f"M17 with the {model} estimator: stratified 5-fold CV, scaler fitted per training fold."
    return q


register("forest_cv")(_cv_query("forest", None, "balanced"))
register("boosted_cv")(_cv_query("boosted", None, "positive"))
register("adaboost_cv")(_cv_query("adaboost"))
register("nb_cv")(_cv_query("nb"))
register("mlp_cv")(_cv_query("mlp"))


@register("out_of_time")
def out_of_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest trained on the earliest 80 % of departures, scored on the last 20 %."""
    from .windows_q import chronological_split
    xy = departures_xy(spark, sf_dir, 15, "label")
    feats = [c for c in xy.columns if c not in ("row_id", ML.LABEL)]
    r = ML.out_of_time(xy, chronological_split(spark, sf_dir), feats, "forest", None, "balanced")
    return _cv_frame(spark, [{"fold": 0, **r}], {"scheme": "time_oot"})


def _search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search's table, computed once per session and data version and kept in the shared folder."""
    from ..session import materialised

    def build() -> DataFrame:
        rows = ML.run_search(_documents(spark, sf_dir), DOC_FEATURES, k=5, seed=42)
        return spark.createDataFrame(
            [(r["candidate"], r["params"], r["mean_test_f1"], r["std_test_f1"], r["mean_test_balanced_accuracy"]) for r in rows],
            "candidate int, params map<string,string>, mean_test_f1 double, std_test_f1 double, "
            "mean_test_balanced_accuracy double")

    return materialised(spark, "search", [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("documents", "labels")], build)


@register("search")
def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random search over the forest space, the reference's 40 candidates, 5-fold, ranked by F1."""
    from ..operators.windows import competition_rank
    df = _search_rows(spark, sf_dir).withColumn("label", C.label_from_params("params", list(ML.SEARCH_SPACE)))   # P31
    return competition_rank(df, "mean_test_f1", "rank_test_f1")


def _sweep_log(spark: SparkSession, sf_dir: str) -> GR.RunLog:
    """The sweep's run log, one document per (strategy, scheme); strategies without documents are run."""
    import hashlib

    from ..session import _source_stamp
    xy = _documents(spark, sf_dir)
    base = ML.best_params([r.asDict() for r in _search_rows(spark, sf_dir).collect()])
    stamp = _source_stamp(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("documents", "labels")])
    facts = hashlib.sha256(repr((stamp, sorted(base.items()), ML.SEARCH_SPACE)).encode()).hexdigest()[:16]
    log = GR.RunLog(spark, f"sweep-{facts}")
    schemes = ("stratified_kfold", "later_ids")

    def config(name: str, scheme: str) -> dict:
        return {"experiment": "imbalance", "encoding": "onehot", "resampling": name, "strategy": name, "scheme": scheme, "run": 1}

    done = log.finished()
    todo = [s for s in ML.STRATEGIES if any(GR.run_key(config(s[0], x)) not in done for x in schemes)]
    if todo:
        cut = xy.agg(F.percentile_approx("row_id", 0.8, 10000).alias("cut")).first()["cut"]
        split = xy.select("row_id", (F.col("row_id") > F.lit(cut)).cast("int").alias("is_test"))
        rows = ML.run_sweep(xy, split, DOC_FEATURES, base, strategies=todo)
        for name, _, _ in todo:
            for scheme, own in zip(schemes, ("stratified_kfold", "split")):
                log.record(config(name, scheme), {"forest": [r for r in rows if (r["strategy"], r["scheme"]) == (name, own)]})
    return log


@register("sweep")
def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven imbalance strategies x (5-fold, later ids) with the search winner's forest settings, from the run log.

    The documents have no time: scheme ``later_ids`` trains up to the 80 % point of the document ids and tests on the
    later ones.  ``rank_f1`` ranks a scheme's strategies by their mean F1; strategies with one fit share a rank.
    """
    docs = _sweep_log(spark, sf_dir).documents()
    folds = docs.select(F.col("validation_scheme").alias("scheme"), "strategy", F.explode("models").alias("model", "m")).select(
        "scheme", "strategy", F.explode("m.folds").alias("f")).select("scheme", "strategy", "f.fold", "f.f1", "f.balanced_accuracy")
    return folds.join(GR.strategy_ranking(docs), ["scheme", "strategy"])


@register("sweep_summary")
def sweep_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18, A19 and T6 over the sweep's documents, with strategy and scheme columns (files by name only)."""
    s = GR.summary(_sweep_log(spark, sf_dir).documents())
    return s.withColumn("files", F.size("files"))


@register("sweep_gap")
def sweep_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: k-fold against later-ids F1 of every strategy."""
    return GR.gap(_sweep_log(spark, sf_dir).documents(), "stratified_kfold", "later_ids")


@register("search_effects")
def search_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 / A20 over the search's candidates: score per value of every forest setting."""
    return GR.parameter_effects(_search_rows(spark, sf_dir))


@register("final_refit")
def final_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of the five estimators by k-fold F1, resampled with SMOTE-ENN, fitted on all rows and saved.

    The winner's scores on the held-out folds come with the rows it was fitted
    on and the shared folder that holds its model and scaler table.
    """
    xy = _documents(spark, sf_dir)
    folds = ML.Folds(ML._union(ML.prepare_folds(xy, DOC_FEATURES, "smoteenn", 5, 42)), DOC_FEATURES)
    scores = {m: ML.evaluate(folds, m, None, 42) for m in ML.ESTIMATORS}
    folds.release()
    best = max(ML.ESTIMATORS, key=lambda m: sum(r["f1"] for r in scores[m]))
    facts = ML.refit(xy, DOC_FEATURES, best, "smoteenn", None, 42)
    return _cv_frame(spark, scores[best], {"model": best}).withColumns({k: F.lit(v) for k, v in facts.items()})


@register("pca_2d")
def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2 principal components of the z-scored 64-d embeddings, class kept."""
    e = TB.table(spark, sf_dir, "embeddings")
    cols = [f"e{i}" for i in range(64)]
    wide = e.select(F.col("vec_id").alias("row_id"), F.col("label").alias(ML.LABEL),
                    *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    out, ratio = ML.pca_2d(wide, cols, ML.LABEL, 2)
    return out.withColumn("explained_variance", F.array(*[F.lit(float(x)) for x in ratio]))


def _extents_sql() -> str:
    cols = ["lat", "lon", "distance_km"]
    agg = ", ".join(f"round(min({c}), {R}) AS min_{c}, round(max({c}), {R}) AS max_{c}" for c in cols)
    return Q.q_raw(f"""
SELECT 'all' AS scope, count(*) AS n, {agg} FROM feat
UNION ALL
SELECT 'label=' || CAST(label AS VARCHAR), count(*), {agg} FROM feat GROUP BY label""", extra=_FEAT_SQL)


@register("class_extents", _extents_sql())
def class_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and min / max of chosen features, overall and per class (one grouping each)."""
    x = departures_xy(spark, sf_dir)
    cols = ["lat", "lon", "distance_km"]
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.round(F.min(c), R).alias(f"min_{c}"), F.round(F.max(c), R).alias(f"max_{c}")]
    overall = x.agg(*aggs).select(F.lit("all").alias("scope"), "*")
    per = x.groupBy(ML.LABEL).agg(*aggs).select(F.concat(F.lit("label="), F.col(ML.LABEL).cast("string")).alias("scope"),
                                                *[a for a in ["n"] + [f"{m}_{c}" for c in cols for m in ("min", "max")]])
    return overall.unionByName(per)


@register("confusion_scores", Q.q_raw(f"""
SELECT tp, fp, fn, tn, round(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0), {R}) AS f1,
       round((coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) + coalesce(tn * 1.0 / nullif(tn + fp, 0), 0)) / 2, {R}) AS balanced_accuracy
FROM (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn
      FROM (SELECT CAST(coalesce(date_diff('second', planned_ts, actual_ts) / 60.0 > 15, false) AS INTEGER) AS y,
                   CAST(hour(planned_ts) >= 17 AS INTEGER) AS p FROM departures))"""))
def confusion_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 on a fixed prediction (evening departures predicted late): counts, F1, balanced accuracy."""
    d = TB.scan_departures(spark, sf_dir).select(
        C.late_flag_strict(C.delay_raw("planned_ts", "actual_ts"), 15).alias("label"),
        (F.hour("planned_ts") >= 17).cast("int").alias("prediction"))
    c = V.confusion(d)
    return c.select("tp", "fp", "fn", "tn", rnd("f1"), rnd("balanced_accuracy"))
