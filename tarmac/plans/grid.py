"""M20 grid over a resumable run log: one S7 document per configuration, named by the configuration's hash.

A run is finished when its document's folder is committed; a rerun reads which
ones are and computes the others only.  Summaries (A18), run lists with files
(A19), strategy ranking, scheme gap and parameter effects (R1-R3) read the
documents, whoever wrote them.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import joins as J
from ..operators.windows import competition_rank
from ..session import shared_path
from ..sources import runlogs as RL
from ..sources import tables as TB
from . import ml as ML
from .enrich import load_xy
from .views import rnd

#: fixed values of the reference's grid: 5 x 2 x 4 x 3 = 120 configurations
THRESHOLDS, ENCODINGS = (5, 10, 15, 20, 25), ("onehot", "label")
RESAMPLINGS, RUNS = ("smote", "undersample", "smoteenn", "smotetomek"), (1, 2, 3)
BASE_SEED = 42


def grid_configs(thresholds=THRESHOLDS, encodings=ENCODINGS, resamplings=RESAMPLINGS, runs=RUNS) -> list[dict]:
    return [{"threshold": t, "encoding": e, "resampling": r, "run": n, "scheme": "stratified_kfold"}
            for t, e, r, n in itertools.product(thresholds, encodings, resamplings, runs)]


def run_key(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:20]


class RunLog:
    """Documents under ``runlogs/<name>`` of the shared folder; the same name finds them again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, shared_path(spark, f"runlogs/{name}")

    def finished(self) -> set[str]:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            return set()
        runs = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("key=")]
        return {p.getName()[4:] for p in runs if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))}

    def record(self, config: dict, models: dict[str, list[dict]], facts: dict | None = None) -> None:
        """Write a run's document: ``models`` has each model's folds with f1 and balanced_accuracy."""
        def scores(folds):
            f1s, bas = ([float(f[m]) for f in folds] for m in ("f1", "balanced_accuracy"))
            mean = [sum(x) / len(x) for x in (f1s, bas)]
            std = [(sum((v - m) ** 2 for v in x) / len(x)) ** 0.5 for x, m in zip((f1s, bas), mean)]
            return {"folds": [{"fold": int(f["fold"]), "f1": a, "balanced_accuracy": b} for f, a, b in zip(folds, f1s, bas)],
                    "mean_f1": mean[0], "mean_balanced_accuracy": mean[1], "std_f1": std[0], "std_balanced_accuracy": std[1]}

        found = {m: scores(f) for m, f in models.items()}
        best = max(found, key=lambda m: (found[m]["mean_f1"], m))
        facts = facts or {}
        doc = {"source_file": run_key(config),
               "dataset": {"encoding": config.get("encoding"), "resampling": config.get("resampling"),
                           "threshold": config.get("threshold"), "run_index": config.get("run"), **facts},
               "experiment": config.get("experiment", "model_comparison"), "validation_scheme": config.get("scheme"),
               "strategy": config.get("strategy"), "models": found,
               "winner": {"model": best, "mean_f1": found[best]["mean_f1"],
                          "mean_balanced_accuracy": found[best]["mean_balanced_accuracy"]}}
        RL.write_run_logs(self.spark.createDataFrame([json.dumps(doc)], "string").select(
            F.from_json("value", S.RUN_LOG).alias("d")).select("d.*").coalesce(1), f"{self.path}/key={run_key(config)}")

    def documents(self) -> DataFrame:
        return RL.read_run_logs(self.spark, self.path)


def run_grid(log: RunLog, configs: Iterable[dict], run: Callable[[dict], tuple[dict, dict]]) -> int:
    """Compute and record the configurations that have no document yet; returns how many were."""
    done, fresh = log.finished(), 0
    for c in configs:
        if run_key(c) not in done:
            log.record(c, *run(c))
            fresh += 1
    return fresh


def departure_runs(spark: SparkSession, sf_dir: str, estimators=ML.ESTIMATORS, params: dict | None = None,
                   k: int = 5) -> Callable[[dict], tuple[dict, dict]]:
    """The grid's run of one configuration: all estimators on the same prepared folds of the delay classifier."""
    def run(c: dict) -> tuple[dict, dict]:
        xy = load_xy(TB.scan_departures(spark, sf_dir), TB.locations(spark, sf_dir), c["threshold"], c["encoding"])
        xy = xy.withColumnRenamed("is_late", ML.LABEL)
        features = [x for x in xy.columns if x not in ("row_id", ML.LABEL)]
        seed = BASE_SEED + c["run"] - 1
        folds = ML.Folds(ML._union(ML.prepare_folds(xy, features, c["resampling"], k, seed)), features)
        found = {m: ML.evaluate(folds, m, None, seed, (params or {}).get(m)) for m in estimators}
        folds.release()
        return found, {"row_count": xy.count(), "feature_count": len(features), "cv_random_state": seed}

    return run


# ---- summaries of documents

CONFIG = ["threshold", "encoding", "resampling", "strategy", "scheme"]


def model_runs(docs: DataFrame) -> DataFrame:
    """One row per (document, model) with the configuration's columns."""
    e = docs.select(F.col("dataset.threshold").alias("threshold"), F.col("dataset.encoding").alias("encoding"),
                    F.col("dataset.resampling").alias("resampling"), "strategy", F.col("validation_scheme").alias("scheme"),
                    F.col("dataset.run_index").alias("run"), "file_path", F.explode("models").alias("model", "m"))
    return e.select(*CONFIG, "run", "file_path", "model", F.col("m.mean_f1").alias("f1"),
                    F.col("m.mean_balanced_accuracy").alias("ba"))


def summary(docs: DataFrame) -> DataFrame:
    """A18 / A19 / T6 over documents: means and population deviations over runs, run ids and files, in order."""
    a = model_runs(docs).groupBy(*CONFIG, "model").agg(
        F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"), F.avg("ba").alias("mean_balanced_accuracy"),
        F.stddev_pop("ba").alias("std_balanced_accuracy"), F.count(F.lit(1)).alias("runs"),
        F.sort_array(F.collect_list("run")).alias("run_ids"), F.sort_array(F.collect_set("file_path")).alias("files"))
    a = a.withColumn("mean_of_means", (F.col("mean_f1") + F.col("mean_balanced_accuracy")) / 2)
    return a.select(*CONFIG, "model", *[rnd(c) for c in ("mean_f1", "std_f1", "mean_balanced_accuracy", "std_balanced_accuracy",
                                                         "mean_of_means")], "runs", "run_ids", "files").orderBy(
        "threshold", "encoding", "resampling", "strategy", "scheme", F.col("mean_f1").desc(), "model")


def strategy_ranking(docs: DataFrame) -> DataFrame:
    """Strategies of each scheme ranked by mean F1; strategies with the same fit share a rank."""
    a = model_runs(docs).groupBy("scheme", "strategy").agg(F.avg("f1").alias("mean_f1"), F.avg("ba").alias("mean_balanced_accuracy"))
    a = a.select("scheme", "strategy", rnd("mean_f1"), rnd("mean_balanced_accuracy"))
    return competition_rank(a, "mean_f1", "rank_f1", ["scheme"]).orderBy("scheme", "rank_f1", "strategy")


def gap(docs: DataFrame, one: str, other: str) -> DataFrame:
    """R2: F1 of every strategy under both schemes and the difference."""
    a = model_runs(docs).groupBy("scheme", "strategy").agg(F.avg("f1").alias("f1"))
    g = J.scheme_gap(a.filter(F.col("scheme") == one).drop("scheme"), a.filter(F.col("scheme") == other).drop("scheme"),
                     ["strategy"], "f1", "kfold", "oot")
    return g.select("strategy", rnd("f1_kfold"), rnd("f1_oot"), rnd("gap")).orderBy("strategy")


def parameter_effects(candidates: DataFrame, score: str = "mean_test_f1") -> DataFrame:
    """R3 / A20 over a search's table (params map, score): mean, sample deviation and count per value; null is a value."""
    e = candidates.select(score, F.explode("params").alias("param", "value"))
    a = e.withColumn("value", F.coalesce("value", F.lit("none"))).groupBy("param", "value").agg(
        F.avg(score).alias("mean_f1"), F.stddev_samp(score).alias("std_f1"), F.count(F.lit(1)).alias("n"))
    return a.select("param", "value", rnd("mean_f1"), rnd("std_f1"), "n").orderBy("param", F.col("mean_f1").desc(), "value")
