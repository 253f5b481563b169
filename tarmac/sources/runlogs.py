"""Run-log documents (S5, S7, S10) and table sinks.

A run log is one nested document per configuration: dataset facts, a map
of model -> per-fold scores and summary, and the winner.  Documents are
written partitioned by threshold (S7), read back with an explicit schema
(S5: strict, or tolerant with a table of rejects), and their file names are
parsed for run attributes (S10).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import shared_path


def build_documents(scores: DataFrame, config: list[str], row_counts: DataFrame | None = None) -> DataFrame:
    """Fold-score rows (config.., model, fold, f1, balanced_accuracy) -> one document per config.

    Each document collects at most models x folds small structs (bounded by
    the grid, not by the data).
    """
    per_model = scores.groupBy(*config, "model").agg(
        F.sort_array(F.collect_list(F.struct(F.col("fold").cast("int").alias("fold"), "f1",
                                             "balanced_accuracy"))).alias("folds"),
        F.avg("f1").alias("mean_f1"), F.avg("balanced_accuracy").alias("mean_balanced_accuracy"),
        F.stddev_pop("f1").alias("std_f1"), F.stddev_pop("balanced_accuracy").alias("std_balanced_accuracy"))
    entry = F.struct(F.col("model").alias("key"), F.struct(
        "folds", "mean_f1", "mean_balanced_accuracy", "std_f1", "std_balanced_accuracy").alias("value"))
    best = F.max_by(F.struct(F.col("model").alias("model"), "mean_f1", "mean_balanced_accuracy"),
                    F.struct("mean_f1", "model"))
    docs = per_model.groupBy(*config).agg(F.map_from_entries(F.collect_list(entry)).alias("models"),
                                          best.alias("winner"))
    thr = F.col("threshold").cast("int") if "threshold" in config else F.lit(None).cast("int")
    run = F.col("run").cast("int") if "run" in config else F.lit(None).cast("int")
    return docs.select(
        F.concat_ws("_", F.lit("run"), *[F.col(c).cast("string") for c in config]).alias("source_file"),
        F.struct(F.lit("none").alias("encoding"), F.lit("none").alias("resampling"), thr.alias("threshold"),
                 F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("int").alias("feature_count"),
                 run.alias("run_index"), run.alias("cv_random_state"), F.lit(None).cast("long").alias("oot_train_rows"),
                 F.lit(None).cast("long").alias("oot_test_rows")).alias("dataset"),
        F.lit("group_rate_grid").alias("experiment"), F.lit("stratified_kfold").alias("validation_scheme"),
        F.lit(None).cast("string").alias("search_kind"), F.lit(None).cast("string").alias("strategy"),
        F.lit(None).cast("map<string,string>").alias("best_params"),
        F.lit(None).cast(S.RUN_LOG["search_results"].dataType).alias("search_results"),
        "models", "winner", *config)


def write_run_logs(docs: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """One JSON document per configuration, partitioned (e.g. by threshold)."""
    w = docs.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def read_run_logs(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """S5, strict: every log document with the explicit schema; a malformed one is an error (FAILFAST).

    ``multiline`` reads pretty-printed one-document-per-file logs.
    """
    r = spark.read.schema(S.RUN_LOG).option("mode", "FAILFAST").option("multiLine", multiline).json(path)
    return r.withColumn("file_path", F.col("_metadata.file_path"))


def read_run_logs_tolerant(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """S5, tolerant: (documents, rejects).  Rejects (file_path, reason, text) are documents that don't parse
    (``unreadable``, with their text) and those without a model's scores (``no models``).

    The documents are parsed once, into a table under the checkpoint folder
    that both are read from.
    """
    s = T.StructType([*S.RUN_LOG.fields, T.StructField("_text", T.StringType())])
    parsed = (spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_text")
              .option("multiLine", multiline).json(path).withColumn("file_path", F.col("_metadata.file_path")))
    out = shared_path(spark, f"parsed/runlogs-{uuid.uuid4().hex[:12]}")
    parsed.write.parquet(out)
    rows = spark.read.parquet(out).withColumn(
        "reason", F.when(F.col("_text").isNotNull(), F.lit("unreadable"))
                   .when(F.coalesce(F.size("models"), F.lit(0)) <= 0, F.lit("no models")))
    return (rows.filter(F.col("reason").isNull()).drop("reason", "_text"),
            rows.filter(F.col("reason").isNotNull()).select("file_path", "reason", F.col("_text").alias("text")))


def model_rows(logs: DataFrame) -> DataFrame:
    """Flatten ``models`` (map of struct) into one row per (document, model)."""
    e = logs.select("source_file", "dataset", "file_path", F.explode("models").alias("model", "m"))
    return e.select("source_file", "file_path", F.col("dataset.threshold").alias("threshold"),
                    F.col("dataset.run_index").alias("run"), "model",
                    F.col("m.mean_f1").alias("mean_f1"), F.col("m.mean_balanced_accuracy").alias("mean_balanced_accuracy"),
                    F.col("m.folds").alias("folds"))


def file_name_facts(logs: DataFrame, pattern: str = r"threshold=(\d+)/") -> DataFrame:
    """Run attributes parsed from file paths; first file per attribute, ordered."""
    f = logs.select("file_path", F.regexp_extract("file_path", pattern, 1).cast("int").alias("threshold")).distinct()
    first = f.groupBy("threshold").agg(F.min("file_path").alias("file_path"))
    return first.orderBy("threshold")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                columns: list[str] | None = None, run_id: str | None = None) -> str:
    """Export chosen columns; an optional run id becomes part of the path."""
    out = f"{path.rstrip('/')}/run={run_id}" if run_id else path
    d = df.select(*columns) if columns else df
    w = d.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(out)
    else:
        w.format(fmt).save(out)
    return out
