"""Source / sink queries: page extraction (S4), run-log round trip."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources import pages as PG
from ..sources import runlogs as RL
from ..sources import tables as TB
from . import sql as Q
from .experiments_q import _q, fold_scores_df
from .registry import register
from .views import R


@register("page_links", f"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, hrefs[pos] AS href, texts[pos] AS text FROM (
  SELECT page_id, hrefs, texts, unnest(generate_series(1, len(hrefs))) AS pos FROM (
    SELECT page_id, regexp_extract_all(html, '{PG.LINK_PATTERN}', 1) AS hrefs,
           regexp_extract_all(html, '{PG.LINK_PATTERN}', 2) AS texts FROM pages))""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 list mode: every ``<li><a href>`` item of every page, in page order."""
    return PG.page_links(TB.table(spark, sf_dir, "pages"))


@register("page_board_rows", Q.q_raw("""
SELECT flight_date, flight_no, carrier, route, planned_ts, status,
       CASE WHEN a < planned_ts - INTERVAL 12 HOUR THEN a + INTERVAL 1 DAY ELSE a END AS actual_ts
FROM (SELECT *, CASE WHEN status LIKE 'Departed%' THEN CAST(flight_date AS TIMESTAMP)
                + to_minutes(CAST(substr(status, 10, 2) AS BIGINT) * 60 + CAST(substr(status, 13, 2) AS BIGINT)) END AS a
      FROM departures_raw)"""))
def page_board_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 board mode, F3: all departures rendered as board pages, written, and read back from their dated sections."""
    path = shared_path(spark, f"pages/{uuid.uuid4().hex[:12]}")
    PG.board_pages(TB.departures_raw(spark, sf_dir)).write.parquet(path)
    return PG.extract_departures(spark.read.parquet(path)).drop("page_id", "pos")


def _logs(spark: SparkSession, sf_dir: str):
    path = shared_path(spark, f"runlogs/{uuid.uuid4().hex[:12]}")
    docs = RL.build_documents(fold_scores_df(spark, sf_dir), ["threshold", "run"])
    RL.write_run_logs(docs.drop("run"), path, ["threshold"])
    return RL.read_run_logs(spark, path)


@register("run_logs_roundtrip", _q("SELECT * FROM summary"))
def run_logs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 -> S5 -> A18: fold scores written as one nested document per (threshold, run),
    read back with the explicit schema, models map exploded, summarised."""
    m = RL.model_rows(_logs(spark, sf_dir))
    runs = m.select("threshold", "model", "run", F.col("mean_f1").alias("f1"),
                    F.col("mean_balanced_accuracy").alias("ba"))
    a = runs.groupBy("threshold", "model").agg(
        F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"),
        F.avg("ba").alias("mean_balanced_accuracy"), F.stddev_pop("ba").alias("std_balanced_accuracy"),
        F.count(F.lit(1)).alias("runs"))
    a = a.withColumn("mean_of_means", (F.col("mean_f1") + F.col("mean_balanced_accuracy")) / 2)
    return a.select("threshold", "model", *[F.round(c, R).alias(c) for c in
                                            ("mean_f1", "std_f1", "mean_balanced_accuracy", "std_balanced_accuracy",
                                             "mean_of_means")], "runs")


@register("log_files")
def log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold parsed from each log file path; first file per threshold."""
    return RL.file_name_facts(_logs(spark, sf_dir))


@register("csv_roundtrip", """
WITH d AS (SELECT e.event_id AS row_id, e.event_type, e.value FROM events e)
SELECT row_id, event_type, value FROM d""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 -> S2: chosen columns exported as header CSV under a run id, read back with an explicit schema."""
    from pyspark.sql import types as T
    ev = TB.table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "event_type", "value")
    out = RL.write_table(ev, shared_path(spark, "exports/events"), fmt="csv", run_id=uuid.uuid4().hex[:12])
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    return TB.read_csv(spark, out, schema)


@register("csv_tolerant", """
SELECT event_id AS row_id, event_type, value, NULL AS line FROM events WHERE event_type <> 'error'
UNION ALL
SELECT NULL, NULL, NULL, CAST(event_id AS VARCHAR) || CASE WHEN event_id % 2 = 0 THEN ',error,n/a' ELSE ',error' END
FROM events WHERE event_type = 'error'""")
def csv_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: events exported as CSV, errors as lines with a text for the number or a field too few; the good rows
    beside the rejected lines."""
    from pyspark.sql import types as T
    id_, kind = F.col("event_id").cast("string"), F.col("event_type")
    line = F.when(kind == "error", F.concat_ws(",", id_, kind, F.when(F.col("event_id") % 2 == 0, F.lit("n/a")))) \
        .otherwise(F.concat_ws(",", id_, kind, F.col("value").cast("string")))
    path = shared_path(spark, f"exports/lines-{uuid.uuid4().hex[:12]}")
    TB.table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    good, bad = TB.read_csv_tolerant(spark, path, schema, header=False)
    return good.unionByName(bad.select("line"), allowMissingColumns=True)
