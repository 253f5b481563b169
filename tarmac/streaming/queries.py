"""Structured Streaming versions of ingest, upsert, daily trend and dedup.

The reference refreshes its table by a daily batch run.  Here the same work
runs as streaming jobs over a landing folder.  A job (``Ingest``, ``Upsert``,
``Daily``, ``Dedup``) lives in a named folder with its stream checkpoint and
its table; ``run()`` takes all that landed since the last run
(``Trigger.AvailableNow``) and ends, so any later process goes on by making
the same job over the same folder.  Tables are ``KeyedTable``s merged by
``foreachBatch`` with the batch id as version: a micro-batch writes the
buckets it touches, and a replayed one changes nothing.

The registered queries let the given tables arrive in ``CHUNKS`` parts in
event-time order and run the job anew after each, in a fresh folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import columns as C
from ..operators.upsert import KeyedTable
from ..plans import sql as Q
from ..plans.registry import register
from ..session import shared_path
from ..sources import tables as TB

CHUNKS = 6   # arrivals per source


def _run_dir(spark: SparkSession, name: str) -> str:
    return shared_path(spark, f"stream/{name}-{uuid.uuid4().hex[:12]}")


def arrivals(df: DataFrame, order_col: str, landing: str, chunks: int = CHUNKS) -> Iterator[int]:
    """Let ``df`` arrive in ``landing`` in ascending ``order_col`` ranges; yields after each arrival.

    Ranges are of equal width (the filter is pushed to the scan) and written by
    as many tasks as the scan has; rows without a time come first.
    """
    bounds = df.agg(F.min(order_col).alias("lo"), F.max(order_col).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    if lo is None:
        df.write.mode("append").parquet(landing)
        yield 0
        return
    span = (hi - lo) / chunks
    typ = dict(df.dtypes)[order_col]

    def edge(i):   # naive wall-clock bound as text, cast to the column type (no time zone involved)
        return F.lit(str(lo + span * i)).cast(typ)

    for i in range(chunks):
        cond = F.col(order_col) >= edge(i) if i > 0 else F.lit(True)
        if i < chunks - 1:
            below = F.col(order_col) < edge(i + 1)
            cond = cond & (below if i > 0 else below | F.col(order_col).isNull())
        df.filter(cond).write.mode("append").parquet(landing)
        yield i


class Job:
    """A streaming job in the folder ``base`` over the files of ``landing``."""

    def __init__(self, spark: SparkSession, base: str, landing: str, schema):
        self.spark, self.base, self.landing, self.schema = spark, base.rstrip("/"), landing, schema
        self.progress: list[dict] = []

    def plan(self, source: DataFrame) -> DataStreamWriter:
        raise NotImplementedError

    def run(self) -> None:
        """Take all that landed since the last run."""
        source = self.spark.readStream.schema(self.schema).parquet(self.landing)
        q = self.plan(source).option("checkpointLocation", f"{self.base}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        self.progress += q.recentProgress

    def follow(self, df: DataFrame, order_col: str) -> None:
        """Run after each arrival of ``df``."""
        for _ in arrivals(df, order_col, self.landing):
            self.run()


# --- X1 incremental ingest ---------------------------------------------------------
class Ingest(Job):
    """Events become departures; those that left or were cancelled are appended to ``out`` (each file once)."""

    def __init__(self, spark, base, landing, schema, nation: DataFrame):
        super().__init__(spark, base, landing, schema)
        self.nation = nation

    def plan(self, source):
        dep = TB.status_filter(TB.departures_from(source, self.nation))
        return dep.writeStream.format("parquet").option("path", f"{self.base}/out")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/out")


@register("stream_ingest", Q.q_raw("""
SELECT row_id, status FROM departures_raw
WHERE lower(status) LIKE 'departed%' OR lower(status) LIKE 'cancelled%'"""))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files -> departures (stream-static broadcast join) -> S1 filter -> Parquet sink."""
    ev, base = TB.table(spark, sf_dir, "events"), _run_dir(spark, "ingest")
    job = Ingest(spark, base, f"{base}/landing", ev.schema, TB.table(spark, sf_dir, "nation"))
    job.follow(ev, "ts")
    return job.read().select("row_id", "status")


# --- X2 streaming upsert ------------------------------------------------------------
class Upsert(Job):
    """Every micro-batch of notices is merged into the keyed table."""

    def __init__(self, spark, base, landing, schema, buckets: int = 8):
        super().__init__(spark, base, landing, schema)
        self.table = KeyedTable(spark, f"{self.base}/table", TB.NOTICE_KEY, TB.NOTICE_ORDER, TB.NOTICE_FIRST,
                                TB.NOTICE_UPDATED, buckets)

    def plan(self, source):
        return source.writeStream.foreachBatch(lambda batch, i: self.table.merge(batch, i))


@register("stream_upsert", f"""
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, l.l_returnflag, l.l_linestatus, l.l_extendedprice
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1) f
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1) l
USING (l_orderkey, l_linenumber)""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 over the notices, arriving by ship date."""
    n, base = TB.notices(spark, sf_dir), _run_dir(spark, "upsert")
    job = Upsert(spark, base, f"{base}/landing", n.schema)
    job.follow(n, "l_shipdate")
    return job.table.read_or_empty(n)


# --- X3 daily tumbling trend with late data ----------------------------------------------
class Daily(Job):
    """Per event-time day: flights, cancellations, late departures (decomposable aggregates).

    ``update`` mode with a watermark: a day's state goes once the latest event
    time is ``watermark`` past its end, and rows that come later than that are
    not counted.  A micro-batch's days replace their former values in the
    keyed table, whose buckets are months.
    """

    COLUMNS = ["flights", "cancelled", "late"]

    def __init__(self, spark, base, landing, schema, nation: DataFrame, watermark: str = "7 days"):
        super().__init__(spark, base, landing, schema)
        self.nation, self.watermark = nation, watermark
        self.table = KeyedTable(spark, f"{self.base}/table", ["day"], ["batch"], [], self.COLUMNS,
                                bucket=F.year("day") * 12 + F.month("day"))

    def plan(self, source):
        dep = TB.status_filter(TB.departures_from(source, self.nation))
        d = C.delay_raw("planned_ts", "actual_ts")
        # Watermarks need an instant: the wall-clock time is read as UTC, and days are windows of that instant, so
        # that the watermark closes them and late rows are dropped.
        instant = F.from_utc_timestamp(F.col("planned_ts").cast("timestamp"), F.current_timezone())
        agg = (dep.withColumn("_et", instant).withWatermark("_et", self.watermark)
               .groupBy(F.window("_et", "1 day").alias("w"))
               .agg(F.count(F.lit(1)).alias("flights"),
                    F.count_if(F.col("status") == "Cancelled").alias("cancelled"),
                    F.count_if(d > 15).alias("late")))
        day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds("w.start") / 86400).cast("int"))
        return agg.writeStream.outputMode("update").foreachBatch(
            lambda batch, i: self.table.merge(batch.select(day.alias("day"), F.lit(i).alias("batch"), *self.COLUMNS), i))

    def read(self) -> DataFrame:
        found = self.table.read()
        return self.spark.createDataFrame([], "day date, flights long, cancelled long, late long") if found is None else found


@register("stream_daily", Q.q_raw("""
SELECT CAST(planned_ts AS DATE) AS day, count(*) AS flights, CAST(sum(CASE WHEN status = 'Cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled,
       CAST(sum(CASE WHEN date_diff('second', planned_ts, actual_ts) / 60.0 > 15 THEN 1 ELSE 0 END) AS BIGINT) AS late
FROM departures GROUP BY 1"""))
def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 over the departures, arriving by time."""
    ev, base = TB.table(spark, sf_dir, "events"), _run_dir(spark, "daily")
    job = Daily(spark, base, f"{base}/landing", ev.schema, TB.table(spark, sf_dir, "nation"))
    job.follow(ev, "ts")
    return job.read()


# --- X4 streaming dedup --------------------------------------------------------------------
class Dedup(Job):
    """One row per notice key, the last one (``keep="last"``) or the first.

    ``dropDuplicatesWithinWatermark`` would need state for ever to know a key
    that comes again after years.  Here the state is the keyed table: a
    micro-batch looks only at the buckets of its own keys, executors hold no
    state between batches, and rows may come as late as they like.
    """

    def __init__(self, spark, base, landing, schema, keep: str = "last", buckets: int = 8):
        super().__init__(spark, base, landing, schema)
        if keep not in ("first", "last"):
            raise ValueError(f"keep is 'first' or 'last', not {keep!r}")
        rest = [f.name for f in schema.fields if f.name not in TB.NOTICE_KEY]
        self.table = KeyedTable(spark, f"{self.base}/table", TB.NOTICE_KEY, TB.NOTICE_ORDER,
                                rest if keep == "first" else [], rest if keep == "last" else [], buckets)

    def plan(self, source):
        return source.writeStream.foreachBatch(lambda batch, i: self.table.merge(batch, i))


def _dedup(spark: SparkSession, sf_dir: str, keep: str) -> DataFrame:
    n, base = TB.notices(spark, sf_dir), _run_dir(spark, "dedup")
    job = Dedup(spark, base, f"{base}/landing", n.schema, keep)
    job.follow(n, "l_shipdate")
    return job.table.read_or_empty(n).select(*n.columns)


def _dedup_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in TB.NOTICE_ORDER)
    cols = ", ".join(dict.fromkeys(TB.NOTICE_KEY + TB.NOTICE_ORDER + TB.NOTICE_FIRST + TB.NOTICE_UPDATED))
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(TB.NOTICE_KEY)} "
            f"ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1")


@register("stream_dedup_last", _dedup_sql("DESC"))
def stream_dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 keeping the last notice of a key, as ``drop_duplicates(keep="last")`` does."""
    return _dedup(spark, sf_dir, "last")


@register("stream_dedup", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 keeping the first notice of a key: the keys."""
    return _dedup(spark, sf_dir, "first").select(*TB.NOTICE_KEY)
