"""Keyed dedup, upsert, ranks, splits and folds as registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranks as RK
from ..operators import selection as SEL
from ..operators import upsert as UP
from ..operators.windows import hash_key_sql, latest_per_key
from ..session import shared_path
from ..sources import tables as TB
from . import sql as Q
from .registry import register
from .views import R, rnd

_NK = ", ".join(TB.NOTICE_KEY)
_NO_DESC = ", ".join(f"{c} DESC" for c in TB.NOTICE_ORDER)
_NO_ASC = ", ".join(TB.NOTICE_ORDER)


@register("latest_notice", f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus
FROM (SELECT *, row_number() OVER (PARTITION BY {_NK} ORDER BY {_NO_DESC}) AS rn FROM lineitem) WHERE rn = 1""")
def latest_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last notice per key (partial aggregate, no global sort)."""
    n = TB.notices(spark, sf_dir).withColumn("_ord", F.struct(*TB.NOTICE_ORDER))
    packed = F.struct(*[F.col(c) for c in TB.notices(spark, sf_dir).columns])
    out = n.groupBy(*TB.NOTICE_KEY).agg(F.max_by(packed, F.col("_ord")).alias("_l")).select("_l.*")
    return out


@register("upsert_notices", f"""
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, l.l_returnflag, l.l_linestatus, l.l_extendedprice
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_NK} ORDER BY {_NO_ASC}) AS rn FROM lineitem) WHERE rn = 1) f
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_NK} ORDER BY {_NO_DESC}) AS rn FROM lineitem) WHERE rn = 1) l
USING ({_NK})""")
def upsert_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 + U2: the notices arrive year by year; each year's batch is upserted into the
    stored table of the earlier ones.  The result equals replaying every notice in arrival order."""
    n = TB.notices(spark, sf_dir).withColumn("_year", F.year("l_shipdate"))
    table = UP.KeyedTable(spark, shared_path(spark, f"upsert/notices-{uuid.uuid4().hex[:12]}"), TB.NOTICE_KEY,
                          TB.NOTICE_ORDER, TB.NOTICE_FIRST, TB.NOTICE_UPDATED, buckets=8)
    years = n.select("_year").distinct().orderBy("_year").collect()   # a few calendar years
    for i, r in enumerate(years):
        table.merge(n.filter(F.col("_year").eqNullSafe(F.lit(r["_year"]))).drop("_year"), i)
    return table.read_or_empty(n)


@register("upsert_notices_single", f"""
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, l.l_returnflag, l.l_linestatus, l.l_extendedprice
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_NK} ORDER BY {_NO_ASC}) AS rn FROM lineitem) WHERE rn = 1) f
JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_NK} ORDER BY {_NO_DESC}) AS rn FROM lineitem) WHERE rn = 1) l
USING ({_NK})""")
def upsert_notices_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 in one merge: every notice row reduced to one row per key."""
    n = TB.notices(spark, sf_dir)
    return UP.merge_rows(n, TB.NOTICE_KEY, TB.NOTICE_ORDER, TB.NOTICE_FIRST, TB.NOTICE_UPDATED)


@register("mid_ranks", Q.q_transit("""
SELECT row_id, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rank,
       count(*) OVER (PARTITION BY value) AS tie_size
FROM transit"""))
def mid_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average rank with ties for every transit row (pooled)."""
    t = TB.transit(spark, sf_dir).select("row_id", "value")
    return RK.mid_ranks(t, "value").select("row_id", "value", "rank", "tie_size")


@register("mid_ranks_by_priority", Q.q_transit("""
SELECT row_id, o_orderpriority, value,
       rank() OVER (PARTITION BY o_orderpriority ORDER BY value)
         + (count(*) OVER (PARTITION BY o_orderpriority, value) - 1) / 2.0 AS rank
FROM transit"""))
def mid_ranks_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 within groups (range-partitioned by group and value, so a hot group spreads out)."""
    t = TB.transit(spark, sf_dir).select("row_id", "o_orderpriority", "value")
    return RK.mid_ranks(t, "value", ["o_orderpriority"]).select("row_id", "o_orderpriority", "value", "rank")


@register("chronological_split", Q.q_raw("""
SELECT row_id, planned_ts, CAST(rn > n - greatest(1, CAST(round_even(0.2 * n, 0) AS BIGINT)) AS INTEGER) AS is_test
FROM (SELECT row_id, planned_ts, row_number() OVER (ORDER BY planned_ts, row_id) AS rn, count(*) OVER () AS n
      FROM departures)"""))
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable time order; the last max(1, round_half_even(0.2 n)) rows are the test set."""
    d = TB.scan_departures(spark, sf_dir).select("row_id", "planned_ts")
    return d.withColumn("is_test", SEL.last_share(d, ["planned_ts", "row_id"], 0.2).cast("int"))


@register("folds", Q.q_raw(f"""
SELECT row_id, is_late, CAST((row_number() OVER (PARTITION BY is_late ORDER BY h, row_id) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT row_id, CAST(coalesce(date_diff('second', planned_ts, actual_ts) / 60.0 > 15, false) AS INTEGER) AS is_late,
             {hash_key_sql('row_id', 42)} AS h
      FROM departures)"""))
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 on the departures label (threshold 15)."""
    from ..functions import columns as C
    from ..operators.validation import stratified_folds
    d = TB.scan_departures(spark, sf_dir).select(
        "row_id", C.late_flag_strict(C.delay_raw("planned_ts", "actual_ts"), 15).alias("is_late"))
    return stratified_folds(d, "is_late", 5, 42).select("row_id", "is_late", "fold")


@register("first_notice", f"""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag, l_linestatus
FROM (SELECT *, row_number() OVER (PARTITION BY {_NK} ORDER BY {_NO_ASC}) AS rn FROM lineitem) WHERE rn = 1""")
def first_notice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival per key (``min_by`` partial aggregate)."""
    from ..operators.windows import first_per_key
    return first_per_key(TB.notices(spark, sf_dir), TB.NOTICE_KEY, TB.NOTICE_ORDER)
