"""Keyed tables and streaming jobs: touched buckets, replays, clean-up, late rows, and a second process that goes on."""
import datetime as dt
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from tarmac.operators.upsert import KeyedTable, merge_rows
from tarmac.sources import tables as TB
from tarmac.streaming import queries as ST

SCHEMA = "day int, no string, seq int, opened string, status string"


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.path.getsize(os.path.join(d, f))
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _table(spark, path):
    return KeyedTable(spark, path, ["day", "no"], ["seq"], ["opened"], ["status"], bucket=F.coalesce("day", F.lit(-1)))


def test_merge_writes_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(d if d else None, f"F{i}", d, f"o{d}", "new") for d in range(10) for i in range(50)]
    first = spark.createDataFrame(rows, SCHEMA)
    later = [(4, "F1", 100, "other", None), (4, "F99", 101, "x", "extra"), (4, "F1", 99, "older", "between"), (4, None, 1, "n", "n")]
    second = spark.createDataFrame(later, SCHEMA)
    t = _table(spark, path)
    assert t.read() is None and t.read_or_empty(first).count() == 0
    assert t.merge(first, 0)
    before = _files(path)
    assert t.merge(second, 1)
    new = {k: v for k, v in _files(path).items() if k not in before}
    assert new and all(k.startswith("v=00000001/_bucket=4/") for k in new)
    assert sum(new.values()) < 0.3 * sum(before.values())

    want = set(map(tuple, merge_rows(first.unionByName(second), ["day", "no"], ["seq"], ["opened"], ["status"]).collect()))
    assert set(map(tuple, t.read().collect())) == want and len(want) == 502
    assert (4, "F1", "o4", None) in want

    assert not t.merge(second, 1) and not t.merge(first, 0)              # replays
    spark.createDataFrame([(4, "F1", 500, "a", "lost")], SCHEMA).withColumn("_bucket", F.lit(4)) \
        .write.partitionBy("_bucket").parquet(f"{path}/v=00000002")     # a merge that died before its commit
    assert set(map(tuple, _table(spark, path).read().collect())) == want
    assert t.merge(second.limit(0), 2)                                  # the batch run again, empty
    assert set(map(tuple, t.read().collect())) == want

    for v in range(3, 7):
        t.merge(spark.createDataFrame([(4, "F1", 100 + v, "z", f"s{v}")], SCHEMA), v)
    held = sorted({k.split("/")[0] for k in _files(path) if "_bucket=4/" in k})
    assert held == ["v=00000005", "v=00000006"]
    assert t.read().filter("day = 4 and no = 'F1'").first()["status"] == "s6" and t.read().count() == 502


def test_merges_into_large_buckets_write_their_batch_only(spark, tmp_path, monkeypatch):
    """Deltas are added without reading the table, read in order of versions, and made whole after a bounded number."""
    from tarmac.operators import upsert as UP
    monkeypatch.setattr(UP, "SMALL", 0)
    monkeypatch.setattr(UP, "DELTAS", 3)
    path = str(tmp_path / "t")
    t = _table(spark, path)
    batches = [[(d, f"F{i}", 10 * v + d, f"o{v}", f"s{v}") for d in range(2) for i in range(200 if v == 0 else 5)] for v in range(8)]
    batches[3] += [(None, "N", 1, "n", None), (0, None, 2, "n", "n")]
    written = []
    for v, rows in enumerate(batches):
        before = set(_files(path))
        assert t.merge(spark.createDataFrame(rows, SCHEMA), v)
        written.append({k.split("/")[1] for k in _files(path) if k not in before and k.startswith(f"v={v:08d}/") and "_bucket" in k})
        everything = spark.createDataFrame([r for b in batches[:v + 1] for r in b], SCHEMA)
        want = set(map(tuple, merge_rows(everything, ["day", "no"], ["seq"], ["opened"], ["status"]).collect()))
        assert set(map(tuple, _table(spark, path).read().collect())) == want
    assert written[:4] == [{"delta"}] * 4 and written[4] == {"_bucket=0", "_bucket=1"} and written[5] == {"delta"}


def test_a_second_process_goes_on(spark, tmp_path):
    """Half of the notices are merged here, the rest by another process over the same folder."""
    base = str(tmp_path / "job")
    n = TB.notices(spark, SF_SMALL)
    job = ST.Upsert(spark, base, f"{base}/landing", n.schema)
    for i in ST.arrivals(n, "l_shipdate", job.landing):
        if i < 3:
            job.run()
    held = job.table.version()
    assert held == 2
    code = f"""
        from tarmac.session import build_session
        from tarmac.sources import tables as TB
        from tarmac.streaming import queries as ST
        spark = build_session(master="local[2]", shuffle_partitions=2)
        job = ST.Upsert(spark, {base!r}, {base + '/landing'!r}, TB.notices(spark, {SF_SMALL!r}).schema)
        job.run()
        job.run()   # nothing landed since
        print("version", job.table.version())
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "version 3" in out.stdout
    want = merge_rows(n, TB.NOTICE_KEY, TB.NOTICE_ORDER, TB.NOTICE_FIRST, TB.NOTICE_UPDATED)
    got = job.table.read()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _events(spark, rows):
    return spark.createDataFrame([(i, ts, 1, "view", 30.0, None) for i, ts in rows],
                                 "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_late_rows_and_restart_of_the_daily_trend(spark, tmp_path):
    """A row two days late is counted, one behind the watermark is not; closed days leave the state."""
    base, nation = str(tmp_path / "daily"), TB.table(spark, SF_SMALL, "nation")
    day = lambda d, h=6: dt.datetime(2024, 3, d, h)
    lands = [[(1, day(1)), (2, day(2)), (3, day(10))],
             [(4, day(9)), (5, day(8)), (6, day(20))],     # 9 and 8: within three days of 10
             [(7, day(9)), (8, day(19)), (9, day(28))]]    # 9: its day is closed
    progress = []
    for rows in lands:
        _events(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/landing")
        job = ST.Daily(spark, base, f"{base}/landing", _events(spark, []).schema, nation, "3 days")   # a new job each time
        job.run()
        progress += job.progress
    got = {r["day"].day: r["flights"] for r in job.read().collect()}
    assert got == {1: 1, 2: 1, 8: 1, 9: 1, 10: 1, 19: 1, 20: 1, 28: 1}
    state = [p["stateOperators"][0] for p in progress if p["stateOperators"]]
    assert sum(s["numRowsRemoved"] for s in state) >= 4 and sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    assert state[-1]["numRowsTotal"] <= 2


@pytest.mark.parametrize("keep", ["first", "last"])
def test_dedup_of_rows_in_any_order(spark, tmp_path, keep):
    """Keys that come again years later and out of order; no state between batches."""
    base = str(tmp_path / keep)
    n = TB.notices(spark, SF_SMALL)
    job = ST.Dedup(spark, base, f"{base}/landing", n.schema, keep)
    for part in reversed(range(3)):
        n.filter(F.year("l_shipdate") % 3 == part).write.mode("append").parquet(job.landing)
        job.run()
    o = F.struct(*TB.NOTICE_ORDER)
    pick = F.min_by if keep == "first" else F.max_by
    want = n.groupBy(*TB.NOTICE_KEY).agg(pick(F.struct(*n.columns), o).alias("r")).select("r.*")
    got = job.table.read().select(*n.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert all(not p["stateOperators"] for p in job.progress)


def test_empty_landing(spark, tmp_path):
    n = TB.notices(spark, SF_SMALL).limit(0)
    job = ST.Upsert(spark, str(tmp_path / "e"), str(tmp_path / "landing"), n.schema)
    job.follow(n, "l_shipdate")
    assert job.table.read_or_empty(n).count() == 0
