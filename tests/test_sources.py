"""Page extraction (board mode), run-log documents and tolerant CSV on literal inputs."""
import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

from tarmac import schemas as S
from tarmac.sources import pages as PG
from tarmac.sources import runlogs as RL
from tarmac.sources import tables as TB

PAGE = """<html><body>
<p class="table-departures-arrivals__divider">Monday 25/04/2026</p><table><tr><td>09:00</td><td>X (XXX)</td><td>AA 1</td><td>Departed 09:10</td></tr></table>
<p class="table-departures-arrivals__divider">Tuesday 26/04/2026</p>
<table><thead><tr><th>Time</th><th>Destination</th><th>Flight number</th><th>Status</th></tr></thead>
<tbody>
<tr><td> 23:10 </td><td>MUNICH (MUC)</td><td>LH 1623</td><td>Departed 01:05</td></tr>
<tr><td>10:00</td><td>PARIS (CDG)</td><td>AF 100</td><td>Cancelled</td></tr>
<tr><td>11:00</td><td>ROME (FCO)</td><td></td><td>Departed 11:05</td></tr>
<tr><td>No flights today</td><td></td><td></td><td></td></tr>
<tr><td>12:00</td><td>short row</td></tr>
</tbody></table></body></html>"""


def test_board_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string")
    rows = PG.extract_departures(pages, date="2026-04-26").orderBy("flight_no").collect()
    assert [r["flight_no"] for r in rows] == ["AF 100", "LH 1623"]
    lh = rows[1]
    assert lh["carrier"] == "LH" and lh["route"] == "MUNICH (MUC)"
    assert str(lh["actual_ts"]) == "2026-04-27 01:05:00"      # midnight guard
    assert rows[0]["actual_ts"] is None
    assert [str(r["flight_date"]) for r in PG.extract_departures(pages).orderBy("pos").collect()] == \
        ["2026-04-25", "2026-04-26", "2026-04-26"]


def test_board_rows_leave_in_bounded_batches(spark, monkeypatch):
    """Many pages in one Arrow batch: rows leave a task in batches of about OUT_ROWS, all of them and in page order."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(PG, "OUT_ROWS", 10)
    pages = spark.range(500).coalesce(1).select(F.col("id").alias("page_id"), F.lit(PAGE).alias("html"))
    sizes = []

    class Frame:   # keeps the function that runs over a task's batches
        def select(self, *_):
            return self

        def mapInArrow(self, f, schema):
            got = list(f(iter(pages.toArrow().to_batches())))
            sizes.extend(b.num_rows for b in got)
            return got

    got = PG.board_rows(Frame())
    assert sum(sizes) == 1500 and max(sizes) <= 12
    assert got[0].schema.names == ["page_id", "pos", "date", "planned", "route", "flight_no", "status"]
    found = PG.board_rows(pages)
    assert found.count() == 1500 and found.distinct().count() == 1500


def test_board_sections_of_odd_markup():
    """Sections without a date or table, tables without a divider, tables in cells, open rows and cells, other words."""
    d = '<p class="x day">{}</p>'
    row = "<tr><td>09:0{0}</td><td>A &amp; B<td>AA {0}</td><td>Gone</td>"
    board = PG.Board("day", "Nichts", "Flugnummer", "gestartet", r"(\d\d)\.(\d\d)\.(\d{4})")
    html = (f"<table>{row.format(0)}</table>" + d.format("no date") + f"<table>{row.format(1)}</table>" + d.format("Mo 01.02.2026")
            + d.format("Di 02.02.2026") + f"<p>text</p><table>{row.format(2)}{row.format(3)}</table><table>{row.format(4)}</table>"
            + d.format("Mi 03.02.2026") + "<table><tr><td>10:00</td><td>B<table><tr><td>in</td></tr></table></td><td>BB 5</td><td>s</td></tr>"
            + "<tr><td>11:00</td><td></td><td>Flugnummer</td><td></td></tr><tr><td>Nichts</td><td></td><td>x</td><td></td></tr>")
    assert PG.parse_board(html, board) == [("2026-02-02", "09:02", "A & B", "AA 2", "Gone"), ("2026-02-02", "09:03", "A & B", "AA 3", "Gone"),
                                           ("2026-02-03", "10:00", "Bin", "BB 5", "s")]
    assert PG.parse_board(None) == PG.parse_board("") == []


def test_run_logs_multiline_and_tolerant(spark):
    d = tempfile.mkdtemp(prefix="tarmac-logs-")
    doc = {"source_file": "x.csv", "dataset": {"encoding": "onehot", "resampling": "smote", "threshold": 15,
                                              "row_count": 6642, "feature_count": 49, "run_index": 1},
           "models": {"forest": {"folds": [{"fold": 0, "f1": 0.5, "balanced_accuracy": 0.6}],
                                 "mean_f1": 0.5, "mean_balanced_accuracy": 0.6, "std_f1": 0.0,
                                 "std_balanced_accuracy": 0.0}},
           "best_params": {"max_depth": None, "n_estimators": 300},
           "winner": {"model": "forest", "mean_f1": 0.5, "mean_balanced_accuracy": 0.6}}
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump(doc, f, indent=2)
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('{"source_file": "broken", "models": {')
    with open(os.path.join(d, "c.json"), "w") as f:
        json.dump({"source_file": "early.csv", "models": {}}, f)
    good, bad = RL.read_run_logs_tolerant(spark, d, multiline=True)
    m = RL.model_rows(good).collect()
    assert len(m) == 1 and m[0]["model"] == "forest" and m[0]["threshold"] == 15
    rejects = {os.path.basename(r["file_path"]): (r["reason"], r["text"]) for r in bad.collect()}
    assert rejects == {"b.json": ("unreadable", '{"source_file": "broken", "models": {'), "c.json": ("no models", None)}
    with pytest.raises(Exception, match="(?i)malformed"):
        RL.read_run_logs(spark, d, multiline=True).collect()


def test_csv_tolerant(spark):
    d = tempfile.mkdtemp(prefix="tarmac-csv-")
    p = os.path.join(d, "x.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,2\nx,3\n4,5\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    good, bad = TB.read_csv_tolerant(spark, p, schema)
    assert [tuple(r) for r in good.orderBy("a").collect()] == [(1, 2), (4, 5)]
    assert [(r["line"], r["file_path"].endswith("x.csv")) for r in bad.collect()] == [("x,3", True)]
