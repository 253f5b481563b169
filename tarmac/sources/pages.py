"""Extraction of rows from raw HTML pages, as a job over a table of pages.

List mode (``<li><a href>`` items) is pure JVM-side regex + ``posexplode``.
Board mode (the departure-board table after a dated divider) needs a real
HTML tokenizer: a small stdlib ``html.parser`` helper runs per page inside
``mapInArrow``, Arrow-batched, so pages are split across tasks and whole
pages are parsed (no prefix).  The parsed cells then go through the same
column functions as every other source (P2-P6).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

LINK_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'


@dataclass(frozen=True)
class Board:
    """How a departure board is marked up: texts in the board's language, class of the dated dividers, date form.

    ``date`` is a regular expression with day, month and year as its groups.
    """
    divider_class: str = "table-departures-arrivals__divider"
    empty_text: str = "No flights"
    header_text: str = "Flight number"
    departed: str = "departed"
    date: str = r"(\d{2})/(\d{2})/(\d{4})"


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href, text) for every list link of every page."""
    h = F.regexp_extract_all("html", F.lit(LINK_PATTERN), 1)
    t = F.regexp_extract_all("html", F.lit(LINK_PATTERN), 2)
    z = pages.select("page_id", F.arrays_zip(h.alias("href"), t.alias("text")).alias("_z"))
    return z.select("page_id", F.posexplode("_z").alias("pos", "_l")).select(
        "page_id", "pos", F.col("_l.href").alias("href"), F.col("_l.text").alias("text"))


class _BoardParser(HTMLParser):
    """Collects the rows of every board section as (divider text, list of cell texts).

    A section is a divider and the first table after it; a table without a
    divider of its own before it belongs to none.  Tables in cells and cells
    or rows left open are taken as they come: an inner table's rows stay text
    of the outer cell, and a new row or cell ends the one before.
    """

    def __init__(self, board: Board):
        super().__init__(convert_charrefs=True)
        self.board = board
        self.divider: list[str] | None = None    # text of the divider being read
        self.section: str | None = None          # divider that waits for, or owns, a table
        self.depth = 0                           # of tables, in the section's table
        self.row: list[str] | None = None
        self.cell: list[str] | None = None
        self.rows: list[tuple[str, list[str]]] = []

    def _end_cell(self):
        if self.cell is not None:
            self.row.append("".join(self.cell))
            self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row is not None:
            self.rows.append((self.section, self.row))
            self.row = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.section is not None:
                self.depth += 1
        elif self.depth == 1:
            if tag == "tr":
                self._end_row()
                self.row = []
            elif tag in ("td", "th") and self.row is not None:
                self._end_cell()
                self.cell = []
        elif self.depth == 0 and tag == "p":
            self._end_divider()
            if self.board.divider_class in (dict(attrs).get("class") or "").split():
                self.divider = []

    def _end_divider(self):
        if self.divider is not None:
            self.section, self.divider = "".join(self.divider), None

    def handle_endtag(self, tag):
        if tag == "p" and self.depth == 0:
            self._end_divider()
        elif tag == "table" and self.depth:
            self.depth -= 1
            if self.depth == 0:
                self._end_row()
                self.section = None
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
        elif self.depth == 1 and tag == "tr":
            self._end_row()

    def handle_data(self, data):
        if self.divider is not None:
            self.divider.append(data)
        if self.cell is not None:
            self.cell.append(data)

    def close(self):
        super().close()
        self._end_row()


def parse_board(html: str | None, board: Board = Board()) -> list[tuple[str, str, str, str, str]]:
    """Board rows (date as YYYY-MM-DD, planned, route, flight_no, status) of all dated sections, with >= 4 cells;
    placeholder, header and empty-key rows skipped; cells trimmed."""
    p = _BoardParser(board)
    p.feed(html or "")
    p.close()
    out = []
    for divider, cells in p.rows:
        date = re.search(board.date, divider)
        if date is None or len(cells) < 4 or board.empty_text in cells[0]:
            continue
        planned, route, flight_no, status = (c.strip() for c in cells[:4])
        if not flight_no or board.header_text in flight_no:
            continue
        out.append(("-".join(reversed(date.groups())), planned, route, flight_no, status))
    return out


#: rows of a page board that leave a task at once, about
OUT_ROWS = 4096
BOARD_SCHEMA = "page_id long, pos int, date string, planned string, route string, flight_no string, status string"


def board_rows(pages: DataFrame, board: Board = Board()) -> DataFrame:
    """Raw board cells of every section of every page.

    An Arrow batch is read page by page and its rows leave in batches of about ``OUT_ROWS``, so that a task holds no
    more than the batch and so many rows.
    """
    schema = pa.schema([("page_id", pa.int64()), ("pos", pa.int32()),
                        *[(c, pa.string()) for c in ("date", "planned", "route", "flight_no", "status")]])

    def parse(batches):
        recs = []
        for b in batches:
            for pid, html in zip(b.column(0), b.column(1)):
                key = pid.as_py()
                recs += [(key, i, *r) for i, r in enumerate(parse_board(html.as_py(), board))]
                if len(recs) >= OUT_ROWS:
                    yield packed(recs)
                    recs = []
        yield packed(recs)

    def packed(recs):
        columns = list(zip(*recs)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return pages.select("page_id", "html").mapInArrow(parse, BOARD_SCHEMA)


def extract_departures(pages: DataFrame, board: Board = Board(), date: str | None = None) -> DataFrame:
    """S4 + P2-P6: board rows -> departure records ready for the upsert (S8); ``date`` (YYYY-MM-DD) keeps one day."""
    r = board_rows(pages, board)
    if date is not None:
        r = r.filter(F.col("date") == date)
    d = F.to_date("date")
    planned = C.combine_date_time(d, F.col("planned"))
    actual = C.combine_date_time(d, C.time_from_status("status", board.departed))
    return r.select(
        "page_id", "pos", d.alias("flight_date"), "flight_no", C.carrier_code("flight_no").alias("carrier"), "route",
        planned.alias("planned_ts"), C.midnight_guard(actual, planned).alias("actual_ts"), "status")


PAGE_ROWS = 200


def board_pages(departures: DataFrame, board: Board = Board(), rows: int = PAGE_ROWS) -> DataFrame:
    """Departures rendered as board pages (page_id, html): ``rows`` consecutive row ids a page, a dated section a day.

    A page's rows are bounded by its ids, whatever the days or carriers.
    """
    def esc(c):
        return F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    cells = [F.date_format("planned_ts", "HH:mm"), esc("route"), esc("flight_no"), esc("status")]
    tr = F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td> "), F.coalesce(c, F.lit("")), F.lit("</td>"))],
                  F.lit("</tr>"))
    page = F.floor(F.col("row_id") / rows).cast("long").alias("page_id")

    def joined(order, text):
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x["col2"]), "\n")

    section = departures.groupBy(page, "flight_date").agg(joined(F.col("row_id").alias("col1"), tr.alias("col2")).alias("_rows"))
    html = F.concat(F.lit(f'<p class="{board.divider_class}">'), F.date_format("flight_date", "EEEE dd/MM/yyyy"),
                    F.lit(f"</p>\n<table><thead><tr><th>Time</th><th>To</th><th>{board.header_text}</th><th>Status</th></tr>"
                          "</thead><tbody>"), "_rows", F.lit("</tbody></table>"))
    return section.groupBy("page_id").agg(F.concat(F.lit("<html><body>"), joined(F.col("flight_date").alias("col1"), html.alias("col2")),
                                                   F.lit("</body></html>")).alias("html"))
