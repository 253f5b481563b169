"""Line dedup by winnowing over line hashes (built-in functions only).

A text is its sequence of non-blank lines.  Of every window of ``window``
consecutive line hashes the smallest is a fingerprint, so any run of that many
lines that two texts share has a fingerprint in common.  A single line of at
least ``line_chars`` characters, white space not counted, is a window of its
own.  Fingerprints are counted over all positions; those that
occur once go no further, and with them go most lines.

A match of two positions is extended both ways as far as the lines agree: each
window around a repeated fingerprint is looked up by the digest of its lines'
digests,
the next window of a run matches as well, and the matching windows of a run
together are the run.  All lines of matching windows are deleted except where
their content occurs first, in the order of (doc_id, text, position).  Each
occurrence is compared with the first one only, never with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .registry import query

WINDOW, LINE_CHARS = 2, 40
_BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _chars(line: Column) -> Column:
    """Characters of a line that are not white space; 0 for a blank line."""
    return F.length(F.translate(line, _BLANKS, ""))


def _windows(window: int, line_chars: int) -> Column:
    """array<struct<fp, at, last, digest>> of the windows over the column ``seq`` (array<struct<h, chars, digest, at>>).

    ``at`` and ``last`` are the places of a window's first and last line.
    """
    def run(start):
        lines = [F.get("seq", start + j) for j in range(window)]
        return F.struct(F.array_min(F.array(*(x["h"] for x in lines))).alias("fp"), lines[0]["at"].alias("at"),
                        lines[-1]["at"].alias("last"),
                        F.unhex(F.md5(F.concat(*(x["digest"] for x in lines)))).alias("digest"))

    def single(x):
        return F.struct(x["h"].alias("fp"), x["at"].alias("at"), x["at"].alias("last"), x["digest"].alias("digest"))

    last = F.size("seq") - window
    runs = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), run))
    singles = F.filter(F.transform("seq", lambda x: F.when(x["chars"] >= line_chars, single(x))),
                       lambda x: x.isNotNull())
    return F.concat(F.coalesce(runs, F.slice(singles, 1, 0)), singles)


def dedup_lines(docs: DataFrame, window: int = WINDOW, line_chars: int = LINE_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines (not blank), n_deleted, text (what is left).

    A null text is empty.  Blank lines are never compared; they stay where they
    are.  Rows that repeat a doc_id with the same text are one document and get
    the same result; a null doc_id comes before all others.  Other columns are
    ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "th", F.xxhash64("text"))
    lines = _lines(F.col("text"))
    seq = F.filter(F.transform(lines, lambda x, i: F.struct(F.xxhash64(x).alias("h"), _chars(x).alias("chars"),
                                                            F.unhex(F.md5(x)).alias("digest"), i.alias("at"))),
                   lambda x: x["chars"] > 0)
    windows = (rows.withColumn("seq", seq).select("doc_id", "th", F.explode(_windows(window, line_chars)).alias("w"))
               .select("doc_id", "th", "w.fp", "w.at", "w.last", "w.digest"))
    windows = scratch.keep(windows, "windows")
    # merge joins: the same plan at every size, hot keys split by the engine, no side broadcast
    repeated = windows.groupBy("fp").agg(F.count("*").alias("k")).filter("k > 1")
    matched = windows.join(repeated.select("fp").hint("merge"), "fp", "left_semi")
    # of equal windows the first stays; min over one struct, pre-aggregated before the shuffle
    place = F.struct("doc_id", "th", "at")
    first = matched.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("k")).filter("k > 1")
    later = (matched.join(first.select("digest", "first").hint("merge"), "digest")
             .filter(~place.eqNullSafe(F.col("first"))))
    gone = (later.select("doc_id", "th", F.explode(F.sequence("at", "last")).alias("i"))
            .groupBy("doc_id", "th").agg(F.collect_set("i").alias("gone")))
    gone = scratch.keep(gone.select(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"), "gone"), "gone")
    met = rows.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")),
                    "left")
    # a window's places may have blank lines between them, which stay
    drop = F.filter(F.transform(lines, lambda x, i: F.when(F.array_contains("gone", i) & (_chars(x) > 0), i)),
                    lambda i: i.isNotNull())
    left = F.concat_ws("\n", F.filter(lines, lambda x, i: ~(F.array_contains("gone", i) & (_chars(x) > 0))))
    n_lines = F.size(F.filter(lines, lambda x: _chars(x) > 0))
    return met.select("doc_id", n_lines.cast("long").alias("n_lines"),
                      F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size(drop)).cast("long").alias("n_deleted"),
                      F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))


ORACLE_SQL = rf"""
WITH l AS (SELECT doc_id, i, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
      lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM l WHERE chars > 0),
w AS (SELECT doc_id, k, 1 AS n, line AS body FROM s WHERE chars >= {LINE_CHARS}
      UNION ALL SELECT doc_id, k, 2, line || chr(10) || nxt FROM s WHERE nxt IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS r FROM w),
g AS (SELECT DISTINCT doc_id, k + j AS k FROM f, range(2) AS t(j) WHERE r > 1 AND j < n),
m AS (SELECT l.doc_id, l.i, l.line, l.chars, g.k IS NOT NULL AS gone FROM l LEFT JOIN s ON s.doc_id = l.doc_id
      AND s.i = l.i LEFT JOIN g ON g.doc_id = s.doc_id AND g.k = s.k)
SELECT doc_id, count(*) FILTER (chars > 0) AS n_lines, count(*) FILTER (gone) AS n_deleted,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM m GROUP BY 1
"""


@query("op3_winnow_lines", ORACLE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))
