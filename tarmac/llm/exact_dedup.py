"""Exact dedup: a Golomb-coded fingerprint exchange, then byte verification of the suspects.

1. The rows are written once where they lie (no shuffle), each with its
   partition, place and 64-bit fingerprint, bucketed by partition.
2. Groups of partitions are the senders.  A sender sorts its distinct
   fingerprints, cut to log2(rows) + 12 bits, and sends each owner of a
   fingerprint range one Golomb-coded letter.  A text that fills a third of
   the table is one fingerprint per sender.
3. An owner decodes its letters and answers each with a bitmap of the
   fingerprints that another letter holds too.
4. The senders turn bitmaps, and repeats of their own, into a bit set of
   suspect places per partition.  It meets the bucketed rows without moving
   them; only suspects' texts are shuffled, pre-aggregated by their bytes.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .golomb import decode, encode
from .registry import query

#: rows that a sender or an owner handles at most on average
ROWS_EACH = 1 << 18
#: bits of a fingerprint beyond log2(rows): an unequal pair is a suspect with probability 2^-12 per row
EXTRA_BITS = 12


def _letters(pdf: pd.DataFrame, owners: int, bits: int) -> pd.DataFrame:
    """One row per owner: the coded fingerprints, and for the sender's own use the rows behind them."""
    sender = pdf["sender"].iloc[0]
    fp = pdf["fp"].to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)
    order = np.argsort(fp, kind="stable")
    fp, pid, place = fp[order], pdf["pid"].to_numpy()[order], pdf["place"].to_numpy()[order]
    own, rank, repeats = np.unique(fp, return_inverse=True, return_counts=True)
    width = -(-(1 << bits) // owners)
    owner = (own // np.uint64(width)).astype(np.int64)
    rows = []
    for o in np.unique(owner):
        lo, hi = np.searchsorted(owner, o), np.searchsorted(owner, o, side="right")
        k, code = encode(own[lo:hi] - np.uint64(o * width))
        mine = slice(np.searchsorted(rank, lo), np.searchsorted(rank, hi))
        rows.append((sender, o, hi - lo, k, code, np.packbits(repeats[lo:hi] > 1).tobytes(),
                     (rank[mine] - lo).astype(np.int32), pid[mine].astype(np.int32), place[mine].astype(np.int64)))
    return pd.DataFrame(rows, columns=["sender", "owner", "n", "k", "code", "repeats", "rank", "pid", "place"])


def _answers(pdf: pd.DataFrame) -> pd.DataFrame:
    """The owner's bitmap for each letter: which of its fingerprints are in another letter too."""
    lists = [decode(n, k, c) for n, k, c in zip(pdf["n"], pdf["k"], pdf["code"])]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    again = values[counts > 1]
    maps = [np.packbits(np.isin(x, again, assume_unique=True)).tobytes() for x in lists]
    return pd.DataFrame({"sender": pdf["sender"], "owner": pdf["owner"], "bitmap": maps})


def _suspects(frames):
    """Places whose fingerprint is repeated in its letter or marked in the owner's bitmap."""
    for pdf in frames:
        for r in pdf.itertuples(index=False):
            marked = np.unpackbits(np.frombuffer(r.repeats, dtype=np.uint8)
                                   | np.frombuffer(r.bitmap, dtype=np.uint8))[:r.n].astype(bool)
            hit = marked[np.asarray(r.rank)]
            yield pd.DataFrame({"pid": np.asarray(r.pid)[hit], "place": np.asarray(r.place)[hit]})


def _bit_set(pdf: pd.DataFrame) -> pd.DataFrame:
    place = pdf["place"].to_numpy()
    bits = np.zeros((int(place.max()) // 64 + 1) * 64, dtype=np.uint8)
    bits[place] = 1
    return pd.DataFrame({"pid": pdf["pid"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").view("<i8")]})


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, group_size, stays, rid, sha): ``row`` is the row of ``docs``, ``stays`` and ``rid`` tell rows apart."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    plain = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.spark_partition_id().alias("pid"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        F.xxhash64(plain).alias("fp"), F.sha2(plain, 256).alias("sha"))
    name = f"llm_exact_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.write.format("parquet").bucketBy(buckets, "pid").option("compression", "zstd")
     .option("path", f"{scratch.base}/rows").saveAsTable(name))
    stored = spark.read.table(name)
    n = stored.count()
    bits = min(62, max(1, math.ceil(math.log2(n + 1))) + EXTRA_BITS)
    parties = max(buckets, -(-n // ROWS_EACH))
    letters = scratch.keep(
        stored.select("pid", "place", "fp", F.pmod(F.hash("pid"), F.lit(parties)).alias("sender"))
        .groupBy("sender").applyInPandas(
            lambda pdf: _letters(pdf, parties, bits),
            "sender int, owner long, n long, k int, code binary, repeats binary, rank array<int>, pid array<int>, "
            "place array<long>"), "letters")
    answers = letters.select("sender", "owner", "n", "k", "code").groupBy("owner").applyInPandas(
        _answers, "sender int, owner long, bitmap binary")
    suspect = (letters.select("sender", "owner", "n", "repeats", "rank", "pid", "place")
               .join(answers, ["sender", "owner"]).mapInPandas(_suspects, "pid int, place long"))
    sets = scratch.keep(suspect.groupBy("pid").applyInPandas(_bit_set, "pid int, bits array<long>"), "sets")
    word = F.get("bits", F.floor(F.col("place") / 64).cast("int"))
    rid = F.struct(F.col(f"row.{id_col}").alias("doc_id"), "pid", "place")
    met = stored.join(sets, "pid", "left").select(
        "row", rid.alias("rid"), "sha",
        (F.coalesce(F.getbit(word, (F.col("place") % 64).cast("int")), F.lit(0)) == 1).alias("suspect"))
    # the texts themselves are the grouping key: equal bytes, not equal fingerprints
    text = F.coalesce(F.col(f"row.{text_col}"), F.lit(""))
    groups = (met.filter("suspect").groupBy("sha", text.alias("text"))
              .agg(F.max("rid").alias("stays"), F.count("*").alias("n")).filter("n > 1").select("sha", "stays", "n"))
    groups = scratch.keep(groups, "groups")
    some = met.filter("suspect").join(groups, "sha", "left").select(
        "row", F.coalesce("n", F.lit(1)).alias("group_size"), F.coalesce("stays", "rid").alias("stays"), "rid", "sha")
    alone = met.filter("not suspect").select("row", F.lit(1).cast("long").alias("group_size"),
                                             F.col("rid").alias("stays"), "rid", "sha")
    return some.unionByName(alone)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null counts as the empty text.  Of equal texts the row with the largest
    doc_id stays; null ids are smaller than any.  Where that id occurs on
    several of the rows, one of them stays.  Other columns are ignored; an
    empty table gives an empty result.
    """
    found = _grouped(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    return found.select(F.col("rid.doc_id").alias("doc_id"), F.col("stays.doc_id").alias("keep_id"), "group_size",
                        F.col("stays").eqNullSafe(F.col("rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    return _grouped(docs, id_col, text_col).filter(F.col("stays").eqNullSafe(F.col("rid"))).select("row.*")


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query("op1_golomb_exact_dedup", ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
