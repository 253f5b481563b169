"""Near-duplicate documents: multi-index Hamming join over b-bit MinHash signatures.

A document's shingle set is turned into a signature of ``CHUNKS * WIDTH``
MinHash values of 16 bits.  The signature distance of two documents is the
number of places where the values differ; at similarity 0.75 about a quarter
differ.  The signature is split into ``CHUNKS`` chunks.  If two signatures
differ in at most ``CHUNKS * (ERRORS + 1) - 1`` places, some chunk differs in
at most ``ERRORS`` places (pigeonhole), so writing each chunk once for every
choice of ``ERRORS`` places left out brings every such pair together in a
bucket.  With 16 chunks of 4 and one error that is distance 31 of 64, 4.5
standard deviations above the mean at similarity 0.75.  Candidates at a larger
distance are dropped, and so are those whose one-permutation sketches are 4.5
standard deviations too different; the others are confirmed on their full
shingle sets.

Identical word sequences are one class before any join.  Buckets are compared
through their smallest member, then through drawn ones (``bucket_components``),
so large groups make no pairs; in the last round, across components, a pair is
made in the first bucket that it shares only.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bucket_components, table
from .npwords import mix, word_hashes
from .registry import query

SHINGLE, PER_CENT = 5, 75
CHUNKS, WIDTH, ERRORS = 16, 4, 1
PLACES = CHUNKS * WIDTH
MOST = CHUNKS * (ERRORS + 1) - 1
#: bins of the one-permutation sketch, and the bits that it keeps of a bin's value
BINS, BIN_BITS = 512, 4
#: star rounds before the pairs across components: the first with the smallest member, the other with drawn ones
ROUNDS = 2
_LEFT = list(itertools.combinations(range(WIDTH), WIDTH - ERRORS))


def _constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_MUL, _ADD, _KEY, _STEP = (_constants(PLACES, 1), _constants(PLACES, 2), _constants(PLACES * len(_LEFT), 3),
                           _constants(SHINGLE, 4))


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Distinct shingle hashes of each text; fewer than ``size`` words make one shingle."""
    n = len(hashes)
    padded = np.concatenate((hashes, np.zeros(size - 1, dtype=np.uint64)))
    rolled = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        rolled += mix(padded[j:n + j] ^ _STEP[j]) * _STEP[j]
    rolled = mix(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= size:
            out.append(np.unique(rolled[at:at + c - size + 1]))
        elif c:
            short = np.array([c], dtype=np.uint64)
            for i in range(at, at + c):
                short = mix(short * _STEP[0] + hashes[i:i + 1])
            out.append(short)
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += c
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, PLACES) 16-bit MinHash values; all zero for an empty set."""
    sig = np.zeros((len(sets), PLACES), dtype=np.uint16)
    rows = [i for i, s in enumerate(sets) if len(s)]
    if rows:
        flat = np.concatenate([sets[i] for i in rows])
        starts = np.cumsum([0] + [len(sets[i]) for i in rows[:-1]])
        for p in range(PLACES):
            least = np.minimum.reduceat(flat * _MUL[p] + _ADD[p], starts)
            sig[rows, p] = (mix(least) >> np.uint64(48)).astype(np.uint16)
    return sig


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    """(texts, CHUNKS * choices) 64-bit keys: each chunk with every choice of ERRORS places left out.

    The lowest six bits are the key's number: chunk times four plus the choice.
    """
    wide = sig.astype(np.uint64)
    keys, k = [], 0
    for c in range(CHUNKS):
        for left in _LEFT:
            v = np.full(len(sig), _KEY[k], dtype=np.uint64)
            for place in left:
                v = mix(v * np.uint64(0x9E3779B97F4A7C15) + wide[:, c * WIDTH + place])
            keys.append(v & ~np.uint64(63) | np.uint64(k))
            k += 1
    return np.stack(keys, axis=1).astype(np.int64)


def bit_planes(sig: np.ndarray) -> np.ndarray:
    """(texts, 16) longs; bit i of long b is bit b of value i, so that a distance is a few XORs and one bit count."""
    bits = [np.packbits((sig >> np.uint16(b)) & np.uint16(1), axis=1, bitorder="little") for b in range(16)]
    return np.stack([x.view("<i8")[:, 0] for x in bits], axis=1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, longs) one-permutation sketch: which bins hold a shingle, and some bits of each bin's smallest hash."""
    words = BINS // 64
    out = np.zeros((len(sets), words * (1 + BIN_BITS)), dtype=np.int64)
    for i, x in enumerate(sets):
        if len(x):
            bin_ = (x & np.uint64(BINS - 1)).astype(np.int64)   # x is sorted: a bin's first is its smallest
            held, at = np.unique(bin_, return_index=True)
            value = mix(x[at])
            rows = np.zeros((1 + BIN_BITS, BINS), dtype=np.uint8)
            rows[0, held] = 1
            for b in range(BIN_BITS):
                rows[1 + b, held] = (value >> np.uint64(b)).astype(np.uint8) & 1
            out[i] = np.packbits(rows, axis=1, bitorder="little").view("<i8").ravel()
    return out


def _differ(a: str, b: str, planes: int = 16) -> Column:
    """64 bits: the places in which two signatures differ (fewer planes miss a few)."""
    return reduce(Column.bitwiseOR, [F.col(a)[i].bitwiseXOR(F.col(b)[i]) for i in range(planes)])


def _alike(a: str, b: str, m: Column, n: Column) -> Column:
    """Whether two sketches may belong to sets (of m and n shingles) that are similar enough.

    The occupied bins are a sample without replacement from the union, which
    has (m + n) / 1.75 shingles at similarity 0.75; the shares that such a
    sample shows lie within 4.5 standard deviations.
    """
    words = BINS // 64
    equal, either = [], []
    for w in range(words):
        x, y = F.col(a)[w], F.col(b)[w]
        unlike = reduce(Column.bitwiseOR, [F.col(a)[w + words * (1 + k)].bitwiseXOR(F.col(b)[w + words * (1 + k)])
                                           for k in range(BIN_BITS)])
        equal.append(F.bit_count(x.bitwiseAND(y).bitwiseAND(F.bitwise_not(unlike))))
        either.append(F.bit_count(x.bitwiseOR(y)))
    same, held = reduce(Column.__add__, equal), reduce(Column.__add__, either)
    share = PER_CENT / 100
    left_out = F.greatest(1 - held * (1 + share) / (m + n), F.lit(0.0))
    return same + 4.5 * F.sqrt(share * (1 - share) * held * left_out) + 1 >= share * held


def _first_bucket(key: str, differ: Column) -> Column:
    """Whether the bucket ``key`` is the first one that a pair with these differing places shares."""
    nibble = F.lit(0x1111111111111111)
    return F.exists(F.array(differ), lambda d: _is_first(F.bitwise_not(d), nibble, F.col(key)))


def _is_first(same: Column, nibble: Column, key: Column) -> Column:
    b = [F.shiftrightunsigned(same, i).bitwiseAND(nibble) for i in range(WIDTH)]
    three = (b[0].bitwiseAND(b[1]).bitwiseAND(b[2].bitwiseOR(b[3]))).bitwiseOR(
        b[2].bitwiseAND(b[3]).bitwiseAND(b[0].bitwiseOR(b[1])))
    number = key.bitwiseAND(F.lit(63)).cast("int")
    chunk, choice = F.floor(number / 4).cast("int"), number % 4
    lowest = F.bit_count(three.bitwiseXOR(three - 1)) - 1      # 64 places: the number of the lowest set bit
    whole = F.getbit(b[0].bitwiseAND(b[1]).bitwiseAND(b[2]).bitwiseAND(b[3]), lowest) == 1
    return (lowest == chunk * 4) & (~whole | (choice == 0))


def _plain(text: str | None) -> bytes:
    """Words joined by one space, A-Z lower-cased: bytes.split and bytes.lower know ASCII only."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def _class(plain: bytes) -> bytes:
    return hashlib.sha256(plain).digest()[:16]


def _classes(frames):
    """The row's columns and cls."""
    for pdf in frames:
        yield pdf.drop(columns="text").assign(cls=[_class(_plain(t)) for t in pdf["text"]])


def _sign(frames):
    for pdf in frames:
        plain = [_plain(t) for t in pdf["text"]]
        sizes, planes, sketch = [], [], []
        for at in range(0, len(plain), 512):
            sets = shingle_hashes(*word_hashes(plain[at:at + 512]))
            sizes += [len(s) for s in sets]
            planes += list(bit_planes(signatures(sets)))
            sketch += list(sketches(sets))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "cls": [_class(p) for p in plain], "n_shingles": sizes,
                            "sig": planes, "sketch": sketch, "text": [p.decode("utf-8", "replace") for p in plain]})


def _keys(frames):
    """(cls, keys) of classes with shingles; the signature's values are read back from its planes."""
    for pdf in frames:
        pdf = pdf[pdf["n_shingles"] > 0]
        if len(pdf):
            planes = np.stack(pdf["sig"].to_numpy()).astype("<i8")
            sig = np.zeros((len(pdf), PLACES), dtype=np.uint16)
            for b in range(16):
                bits = np.unpackbits(np.ascontiguousarray(planes[:, b]).view(np.uint8).reshape(-1, 8), axis=1,
                                     bitorder="little")
                sig |= bits.astype(np.uint16) << np.uint16(b)
            yield pd.DataFrame({"cls": pdf["cls"], "keys": list(bucket_keys(sig))})


def _set(text: str) -> set:
    words = text.split(" ") if text else []
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _confirm(frames):
    """Keep pairs whose full shingle sets are similar enough.

    Equal shingles have equal hashes, so a pair with too few equal hashes can
    be left out; the others are compared shingle by shingle.
    """
    def enough(shared, m, n):
        return 100 * shared >= PER_CENT * (m + n - shared)

    for pdf in frames:
        ok = np.zeros(len(pdf), dtype=bool)
        pdf = pdf.reset_index(drop=True)
        for _, part in pdf.groupby("u", sort=False):
            texts = [part["text_u"].iloc[0], *part["text_v"]]
            for at in range(1, len(texts), 256):
                some = [texts[0], *texts[at:at + 256]]
                sets = shingle_hashes(*word_hashes([t.encode() for t in some]))
                full = None
                for k, h in enumerate(sets[1:]):
                    near = int((sets[0][np.minimum(np.searchsorted(sets[0], h), len(sets[0]) - 1)] == h).sum())
                    if enough(near, len(sets[0]), len(h)):
                        full = full if full is not None else _set(some[0])
                        other = _set(some[k + 1])
                        ok[part.index[at - 1 + k]] = enough(len(full & other), len(full), len(other))
        yield pdf.loc[ok, ["u", "v"]]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null and blank texts have an empty set and link with nothing, not even
    with each other.  Rows that repeat a doc_id are returned as often as they
    occur; equal word sequences are always one component.  A row whose doc_id
    is null takes part and gets the component of its copies; its own
    component_id is null if only null ids are in it, and it is kept only then.
    An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with_class = rows.mapInPandas(_classes, "doc_id long, cls binary")
    return _decided(with_class, _components(rows)).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kind = whole.schema["row"].dataType.simpleString()
    found = _decided(whole.mapInPandas(_classes, f"doc_id long, row {kind}, cls binary"), _components(rows))
    return found.filter("kept").select("row.*")


def _decided(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """``rows(doc_id, cls, ...)`` with n_shingles, component_id and kept."""
    alone = F.col("n_shingles") == 0
    return (rows.join(placed, "cls", "left")
            .withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
            .withColumn("kept", alone | F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _components(rows: DataFrame) -> DataFrame:
    """(cls, n_shingles, component_id) of ``rows(doc_id, text)``.

    The classes are written once, bucketed by class: one shuffle of the texts,
    in which a copied text is once per map task.  Later joins on the class
    leave the texts where they are.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "near")
    signed = rows.mapInPandas(_sign, "doc_id long, cls binary, n_shingles long, sig array<long>, sketch array<long>, "
                                     "text string")
    by_class = signed.groupBy("cls").agg(F.min("doc_id").alias("least"),
                                         *(F.first(c).alias(c) for c in ("n_shingles", "sig", "sketch", "text")))
    name = f"llm_near_{uuid.uuid4().hex}"
    (by_class.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "cls")
     .option("compression", "zstd").option("path", f"{scratch.base}/classes").saveAsTable(name))
    classes = spark.read.table(name)
    keyed = classes.select("cls", "n_shingles", "sig").mapInPandas(_keys, "cls binary, keys array<long>")
    buckets = keyed.select(F.explode("keys").alias("key"), F.col("cls").alias("id"))
    sigs = classes.select("cls", "sig", "sketch", "n_shingles")

    def paired(pairs: DataFrame, of: DataFrame, *cols: str) -> DataFrame:
        left = of.select(F.col("cls").alias("u"), *(F.col(c).alias(f"{c}_u") for c in cols))
        right = of.select(F.col("cls").alias("v"), *(F.col(c).alias(f"{c}_v") for c in cols))
        return pairs.join(left, "u").join(right, "v")

    def fits(a: str, b: str) -> Column:
        """By size, signature distance and sketch."""
        m, n = F.col(a.format("n_shingles")), F.col(b.format("n_shingles"))
        return ((100 * F.least(m, n) >= PER_CENT * F.greatest(m, n))
                & (F.bit_count(_differ(a.format("sig"), b.format("sig"), 6)) <= MOST)
                & _alike(a.format("sketch"), b.format("sketch"), m, n))

    step = itertools.count()

    def verify(pairs: DataFrame) -> DataFrame:
        near = paired(pairs, sigs, "sig", "sketch", "n_shingles").filter(fits("{}_u", "{}_v"))
        return confirm(near.select("u", "v"))

    def confirm(pairs: DataFrame) -> DataFrame:
        near = scratch.keep(pairs, f"near{next(step)}")
        wanted = near.select(F.explode(F.array("u", "v")).alias("w")).distinct()
        texts = classes.select("cls", "text").join(wanted.hint("shuffle_hash"), F.col("cls") == F.col("w"))
        texts = scratch.keep(texts.select("cls", "text"), f"texts{next(step)}")
        return paired(near, texts, "text").mapInPandas(_confirm, "u binary, v binary")

    def known(placed: DataFrame) -> DataFrame:
        return placed.join(sigs, placed["id"] == sigs["cls"]).select("key", "id", "comp", "sig", "sketch", "n_shingles")

    likely = ((F.col("a.key") == F.col("b.key")) & (F.col("a.comp") != F.col("b.comp")) & fits("a.{}", "b.{}"))

    def residual(placed: DataFrame) -> DataFrame:
        r = known(placed)
        once = (F.col("a.id") < F.col("b.id")) & _first_bucket("a.key", _differ("a.sig", "b.sig"))
        return r.alias("a").join(r.alias("b"), likely & once).select(F.col("a.id").alias("u"), F.col("b.id").alias("v"))

    def drawn(placed: DataFrame, hubs: DataFrame) -> DataFrame:
        pairs = known(placed).alias("a").join(known(hubs).alias("b"), likely)
        return pairs.select(F.least("a.id", "b.id").alias("u"), F.greatest("a.id", "b.id").alias("v"))

    comp = bucket_components(scratch, buckets, verify, residual, "near", rounds=ROUNDS, confirm=confirm, drawn=drawn)
    least = classes.select("cls", "least", "n_shingles")
    rooted = least.join(comp, least["cls"] == comp["node"], "left").select(
        "cls", "least", "n_shingles", F.coalesce("root", "cls").alias("root"))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return scratch.keep(rooted.join(first, "root").select("cls", "n_shingles", "component_id"), "placed")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.u = d.doc_id
"""


@query("op4_minhash_near_dedup", ORACLE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
