"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of order two, one and zero,

    p(w | h) = l2(b) c(h, w) / c(h) + l1(b) c(w) / N + l0(b) / (V + 1),

with weights that depend on the frequency bucket b of the context h.  The
weights are learned by expectation-maximisation over all training tokens, each
with its own occurrence deleted from the counts.

Counts cover the whole corpus and grow with it, so they are never broadcast:
a batch of texts sends its distinct word and word-pair hashes, with its own
training counts, to the owners of hash ranges; an owner adds the counts of all
batches up and answers each with the totals.  A frequent word is one entry per
batch.  Words are told apart by 64 bits.  Pairs are cut to log2(tokens) + 21
bits, so that about one pair in two million shares its count with another.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, fold_of, table
from .npwords import batches, mix, word_hashes
from .registry import query

FOLDS = 10
SMOOTH = 0.1
#: tokens of a batch; longer texts are batches of their own
BATCH_TOKENS = 1 << 19
#: characters of the corpus for each owner of a hash range
OWNER_CHARS = 1 << 24
END, START = np.uint64(0xD1B54A32D192ED03), np.uint64(0xABC98388FB8FAC03)
BUCKETS, BINS = 32, 48


def planes(x: np.ndarray, width: int) -> bytes:
    """Unsigned integers byte by byte, all lowest bytes first: what is mostly small then compresses well."""
    return x.astype("<u8").view(np.uint8).reshape(len(x), 8)[:, :width].T.tobytes()


def from_planes(code: bytes, width: int) -> np.ndarray:
    n = len(code) // width
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(code, dtype=np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def _gaps(x: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate((np.zeros(1, dtype=np.uint64), x)))


def pair_keys(tokens: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    """Hash of each token with the token before it (START before a text's first)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = START
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens) >> np.uint64(64 - bits)


def _token_batches(frames):
    """(ids, folds, tokens with ends, tokens per text) for groups of texts of about BATCH_TOKENS tokens."""
    ids, held, hashes, counts, size = [], [], [], [], 0
    for pdf in frames:
        for first, group in batches(pdf["text"]):
            h, n = word_hashes(group)
            ends = np.cumsum(n)
            hashes.append(np.insert(h, ends, END))
            counts.append(n + 1)
            part = pdf.iloc[first:first + len(group)]
            ids.append(part["doc_id"])
            held.append(part["held_out"].to_numpy(dtype=bool))
            size += len(h) + len(n)
            if size >= BATCH_TOKENS:
                yield pd.concat(ids), np.concatenate(held), np.concatenate(hashes), np.concatenate(counts)
                ids, held, hashes, counts, size = [], [], [], [], 0
    if ids:
        yield pd.concat(ids), np.concatenate(held), np.concatenate(hashes), np.concatenate(counts)


def _owned(keys: np.ndarray, bits: int, owners: int) -> np.ndarray:
    """Where each owner's range of the sorted keys begins, and the end."""
    step = -(-(1 << bits) // owners)
    edges = np.array([min(o * step, (1 << bits) - 1) for o in range(1, owners)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _send(frames, owners: int, bits: int):
    """Per batch: one row with its texts' word places, and one letter for each owner."""
    task, i = TaskContext.get().partitionId(), 0
    for ids, held, tokens, counts in _token_batches(frames):
        batch, i = (task << 24) + i, i + 1
        train = ~np.repeat(held, counts)
        words, place = np.unique(tokens, return_inverse=True)
        first = np.cumsum(counts) - counts
        keys = pair_keys(tokens, first, bits)
        pairs, where = np.unique(keys, return_inverse=True)
        word_n = np.bincount(place[train], minlength=len(words))
        pair_n = np.bincount(where[train], minlength=len(pairs))
        yield pd.DataFrame({"kind": ["texts"], "batch": batch, "owner": -1, "ids": [list(ids)], "held": [held],
                            "counts": [counts], "a": [planes(_gaps(words), 8)], "b": [planes(place, 4)],
                            "c": [b""], "d": [b""]})
        w, p = _owned(words, 64, owners), _owned(pairs, bits, owners)
        yield pd.DataFrame({
            "kind": "letters", "batch": batch, "owner": np.arange(owners), "ids": None, "held": None, "counts": None,
            "a": [planes(_gaps(words[w[o]:w[o + 1]]), 8) for o in range(owners)],
            "b": [planes(word_n[w[o]:w[o + 1]], 4) for o in range(owners)],
            "c": [planes(_gaps(pairs[p[o]:p[o + 1]]), 8) for o in range(owners)],
            "d": [planes(pair_n[p[o]:p[o + 1]], 4) for o in range(owners)]})


def _totals(keys: list[bytes], counts: list[bytes]) -> tuple[list[bytes], int, int]:
    """For each letter the sums over all letters; all occurrences and distinct keys with any."""
    lists = [np.cumsum(from_planes(k, 8), dtype=np.uint64) for k in keys]
    values, place = np.unique(np.concatenate(lists), return_inverse=True)
    n = np.zeros(len(values), dtype=np.int64)
    at = 0
    for x, c in zip(lists, counts):
        n[place[at:at + len(x)]] += from_planes(c, 4).astype(np.int64)   # keys of a letter are distinct
        at += len(x)
    ends = np.cumsum([len(x) for x in lists])
    return [planes(n[place[e - len(x):e]], 5) for x, e in zip(lists, ends)], int(n.sum()), int((n > 0).sum())


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    words, tokens, kinds = _totals(list(pdf["a"]), list(pdf["b"]))
    pairs, _, _ = _totals(list(pdf["c"]), list(pdf["d"]))
    own = pdf["owner"].iloc[0]
    out = pd.DataFrame({"batch": pdf["batch"], "owner": own, "words": words, "pairs": pairs, "tokens": 0, "kinds": 0})
    return pd.concat([out, pd.DataFrame({"batch": [-1], "owner": [own], "words": [b""], "pairs": [b""],
                                         "tokens": [tokens], "kinds": [kinds]})])


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the binary logarithm of its count."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def _bin(ratio: np.ndarray) -> np.ndarray:
    """0 for 0, else a bin of half a binary order of magnitude, 1 for the largest ratios."""
    steps = np.floor(-2 * np.log2(np.maximum(ratio, 1e-300))).astype(np.int64)
    return np.where(ratio > 0, 1 + np.clip(steps, 0, BINS - 2), 0)


def _ratio(b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, 2.0 ** (-(b - 1 + 0.5) / 2), 0.0)


def _before(x: np.ndarray, counts: np.ndarray, start: int) -> np.ndarray:
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[np.cumsum(counts) - counts] = start
    return out


def _meet(texts: pd.DataFrame, answers: pd.DataFrame, bits: int, tokens_n: int, starts: int) -> pd.DataFrame:
    """Counts for every token of a batch, and a histogram of its training tokens' estimates."""
    t = texts.iloc[0]
    answers = answers.sort_values("owner")   # owners hold consecutive ranges of the sorted keys
    word_total = np.concatenate([from_planes(x, 5) for x in answers["words"]]).astype(np.int64)
    pair_total = np.concatenate([from_planes(x, 5) for x in answers["pairs"]]).astype(np.int64)
    words, place = np.cumsum(from_planes(t["a"], 8), dtype=np.uint64), from_planes(t["b"], 4).astype(np.int64)
    counts = np.asarray(t["counts"])
    keys = pair_keys(words[place], np.cumsum(counts) - counts, bits)
    single, both = word_total[place], pair_total[np.unique(keys, return_inverse=True)[1]]
    context = _before(single, counts, starts)
    train = ~np.repeat(np.asarray(t["held"], dtype=bool), counts)
    c, s, p = context[train] - 1, single[train] - 1, both[train] - 1   # the token itself is deleted
    r2 = np.where(c > 0, p / np.maximum(c, 1), 0.0)
    r1 = s / max(1, tokens_n - 1)
    cell, n = np.unique((_bucket(c) * BINS + _bin(r2)) * BINS + _bin(r1), return_counts=True)
    return pd.DataFrame({"ids": [t["ids"]], "held": [t["held"]], "counts": [counts], "single": [planes(single, 5)],
                         "both": [planes(both, 5)], "cell": [cell], "n": [n]})


def learn_weights(cells: np.ndarray, n: np.ndarray, kinds: int, steps: int = 200) -> np.ndarray:
    """(BUCKETS, 3) mixture weights l2, l1, l0 by expectation-maximisation over a histogram.

    ``cells`` are (bucket, bin of the pair estimate, bin of the word estimate).
    Buckets without tokens take the weights of the nearest lower one that has
    some.  Without training tokens the last part has all the weight.
    """
    bucket, b2, b1 = cells // (BINS * BINS), cells // BINS % BINS, cells % BINS
    part = np.stack([_ratio(b2), _ratio(b1), np.full(len(cells), 1 / (kinds + 1))], axis=1)
    weights = np.zeros((BUCKETS, 3))
    last = np.array([0.0, 0.0, 1.0])
    for b in range(BUCKETS):
        mine = bucket == b
        if mine.any():
            w = np.full(3, 1 / 3) if b else np.array([0.0, 0.5, 0.5])
            x, k = part[mine], n[mine].astype(float)
            for _ in range(steps):
                post = w * x
                post *= (k / np.maximum(post.sum(1), 1e-300))[:, None]
                new = post.sum(0) / k.sum()
                if np.abs(new - w).max() < 1e-9:
                    break
                w = new
            last = np.maximum(new, [0, 1e-6, 1e-6])   # nothing is impossible
            last = last / last.sum()
        weights[b] = last
    weights[0] = [0.0, *(weights[0][1:] / weights[0][1:].sum())]   # an unseen context says nothing
    return weights


def _score(frames, weights: np.ndarray, tokens_n: int, kinds: int, starts: int):
    for pdf in frames:
        for r in pdf.itertuples(index=False):
            counts = np.asarray(r.counts)
            single, both = from_planes(r.single, 5).astype(np.int64), from_planes(r.both, 5).astype(np.int64)
            context = _before(single, counts, starts)
            w = weights[np.minimum(_bucket(context), BUCKETS - 1)]
            p = (w[:, 0] * both / np.maximum(context, 1) + w[:, 1] * single / max(1, tokens_n)
                 + w[:, 2] / (kinds + 1))
            base = np.log10((single + SMOOTH) / (tokens_n + SMOOTH * (kinds + 1)))
            first = np.cumsum(counts) - counts
            yield pd.DataFrame({
                "doc_id": pd.array(r.ids, dtype="Int64"), "held_out": np.asarray(r.held, dtype=bool),
                "n_tokens": counts, "n_known": np.add.reduceat((single > 0).astype(np.int64), first),
                "train_tokens": tokens_n, "base_score": np.add.reduceat(base, first),
                "score": np.add.reduceat(np.log10(p), first)})


def scored(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows where the column ``held_out`` is false teach the model.  Null counts
    as the empty text, which has one token, its end.  Repeated rows count as
    often as they occur; null ids stay null.  Without training rows all counts
    are 0 and the model is uniform.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       held_out.alias("held_out"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.count("*").alias("n"),
                    F.coalesce(F.sum((~F.col("held_out")).cast("long")), F.lit(0)).alias("starts")).first()
    bits = min(64, max(24, math.ceil(math.log2(size["chars"] // 4 + size["n"] + 1)) + 21))
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size["chars"] // OWNER_CHARS)
    sent = rows.mapInPandas(
        lambda frames: _send(frames, owners, bits),
        "kind string, batch long, owner long, ids array<long>, held array<boolean>, counts array<long>, "
        "a binary, b binary, c binary, d binary")
    path = f"{scratch.base}/sent"
    sent.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    stored = spark.read.schema(sent.schema).parquet(path)
    answers = scratch.keep(
        stored.filter("kind = 'letters'").select("batch", "owner", "a", "b", "c", "d").groupBy("owner").applyInPandas(
            _answer, "batch long, owner long, words binary, pairs binary, tokens long, kinds long"), "answers")
    scratch.drop("sent/kind=letters")
    facts = answers.filter("batch = -1").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
                                             F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds")).first()
    tokens_n, kinds, starts = facts["tokens"], facts["kinds"], size["starts"]
    met = scratch.keep(
        stored.filter("kind = 'texts'").select("batch", "ids", "held", "counts", "a", "b").groupBy("batch").cogroup(
            answers.filter("batch >= 0").select("batch", "owner", "words", "pairs").groupBy("batch")).applyInPandas(
            lambda t, a: _meet(t, a, bits, tokens_n, starts),
            "ids array<long>, held array<boolean>, counts array<long>, single binary, both binary, cell array<long>, "
            "n array<long>"), "met")
    scratch.drop("sent")
    cells = (met.select(F.explode(F.arrays_zip("cell", "n")).alias("x")).groupBy("x.cell")
             .agg(F.sum("x.n").alias("n")).collect())   # at most BUCKETS * BINS * BINS cells
    cells.sort()
    weights = learn_weights(np.array([c["cell"] for c in cells], dtype=np.int64), np.array([c["n"] for c in cells]),
                            kinds)
    return met.select("ids", "held", "counts", "single", "both").mapInPandas(
        lambda frames: _score(frames, weights, tokens_n, kinds, starts),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double")


@query("op8_deleted_interpolation")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), FOLDS) == 0)
