"""Language identification: bit-sliced Bloom filters of n-grams.

Training counts the letter n-grams (lengths 1 to 3, word edges marked) of all
training texts per language.  An n-gram belongs to a language if it makes up at
least ``SHARE`` of the language's n-grams and at least ``RELATIVE`` of its share
in the language that uses it most.  Since shares add up to one, a language has
at most 3 / SHARE of them, which bounds the filter by the number of languages
and not by the corpus.

The filters of all languages are one array: cell i holds one bit per language.
Reading the cells that an n-gram hashes to and AND-ing them gives the languages
that contain it in one go.  A language's popcount over a text's n-grams is
corrected for the chance that a cell combination is set by accident, and the
largest corrected share decides.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, table
from .npwords import mix
from .registry import query

FOLDS = 5
SHARE, RELATIVE = 2e-5, 0.5
HASHES, CELLS_EACH = 3, 12
#: texts are handled in slices of so many characters, so that memory does not follow a text's length
SLICE = 1 << 20
_EDGE = np.uint64(0x1FFFFF)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, 1 if it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> np.ndarray:
    """n-gram codes of a text's lower-case letters; any other character is a word edge."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, dtype=np.uint64)
    c = np.where(letter, points.astype(np.uint64), _EDGE)
    c = np.concatenate(([_EDGE], c, [_EDGE]))
    inside = np.concatenate(([False], letter, [False]))
    one = c[inside]
    two = (c[:-1] << np.uint64(21) | c[1:])[inside[:-1] | inside[1:]] | np.uint64(1 << 63)
    three = (c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:])[inside[1:-1]]
    return np.concatenate((one, two, three))


def _slices(text: str):
    for at in range(0, len(text), SLICE):
        yield text[at:at + SLICE]


def _count(frames):
    """Partial counts of (lang, gram), one set per slice of a batch's texts."""
    for pdf in frames:
        for lang, part in pdf.groupby("lang"):
            held, size = [], 0
            for text in part["text"]:
                for s in _slices(text):
                    held.append(grams(s))
                    size += len(s)
                    if size >= 2 * SLICE:
                        yield _tally(lang, held)
                        held, size = [], 0
            if held:
                yield _tally(lang, held)


def _tally(lang: str, held: list[np.ndarray]) -> pd.DataFrame:
    gram, n = np.unique(np.concatenate(held), return_counts=True)
    return pd.DataFrame({"lang": lang, "gram": gram.astype(np.int64), "n": n})


def learn(training: DataFrame) -> tuple[list[str], list[tuple[int, list[int]]]]:
    """(languages, [(n-gram, languages that contain it)]) from ``training(text, lang)``."""
    counts = (training.filter("text is not null and lang is not null").mapInPandas(
        _count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(total, "lang").withColumn("share", F.col("n") / F.col("total"))
    frequent = share.filter(F.col("share") >= SHARE)
    by_gram = frequent.groupBy("gram").agg(F.max("share").alias("most"), F.collect_list(F.struct("lang", "share"))
                                           .alias("langs"))
    kept = by_gram.select("gram", F.transform(F.filter("langs", lambda x: x["share"] >= RELATIVE * F.col("most")),
                                              lambda x: x["lang"]).alias("langs"))
    rows = kept.collect()   # at most 3 / SHARE n-grams a language
    langs = sorted({x for r in rows for x in r["langs"]})
    return langs, sorted((r["gram"], [langs.index(x) for x in r["langs"]]) for r in rows)


class BitSliced:
    """One Bloom filter per language, side by side in the bits of each cell."""

    def __init__(self, langs: list[str], members: list[tuple[int, list[int]]]):
        self.langs = langs
        most = max([1, *np.bincount([i for _, ls in members for i in ls]).tolist()]) if members else 1
        self.size = 1 << max(10, int(CELLS_EACH * most - 1).bit_length())
        self.cells = np.zeros((-(-max(1, len(langs)) // 64), self.size), dtype=np.uint64)
        codes = np.array([g for g, _ in members], dtype=np.int64).view(np.uint64)
        masks = np.zeros((len(self.cells), len(members)), dtype=np.uint64)
        for m, (_, ls) in enumerate(members):
            for i in ls:
                masks[i // 64, m] |= np.uint64(1) << np.uint64(i % 64)
        for place in self._places(codes):
            for row, mask in zip(self.cells, masks):
                np.bitwise_or.at(row, place, mask)
        fill = [((self.cells[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))]
        self.chance = np.array(fill) ** HASHES   # of an n-gram that is not in the language

    def _places(self, codes: np.ndarray):
        for salt in mix(np.arange(1, HASHES + 1, dtype=np.uint64)):
            yield (mix(codes ^ salt) & np.uint64(self.size - 1)).astype(np.int64)

    def counts(self, codes: np.ndarray) -> np.ndarray:
        """Per language, how many of the n-grams its filter contains."""
        found = [np.full(len(codes), ~np.uint64(0)) for _ in self.cells]
        for place in self._places(codes):
            found = [f & row[place] for f, row in zip(found, self.cells)]
        return np.array([int(((found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).sum())
                         for i in range(len(self.langs))], dtype=np.float64)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is the winner's part of all corrected shares."""
        hits, n = np.zeros(len(self.langs)), 0
        for s in _slices(text or ""):
            g = grams(s)
            if len(g):
                hits += self.counts(g)
                n += len(g)
        if not n or not self.langs:
            return "und", 0.0
        share = np.clip((hits / n - self.chance) / (1 - self.chance), 0, None)
        best = int(share.argmax())   # ties: the first language in code point order
        return self.langs[best], float(share[best] / share.sum()) if share.sum() else 0.0


def identify(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score.

    ``training(text, lang)``; rows where either is null teach nothing.  A text
    that is null or has no letter, and any text if nothing was learned, gets
    ``und`` and score 0.  Repeats and null ids stay as they are; other columns
    are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learn(training))

    def run(frames):
        f = BitSliced(*model.value)
        for pdf in frames:
            found = [f.predict(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"],
                                "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       (fold_of(F.col(id_col), FOLDS) == 0).alias("held_out"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")


@query("op6_bloom_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, docs.filter(fold_of(F.col("doc_id"), FOLDS) != 0).select("text", "lang"))
