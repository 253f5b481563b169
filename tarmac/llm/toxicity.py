"""Toxicity: a string subsequence kernel SVM with Nyström landmarks.

The kernel counts the common subsequences of ``ORDER`` characters of two
strings, each weighed by DECAY for every character that its two occurrences
span.  An insult with characters put in between, or dropped, still shares most
subsequences with the plain one, at a discount.

Landmarks are short character strings that occur far more often in toxic than
in other training sentences (documents of ``labels``).  A segment of a text (a
word, its letters alone if other characters stand between them, or a run of
short scraps, alone and with the word before or after it) is compared with every
landmark, the text keeps its best match to each (``FLOOR`` lies below a word with
a character dropped, replaced or put in everywhere), and the Nyström map K^(-1/2) of the landmarks'
own kernel matrix turns the matches into coordinates in which the kernel is a
dot product.  A linear SVM (squared hinge) is fitted there, and its margin
becomes a score by a logistic fit.

Nothing but the text enters a score.  The classifier is fitted on at most about
``SAMPLE`` labelled training rows, chosen by a hash of their id; every row and
whole text is scored.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, table
from .registry import query

FOLDS = 5
SAMPLE = 8000
LANDMARKS = 64
LENGTHS = (5, 6, 7, 8)
ORDER, DECAY, FLOOR = 4, 0.8, 0.25
#: a landmark this similar to a better one is left out
SIMILAR = 0.45
#: log likelihood ratio that a landmark needs: millions of strings are tried
EVIDENCE = 30.0
#: strings among which landmarks are chosen, and toxic texts that a landmark has to cover for the first time
CANDIDATES, FRESH = 1500, 3
#: marks the start of a word, as one more character
START = "\x02"
#: a segment's longer rest is compared in overlapping windows of this length
WINDOW = 24
#: words whose matches a task remembers before it starts anew
HELD_WORDS = 400_000
#: pairs of a segment and a landmark that are compared at once
PAIRS = 8192
#: no character
_NO_CODE = 0xFFFFFFFF
#: a word's letters with something else between them
_BETWEEN = re.compile(r"[^\W\d_][\W\d_]+[^\W\d_]")
_NO_LETTERS = re.compile(r"[\W\d_]+")


def kernel(a: str, landmarks: list[str]) -> np.ndarray:
    """Kernel of one string with each landmark (all landmarks at once, position by position of ``a``)."""
    width = max(map(len, landmarks))
    t = np.array([[ord(c) for c in m.ljust(width, "\0")] for m in landmarks])
    n = len(landmarks)
    # inner[p][:, j]: subsequences of p characters of a's prefix and the landmark's first j, weighed to their ends
    inner = [np.ones((n, width + 1))] + [np.zeros((n, width + 1)) for _ in range(ORDER - 1)]
    total = np.zeros(n)
    for c in map(ord, a):
        same = t == c
        total += DECAY ** 2 * (inner[ORDER - 1][:, :-1] * same).sum(1)
        for p in range(ORDER - 1, 0, -1):
            row = np.zeros((n, width + 1))
            fresh = DECAY ** 2 * inner[p - 1][:, :-1] * same
            for j in range(width):
                row[:, j + 1] = DECAY * row[:, j] + fresh[:, j]
            inner[p] = DECAY * inner[p] + row
    return total


def _codes(strings: list[str], pad: int) -> np.ndarray:
    """Code points of strings, one row each, filled up with ``pad``."""
    width = max(map(len, strings))
    out = np.full((len(strings), width), pad, dtype=np.uint32)
    raw = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    out[np.arange(width)[None, :] < size[:, None]] = raw
    return out


def kernel_pairs(s: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Kernel of strings and landmarks, row by row, given by their code points (different filling)."""
    n = m.shape[1]
    # a subsequence that ends at the landmark's place i reaches place j > i with one decay for each place between
    reach = np.array([[DECAY ** (j + 1 - i) if j > i else 0.0 for j in range(n + 1)] for i in range(n)], dtype=np.float32)
    inner = [np.ones((len(s), n + 1), dtype=np.float32)]
    inner += [np.zeros((len(s), n + 1), dtype=np.float32) for _ in range(ORDER - 1)]
    total = np.zeros(len(s))
    for i in range(s.shape[1]):
        same = s[:, i:i + 1] == m
        total += (inner[ORDER - 1][:, :-1] * same).sum(1)
        for p in range(ORDER - 1, 0, -1):
            inner[p] *= np.float32(DECAY)
            inner[p] += (inner[p - 1][:, :-1] * same) @ reach
    return total * DECAY ** 2


def kernel_many(strings: list[str], m: str) -> np.ndarray:
    """Kernel of many strings with one landmark (all strings at once)."""
    return kernel_pairs(_codes(strings, 0), np.repeat(_codes([m], _NO_CODE), len(strings), axis=0))


def segments(text: str) -> set[str]:
    """Distinct words of three or more characters, also without what stands between their letters, and runs of shorter
    scraps joined together: three or more alone, any with the word before and with the word after."""
    words = text.split()
    out = {w for w in words if len(w) > 2}
    run, before = [], ""
    for w in [*words, ""]:
        if 0 < len(w) < 3:
            run.append(w)
            continue
        if run:
            joined = "".join(run)
            if len(run) > 2:
                out.add(joined)
            out.update(x for x in (before and before + joined, w and joined + w) if x)
            run = []
        before = w
    out.update(x for x in [_NO_LETTERS.sub("", w) for w in out if not w.isalpha() and _BETWEEN.search(w)] if len(x) > 2)
    for w in [w for w in out if len(w) > WINDOW]:
        out.remove(w)
        out.update(w[i:i + WINDOW] for i in range(0, len(w) - WINDOW // 2, WINDOW // 2))
    return out


def _masks(strings: list[str]) -> np.ndarray:
    """One bit for each letter (modulo 64) that a string holds."""
    raw = np.frombuffer("\0".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(x) + 1 for x in strings])
    bits = np.where(raw == 0, np.uint64(0), np.uint64(1) << (raw.astype(np.uint64) & np.uint64(63)))
    return np.bitwise_or.reduceat(np.concatenate((bits, [np.uint64(0)])), np.concatenate(([0], ends[:-1])))


def _pairs(strings: list[str], reach: int) -> np.ndarray:
    """One bit for each ordered pair of letters (modulo 64) at most ``reach`` places apart."""
    raw = np.frombuffer("\0".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(x) + 1 for x in strings])
    bits = np.zeros(len(raw) + 1, dtype=np.uint64)
    apart = raw == 0   # no pair reaches over the end of a string
    for d in range(1, reach + 1):
        one = np.uint64(1) << ((raw[:-d] * np.uint64(37) + raw[d:] * np.uint64(11)) & np.uint64(63))
        broken = np.zeros(len(one), dtype=bool)
        for k in range(d + 1):
            broken |= apart[k:len(apart) - d + k]
        bits[:len(one)] |= np.where(broken, np.uint64(0), one)
    return np.bitwise_or.reduceat(bits, np.concatenate(([0], ends[:-1])))


class Matcher:
    """A text's best match to every landmark, between 0 and 1.

    A segment that lacks more than one of a landmark's letters, or half of its
    neighbouring letter pairs within three places, does not match it.
    """

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.own = np.array([kernel(m, [m])[0] for m in landmarks])
        self.mask = _masks(landmarks) if landmarks else np.empty(0, dtype=np.uint64)
        self.letters = np.bitwise_count(self.mask)
        self.pairs = _pairs(landmarks, 1) if landmarks else np.empty(0, dtype=np.uint64)
        self.half = np.bitwise_count(self.pairs) // 2
        self.codes = _codes(landmarks, _NO_CODE) if landmarks else np.empty((0, 0), dtype=np.uint32)
        self.known: set[str] = set()        # segments that were compared
        self.matched: dict[str, list] = {}   # those that match: (landmark, value) pairs

    def _learn(self, names: list[str]) -> None:
        """Compare new segments with the landmarks."""
        marked = [START + x for x in names]
        masks, pairs = _masks(marked), _pairs(marked, 3)
        at = [np.flatnonzero((np.bitwise_count(masks & self.mask[j]) >= self.letters[j] - 1)
                             & (np.bitwise_count(pairs & self.pairs[j]) > self.half[j])) for j in range(len(self.landmarks))]
        seg = np.concatenate(at)
        landmark = np.repeat(np.arange(len(at)), [len(x) for x in at])
        size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        start = np.cumsum(size) - size
        raw = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        order = np.argsort(size[seg], kind="stable")   # pairs of similar length together
        seg, landmark = seg[order], landmark[order]
        for lo in range(0, len(seg), PAIRS):
            k, j = seg[lo:lo + PAIRS], landmark[lo:lo + PAIRS]
            place = np.arange(size[k].max())[None, :]
            s = np.where(place < size[k][:, None], raw[np.minimum(start[k][:, None] + place, len(raw) - 1)], 0)
            near = np.minimum(kernel_pairs(s, self.codes[j]) / self.own[j], 1)
            for x, y, v in zip(k[near > FLOOR].tolist(), j[near > FLOOR].tolist(), near[near > FLOOR].tolist()):
                self.matched.setdefault(names[x], []).append((y, (v - FLOOR) / (1 - FLOOR)))
        self.known.update(names)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """(texts, landmarks): the largest match among a text's segments."""
        out = np.zeros((len(texts), len(self.landmarks)))
        if not self.landmarks:
            return out
        parts = [segments((text or "").lower()) for text in texts]
        if len(self.known) > HELD_WORDS:
            self.known.clear()
            self.matched.clear()
        new = set().union(*parts) - self.known
        if new:
            self._learn(sorted(new))
        for i, part in enumerate(parts):
            for s in part & self.matched.keys():
                for j, x in self.matched[s]:
                    out[i, j] = max(out[i, j], x)
        return out


def _parts(s: str) -> set[str]:
    """Character strings of one marked segment that may become landmarks."""
    return {s[i:i + n] for n in LENGTHS for i in range(len(s) - n + 1) if s[i:i + n].lstrip(START).isalpha()}


def pick_landmarks(sample: DataFrame) -> list[str]:
    """Character strings that tell toxic sentences of ``sample(text, toxic)`` from others, best first.

    Per string, document frequencies in both classes; their log likelihood
    ratio makes candidates.  They are taken by the number of toxic texts in
    which they stand in a word without a landmark, while there are ``FRESH``
    of these: forms of one word don't crowd out other words.  A string that the kernel finds similar to a landmark adds nothing.
    """
    def strings(frames):
        for pdf in frames:
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                found = set().union(*(_parts(START + x) for x in segments((text or "").lower())))
                yield pd.DataFrame({"s": list(found), "toxic": int(toxic)}) if found else pd.DataFrame(
                    {"s": pd.Series([], dtype=str), "toxic": pd.Series([], dtype=int)})

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return []
    counts = sample.mapInPandas(strings, "s string, toxic int").groupBy("s").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b, n = F.col("a"), F.col("b"), bad + good
    ratio = 2 * (part(a, (a + b) * bad / n) + part(b, (a + b) * good / n)
                 + part(bad - a, (n - a - b) * bad / n) + part(good - b, (n - a - b) * good / n))
    best = (counts.filter((a >= 3) & (a * good > b * bad)).withColumn("g", F.round(ratio * F.log(F.length("s")), 6))
            .filter(ratio > EVIDENCE).orderBy(F.col("g").desc(), "s").limit(CANDIDATES).collect())
    number = {r["s"]: i for i, r in enumerate(best)}

    def found(text):
        """(segment, numbers of the candidates that it holds) of a text."""
        hits = ((x, sorted({number[s] for s in _parts(START + x) if s in number})) for x in sorted(segments((text or "").lower())))
        return [(x, at) for x, at in hits if at]

    # bounded by the sample: its toxic texts' segments that hold a candidate
    words = (sample.filter("toxic = 1").select(F.monotonically_increasing_id().alias("row"), "text").mapInPandas(
        lambda frames: ((pd.DataFrame({"row": r, "seg": [x for x, _ in hits], "at": [y for _, y in hits]})
                         for pdf in frames for r, hits in zip(pdf["row"], map(found, pdf["text"])) if hits)),
        "row long, seg string, at array<int>").collect() if best else [])
    segs = {x: i for i, x in enumerate(dict.fromkeys(r["seg"] for r in words))}
    rows = {x: i for i, x in enumerate(dict.fromkeys(r["row"] for r in words))}
    holds, stands = np.zeros((len(best), len(segs)), dtype=np.float32), np.zeros((len(segs), len(rows)), dtype=np.float32)
    for r in words:
        holds[r["at"], segs[r["seg"]]] = 1
        stands[segs[r["seg"]], rows[r["row"]]] = 1
    others = np.array([r["b"] for r in best], dtype=float)
    size = np.log(np.array([len(r["s"]) for r in best], dtype=float)) if best else others
    free, left = np.ones(len(segs), dtype=bool), np.ones(len(best), dtype=bool)
    chosen: list[str] = []
    own: list[float] = []
    fresh = (holds @ stands > 0).sum(axis=1)
    while len(chosen) < LANDMARKS and left.any():
        gain = np.where(left & (fresh >= FRESH), fresh * np.log(np.maximum(fresh, 1) / bad * good / (others + 0.5)) * size, 0.0)
        i = int(gain.argmax())
        if gain[i] <= 0:
            break
        left[i] = False
        s = best[i]["s"]
        k = kernel(s, [*chosen, s])
        if not any(x > SIMILAR * min(o, k[-1]) for x, o in zip(k, own)):
            chosen.append(s)
            own.append(k[-1])
            free &= holds[i] == 0
            fresh = (holds[:, free] @ stands[free] > 0).sum(axis=1)
    return chosen


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights and bias (last) of a linear SVM with squared hinge loss, by Newton steps; classes weigh the same."""
    z = np.hstack([x, np.ones((len(x), 1))])
    t = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y <= 0).sum())))
    ridge = np.eye(z.shape[1]) * (1 / c)
    ridge[-1, -1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        active = t * (z @ w) < 1
        za = z[active] * weight[active][:, None]
        new = np.linalg.solve(ridge + za.T @ z[active], za.T @ t[active])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def fit_logistic(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(slope, offset) of P(toxic) = 1 / (1 + exp(-(slope * margin + offset))), with Platt's smoothed targets."""
    n1, n0 = float((y > 0).sum()), float((y <= 0).sum())
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), z.T @ (t - p) - 1e-6 * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(sample: DataFrame) -> dict:
    """Model from ``sample(text, toxic)``: landmarks, Nyström map, SVM weights, logistic fit."""
    landmarks = pick_landmarks(sample)

    def run(frames):
        m = Matcher(landmarks)
        for pdf in frames:
            yield pd.DataFrame({"x": list(m.features(list(pdf["text"]))), "toxic": pdf["toxic"]})

    rows = sample.mapInPandas(run, "x array<double>, toxic int").collect() if landmarks else []   # bounded by SAMPLE
    if not rows:
        n = sample.agg(F.avg("toxic").alias("p")).first()["p"]
        return {"landmarks": [], "w": np.zeros(1), "map": np.zeros((0, 0)), "fit": (0.0, _logit(n or 0.0))}
    rows.sort(key=lambda r: (r["toxic"], r["x"]))   # the same sums whatever order the tasks ended in
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows])
    own = np.array([kernel(m, [m])[0] for m in landmarks])
    k = np.array([kernel(m, landmarks) for m in landmarks]) / np.sqrt(own[:, None] * own[None, :])
    value, vector = np.linalg.eigh((k + k.T) / 2)
    nystroem = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    w = fit_svm(x @ nystroem, y)
    margin = np.hstack([x @ nystroem, np.ones((len(x), 1))]) @ w
    return {"landmarks": landmarks, "w": w, "map": nystroem, "fit": fit_logistic(margin, y)}


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most about SAMPLE labelled rows outside the held-out fold, chosen by a hash of their id."""
    known = (labels.filter("toxic is not null and doc_id is not null")
             .filter(fold_of(F.col("doc_id"), FOLDS) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = known.count()
    if n > SAMPLE:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)) < int(SAMPLE / n * (1 << 30)))
    return docs.select("doc_id", "text").join(known, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def score(docs: DataFrame, sample: DataFrame, keep: list[str], score_col: str = "score",
          predicted_col: str = "predicted") -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, and score and predicted, from the column ``text``.

    A null or empty text is scored like any other: it matches no landmark.
    Repeats and null ids stay as they are.  Without toxic and other training
    rows every score is their share of toxic ones (0 if there are none).  An
    empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(sample))

    def run(frames):
        m = model.value
        match = Matcher(m["landmarks"])
        slope, offset = m["fit"]
        for pdf in frames:
            margins = []
            for at in range(0, len(pdf), 512):   # a few texts at a time: memory does not follow the batch
                x = match.features(list(pdf["text"].iloc[at:at + 512])) @ m["map"]
                margins.append(x @ m["w"][:-1] + m["w"][-1])
            z = slope * np.concatenate(margins) + offset if margins else np.empty(0)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pdf[keep].assign(**{score_col: p, predicted_col: (p >= 0.5).astype(np.int32)})

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", {score_col} double, {predicted_col} int"
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInPandas(run, schema)


@query("op5_string_kernel_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.select("doc_id", "text", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"))
    return score(rows, training_rows(docs, labels), ["doc_id", "held_out"])
