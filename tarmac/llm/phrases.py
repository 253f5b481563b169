"""Phrase collocations counted by broadcast double-array tries.

Words are 64-bit symbols (a digest of language and word; a table of all words
shows that no two share one, otherwise another seed is taken).  Candidates grow
level by level, and a level reads the texts once:

1. Word counts by shuffle.  Only phrases of frequent words can be frequent.
2. Buckets of a digest count pairs of two frequent words, then triples of
   two frequent pairs.  A bucket's count is never below a phrase's, so phrases
   in rare buckets are out and all others are candidates.  Which symbols, pairs
   and triples passed is told to the tasks by bit sets of bounded size: wrong
   bits let more phrases through, never fewer.
3. The candidates, met once more in the texts, are built into double-array tries
   (one per shard of some 2^18 candidates, in parallel) and broadcast, if all of
   them together stay below ``TRIE_BYTES``.  A word is two steps by the digits of
   its code, which leaves few places empty.  Numpy advances the states of all text
   positions at once and counts accepting states; slices and shards are summed.

Beyond ``TRIE_BYTES`` the candidates' occurrences are summed by a shuffle on
the phrase instead.  Counts, and so results, are the same.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table
from .npwords import _LOWER, _power, mix
from .registry import query

MIN_COUNT, INSIDE, TOP = 10, 50, 2000
#: bytes of text that are worked on at once
SLICE = 1 << 19
#: buckets that a task sums before it passes them on
KEYS_HELD = 1 << 21
#: bit sets take 16 bits per entry, within these bounds (8 MB at most)
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26
SHARD = 1 << 18
#: bytes of tries that are broadcast at most
TRIE_BYTES = 64 << 20

_WORD, _BLANK, _STOP = 0, 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = _STOP
_K = np.uint64(0xD6E8FEB86659FD93)


def pair_key(s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
    return mix(s1 * _K ^ mix(s2))


def triple_key(s1: np.ndarray, s2: np.ndarray, s3: np.ndarray) -> np.ndarray:
    return mix(pair_key(s1, s2) * _K ^ mix(s3))


# ---- words of Arrow batches

def _buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the texts) of an Arrow string column without nulls, not copied."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw, offsets.astype(np.int64)


def _slice_end(raw: np.ndarray, at: int, stop: int, starts: np.ndarray) -> int:
    """First place from ``at`` on where no word goes on: a separator or the start of a text."""
    k = np.searchsorted(starts, at)
    stop = min(stop, int(starts[k])) if k < len(starts) else stop
    while at < stop:
        hit = np.flatnonzero(_KIND[raw[at:min(at + 4096, stop)]])
        if len(hit):
            return at + int(hit[0])
        at += 4096
    return stop


def words(batches, seed: int):
    """(symbols, pieces, texts' numbers, starts, ends, raw, batch) of slices; pieces are numbered on over all slices."""
    piece = 0
    for batch in batches:
        raw, offsets = _buffers(batch.column("text"))
        lang = batch.column("lang_key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        lang = mix(lang ^ np.uint64(seed))
        lo, end = int(offsets[0]), int(offsets[-1])
        while lo < end:
            hi = _slice_end(raw, min(lo + SLICE, end), end, offsets)
            part = raw[lo:hi]
            kind = _KIND[part]
            begins = np.zeros(hi - lo, dtype=bool)
            begins[offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo] = True
            inside = kind == _WORD
            before = np.concatenate(([False], inside[:-1]))
            start = np.flatnonzero(inside & (~before | begins))
            stops = np.flatnonzero(before & (~inside | begins))
            stops = np.append(stops, hi - lo) if inside[-1] else stops
            pieces = np.cumsum((kind == _STOP) | begins) + piece
            piece = int(pieces[-1])
            power, inverse = _power(hi - lo + 1)
            total = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum((_LOWER[part].astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
            h = (total[stops] - total[start]) * inverse[start]
            text = np.searchsorted(offsets, start + lo, side="right") - 1
            symbol = mix(mix(h ^ ((stops - start).astype(np.uint64) << np.uint64(48))) ^ lang[text])
            yield np.maximum(symbol, np.uint64(1)), pieces[start], text, start, stops, part, batch
            lo = hi


def windows(batches, seed: int):
    """(s1, s2, s3) of every word and the two that follow it in its piece; 0 where there is none."""
    held_s, held_p = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

    def cut(s, p, n):
        s2, s3 = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
        for step, out in ((1, s2), (2, s3)):
            m = min(n, len(s) - step)
            if m > 0:
                same = p[step:step + m] == p[:m]
                out[:m][same] = s[step:step + m][same]
        return s[:n], s2, s3

    for s, p, *_ in words(batches, seed):
        s, p = np.concatenate((held_s, s)), np.concatenate((held_p, p))
        n = max(0, len(s) - 2)   # the last two words wait for what follows
        yield cut(s, p, n)
        held_s, held_p = s[n:], p[n:]
    yield cut(held_s, held_p, len(held_s))


def _counted_words(seed: int):
    def run(batches):
        for s, _, text, start, stops, part, batch in words(batches, seed):
            found, first, n = np.unique(s, return_index=True, return_counts=True)
            if not len(found):
                continue
            size = (stops - start)[first]
            ends = np.cumsum(size)
            at = np.repeat(start[first] - (ends - size), size) + np.arange(ends[-1])
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            word = pa.Array.from_buffers(pa.string(), len(found), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[part[at]])])
            lang = batch.column("lang").take(pa.array(text[first])).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), lang, word, pa.array(n)], ["s", "lang", "word", "n"])
    return run


# ---- bit sets of bounded size

def bit_set(keys: DataFrame, column: str, n: int) -> np.ndarray:
    """Bits of the keys' low ends, as an array of 64-bit numbers; its size is bounded whatever ``n``."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * max(1, n) - 1).bit_length()))
    bit = F.col(column).bitwiseAND(F.lit(bits - 1))
    rows = keys.groupBy(F.shiftright(bit, 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    got = rows.toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[got["at"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def among(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(bits) * 64 - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


# ---- candidates

def _alive(word_bits, pair_bits, s1, s2, s3):
    """Positions whose pair may be frequent, and those whose two pairs may be."""
    if pair_bits is None:
        ok = among(word_bits, s1)
        return (s2 != 0) & ok & among(word_bits, s2), None
    first = (s2 != 0) & among(pair_bits, pair_key(s1, s2))
    return first, first & (s3 != 0) & among(pair_bits, pair_key(s2, s3))


def _buckets(seed: int, mask: np.uint64, word_bits, pair_bits=None):
    """Counted buckets of pairs of frequent words, or of triples of two frequent pairs."""
    def run(batches):
        w, p = word_bits.value, pair_bits.value if pair_bits else None
        held, size = [], 0

        def summed():
            k, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["k", "n"])

        for s1, s2, s3 in windows(batches, seed):
            pair, triple = _alive(w, p, s1, s2, s3)
            held.append((pair_key(s1[pair], s2[pair]) if p is None else triple_key(s1[triple], s2[triple], s3[triple])) & mask)
            size += len(held[-1])
            if size > KEYS_HELD:
                yield summed()
                held, size = [], 0
        if size:
            yield summed()
    return run


def _candidates(seed: int, pair_bits, triple_bits):
    """Pairs and triples in buckets that passed; a slice names each once."""
    def run(batches):
        p, t = pair_bits.value, triple_bits.value
        for s1, s2, s3 in windows(batches, seed):
            pair, triple = _alive(None, p, s1, s2, s3)
            key3 = triple_key(s1, s2, s3)
            triple &= among(t, key3)
            for some, key, third in ((pair, pair_key(s1, s2), np.zeros_like(s3)), (triple, key3, s3)):
                _, first = np.unique(key[some], return_index=True)
                at = np.flatnonzero(some)[first]
                yield pa.RecordBatch.from_arrays([pa.array(x[at].view(np.int64)) for x in (s1, s2, third)], ["s1", "s2", "s3"])
    return run


def _keyed(mask: np.uint64):
    """Candidates with their bucket and the key of their first pair, which need not travel with them before."""
    def run(batches):
        for batch in batches:
            s1, s2, s3 = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("s1", "s2", "s3"))
            k2 = pair_key(s1, s2)
            k = np.where(s3 == 0, k2, triple_key(s1, s2, s3)) & mask
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (k, k2, s1, s2, s3)],
                                             ["k", "k2", "s1", "s2", "s3"])
    return run


# ---- double-array tries

class _Slots:
    """Places of a double array that are being handed out."""

    def __init__(self, size: int):
        self.check = np.full(size, -1, dtype=np.int32)
        self.at, self.top, self.misses = 1, 0, 0   # where free places are sought; the last place taken

    def place(self, parent: int, codes: np.ndarray) -> int:
        """A base at which all of a node's codes fall on free places: near ``at``, else anywhere tried, else behind all."""
        tries = max(1, min(1 << 9, (1 << 15) // len(codes)))
        free = np.flatnonzero(self.check[self.at:self.at + 4096] < 0)[:tries] + (self.at - codes[0])
        spread = (np.arange(tries) + parent) * 0x9E3779B1 % max(1, self.top) - codes[0] + 1   # and anywhere below the top
        bases = np.concatenate((free, spread))
        there = bases[:, None] + codes[None, :]
        ok = there[:, -1] < len(self.check)
        fits = np.flatnonzero(ok & (self.check[np.minimum(there, len(self.check) - 1)] < 0).all(axis=1))
        if len(fits):
            base = int(bases[fits[0]])
            self.misses += int(fits[0]) >= len(free)
        else:
            base, self.misses = self.top + 1 - int(codes[0]), self.misses + 1
            need = base + int(codes[-1]) + 1 - len(self.check)
            if need > 0:
                self.check = np.concatenate((self.check, np.full(need + len(self.check) // 2, -1, dtype=np.int32)))
        if self.misses > 8 and self.at + 2048 < self.top:   # too few places left here
            self.at, self.misses = self.at + 2048, 0
        self.check[base + codes] = parent
        self.top = max(self.top, base + int(codes[-1]))
        return base

    def place_all(self, parents: np.ndarray, lo: np.ndarray, hi: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Bases of nodes whose codes are codes[lo:hi]; nodes with one code take the free places in order, at once."""
        bases = np.empty(len(parents), dtype=np.int64)
        one = hi - lo == 1
        several = np.flatnonzero(~one)
        for i in several[np.argsort(lo[several] - hi[several], kind="stable")]:   # many codes first
            bases[i] = self.place(int(parents[i]), codes[lo[i]:hi[i]])
        one = np.flatnonzero(one)
        free = np.flatnonzero(self.check < 0)[:len(one)]
        if len(free) < len(one):
            size = len(self.check)
            self.check = np.concatenate((self.check, np.full(len(one) + 16, -1, dtype=np.int32)))
            free = np.concatenate((free, size + np.arange(len(one) - len(free))))
        if len(one):
            self.check[free] = parents[one]
            bases[one] = free - codes[lo[one]]
            self.top = max(self.top, int(free[-1]))
        return bases


_LEAF = -(1 << 30)


def _radix(top: int) -> int:
    """A code up to ``top`` takes two steps, by its two digits: a node has few codes near each other, and places fill up."""
    return math.isqrt(top) + 1


def double_array(c1: np.ndarray, c2: np.ndarray, c3: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, state of each phrase) of phrases of codes from 1 on; c3 is 0 for phrases of two words.

    From state s the digit c (from 1 on) leads to base[s] + c if check of that place is s.  State 0 is the root, its base 0.
    """
    n, radix = len(c1), _radix(int(max(c1.max(), c2.max(), c3.max())))
    order = np.lexsort((c3, c2, c1))
    slots = _Slots(2 * n + radix + 16)
    slots.check[0] = 0
    state, prefix = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)   # of each phrase's digits so far
    nodes, bases = [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
    rows = np.arange(n)
    for depth in range(6):
        code = (c1, c2, c3)[depth // 2][order]
        rows = np.flatnonzero(code) if depth == 4 else rows
        if not len(rows):
            break
        digit = (code[rows] % radix if depth % 2 else code[rows] // radix) + 1
        parent = np.concatenate(([True], prefix[rows][1:] != prefix[rows][:-1]))
        child = parent | np.concatenate(([True], digit[1:] != digit[:-1]))
        at = np.flatnonzero(child)
        heads = np.flatnonzero(parent[at])
        ends = np.append(heads[1:], len(at))
        if depth:
            nodes.append(state[rows[at[heads]]])
            bases.append(slots.place_all(nodes[-1], heads, ends, digit[at]))
        else:   # the root's children stand at their digits
            slots.check[digit[at]] = 0
            slots.top = int(digit[at[-1]])
        prefix[rows] = np.cumsum(child)
        state[rows] = (np.repeat(bases[-1], ends - heads) + digit[at])[prefix[rows] - 1]
    used = int(np.flatnonzero(slots.check >= 0)[-1]) + 1
    base = np.full(used, _LEAF, dtype=np.int32)
    base[np.concatenate(nodes)] = np.concatenate(bases)
    out = np.empty(n, dtype=np.int64)
    out[order] = state
    return base, slots.check[:used], out


def _built(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard's trie as bytes, and the phrase of each accepting state."""
    s = pdf[["s1", "s2", "s3"]].to_numpy().view(np.uint64)
    symbols = np.unique(s)
    symbols = symbols[symbols != 0]
    codes = np.where(s == 0, 0, np.searchsorted(symbols, s) + 1)
    base, check, state = double_array(*(codes[:, i] for i in range(3)))
    return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "symbols": [symbols.tobytes()], "base": [base.tobytes()],
                         "check": [check.tobytes()], "states": [state],
                         **{c: [pdf[c].to_numpy()] for c in ("s1", "s2", "s3")}})


def step(base: np.ndarray, check: np.ndarray, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Next states of all positions; -1 where there is none."""
    to = base[state] + code
    ok = (code > 0) & (to >= 0) & (to < len(check))
    to = np.where(ok, to, 0)
    return np.where(ok & (check[to] == state), to, -1)


def reached(trie, s1, s2, s3) -> np.ndarray:
    """The states that are reached as a pair or a triple, as often as they are; all positions take a level at once."""
    symbols, base, check = trie
    radix = _radix(len(symbols))

    def word(state, s):
        """States after a word, of those positions that get there."""
        at = np.minimum(np.searchsorted(symbols, s), len(symbols) - 1)
        code = np.where(symbols[at] == s, at + 1, 0)
        state = step(base, check, state, np.where(code > 0, code // radix + 1, 0))
        live = np.flatnonzero(state >= 0)
        state = step(base, check, state[live], code[live] % radix + 1)
        return state[state >= 0], live[state >= 0]

    state, at = word(np.zeros(len(s1), dtype=np.int64), s1)
    pairs, pair = word(state, s2[at])
    s3 = s3[at[pair]]
    return np.concatenate((pairs, word(pairs[s3 != 0], s3[s3 != 0])[0]))


def advance(trie, s1, s2, s3) -> np.ndarray:
    """How often each state is reached as a pair or a triple."""
    return np.bincount(reached(trie, s1, s2, s3), minlength=len(trie[2]))


def _advanced(seed: int, shards: int, tries, pair_bits):
    """(shard, state, n): counts of a slice's texts over all shards' tries."""
    def run(batches):
        p = pair_bits.value
        held = {k: tuple(np.frombuffer(b, dtype=t) for b, t in zip(x, (np.uint64, np.int32, np.int32)))
                for k, x in tries.value.items()}
        sizes = [len(held[k][2]) if k in held else 0 for k in range(shards)]
        first = np.cumsum([0, *sizes])   # states of all shards numbered on
        for s1, s2, s3 in windows(batches, seed):
            k2 = pair_key(s1, s2)
            some = (s2 != 0) & among(p, k2)
            shard = (k2[some] % np.uint64(shards)).astype(np.min_scalar_type(shards))
            order = np.argsort(shard, kind="stable")
            rows = [x[some][order] for x in (s1, s2, s3)]
            edges = np.searchsorted(shard[order], np.arange(shards + 1))
            states = [reached(trie, *(x[edges[k]:edges[k + 1]] for x in rows)) + first[k]
                      for k, trie in held.items() if edges[k] < edges[k + 1]]
            if states:
                at, n = np.unique(np.concatenate(states).astype(np.min_scalar_type(first[-1])), return_counts=True)
                k = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(at.astype(np.int64) - first[k]), pa.array(n)],
                                                 ["shard", "state", "n"])
    return run


def _occurrences(seed: int, pair_bits, triple_bits):
    """(s1, s2, s3, n) of the windows that may be candidates, summed within a slice."""
    def run(batches):
        p, t = pair_bits.value, triple_bits.value
        for s1, s2, s3 in windows(batches, seed):
            pair, triple = _alive(None, p, s1, s2, s3)
            key3 = triple_key(s1, s2, s3)
            triple &= among(t, key3)
            for some, key, third in ((pair, pair_key(s1, s2), np.zeros_like(s3)), (triple, key3, s3)):
                _, first, n = np.unique(key[some], return_index=True, return_counts=True)
                at = np.flatnonzero(some)[first]
                yield pa.RecordBatch.from_arrays([*(pa.array(x[at].view(np.int64)) for x in (s1, s2, third)), pa.array(n)],
                                                 ["s1", "s2", "s3", "n"])
    return run


# ---- the operator

def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    def whole(x):
        return f"cast({x} as decimal(15,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * {whole(a)} * {whole(a)}) div ({whole(left)} * {whole(right)})")


def counts_of(docs: DataFrame, scratch: Scratch, min_count: int = MIN_COUNT,
              trie_bytes: int = TRIE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(s, lang, word, f) of all words, and (s1, s2, s3, a) of all phrases of two (s3 = 0) and three words with a count
    of ``min_count`` or more."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))
    texts = texts.withColumn("lang_key", F.xxhash64("lang"))
    seed = 0
    while True:
        found = texts.mapInArrow(_counted_words(seed), "s long, lang string, word string, n long")
        vocabulary = scratch.keep(found.groupBy("s", "lang", "word").agg(F.sum("n").alias("f")), f"words{seed}")
        if vocabulary.groupBy("s").count().filter("count > 1").isEmpty():
            break
        seed += 1   # two words share a symbol
    # buckets are so many that few of them are shared, and no wider than that needs: they are what is shuffled most
    size = vocabulary.agg(F.sum("f")).first()[0] or 0
    mask = np.uint64((1 << min(62, max(32, int(size).bit_length() + 8))) - 1)
    frequent = vocabulary.filter(F.col("f") >= min_count)
    word_bits = sc.broadcast(bit_set(frequent, "s", frequent.count()))
    texts = texts.drop("lang")

    def passed(run, name):
        kept = scratch.keep(texts.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
                            .filter(F.col("n") >= min_count).select("k"), name)
        return kept, sc.broadcast(bit_set(kept, "k", kept.count()))

    pairs, pair_bits = passed(_buckets(seed, mask, word_bits), "pairs")
    triples, triple_bits = passed(_buckets(seed, mask, word_bits, pair_bits), "triples")
    met = texts.mapInArrow(_candidates(seed, pair_bits, triple_bits), "s1 long, s2 long, s3 long").distinct()
    met = met.mapInArrow(_keyed(mask), "k long, k2 long, s1 long, s2 long, s3 long")
    candidates = scratch.keep(met.join(pairs.unionByName(triples), "k", "left_semi"), "candidates")
    n = candidates.count()
    shards = max(1, math.ceil(n / SHARD))
    # the task's numpy counts in unsigned numbers: the same remainder of the same 64 bits
    high, low = F.shiftrightunsigned("k2", 32), F.col("k2").bitwiseAND(F.lit((1 << 32) - 1))
    shard = ((high % shards) * ((1 << 32) % shards) + low % shards) % shards
    tries = scratch.keep(candidates.withColumn("shard", shard).groupBy("shard").applyInPandas(
        _built, "shard long, symbols binary, base binary, check binary, "
                "states array<long>, s1 array<long>, s2 array<long>, s3 array<long>"), "tries")
    size = tries.agg(F.sum(F.octet_length("symbols") + F.octet_length("base") + F.octet_length("check"))).first()[0] or 0
    if size <= trie_bytes:
        held = {r["shard"]: (bytes(r["symbols"]), bytes(r["base"]), bytes(r["check"]))
                for r in tries.select("shard", "symbols", "base", "check").collect()}
        states = texts.mapInArrow(_advanced(seed, shards, sc.broadcast(held), pair_bits), "shard long, state long, n long")
        summed = states.groupBy("shard", "state").agg(F.sum("n").alias("a"))
        accept = tries.select("shard", F.inline(F.arrays_zip(F.col("states").alias("state"), "s1", "s2", "s3")))
        counted = summed.join(accept, ["shard", "state"])
    else:
        met = texts.mapInArrow(_occurrences(seed, pair_bits, triple_bits), "s1 long, s2 long, s3 long, n long")
        counted = met.groupBy("s1", "s2", "s3").agg(F.sum("n").alias("a"))
    phrases = scratch.keep(counted.filter(F.col("a") >= min_count).select("s1", "s2", "s3", "a"), "phrases")
    return vocabulary, phrases


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, inside: int = INSIDE, top: int = TOP,
                 trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Each language's ``top`` phrases of two or three words by score: lang, rank, phrase, a, l, r, n, score.

    Texts are split at ``.,;:!?`` and line breaks into pieces and those at blanks and tabs into words, A-Z in lower
    case; a phrase lies within one piece.  A null text is empty, a null language ``und``.  Whole texts are read in
    slices, so that a text's length is bounded by memory for its bytes only; repeated rows count each time.  Phrases
    counted ``min_count`` times or more are candidates; a pair is left out if a candidate of three words around it
    has ``inside`` per cent of its count.  Other columns are ignored; without words the result is empty.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    vocabulary, phrases = counts_of(docs, scratch, min_count, trie_bytes)

    frequent = vocabulary.filter(F.col("f") >= min_count)   # a phrase is no more frequent than its words

    def word(i, lang=False):
        return frequent.select(F.col("s").alias(f"s{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"),
                                 *(["lang"] if lang else []))

    pairs, triples = phrases.filter("s3 = 0").select("s1", "s2", "a"), phrases.filter("s3 <> 0")
    longest = triples.select("s1", "s2", "a").unionByName(triples.select(F.col("s2").alias("s1"), F.col("s3").alias("s2"), "a"))
    longest = longest.groupBy("s1", "s2").agg(F.max("a").alias("around"))
    free = pairs.join(longest, ["s1", "s2"], "left").filter(F.coalesce(F.col("around"), F.lit(0)) * 100 < F.col("a") * inside)
    two = free.join(word(1, True), "s1").join(word(2), "s2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        _score("a", "f1", "f2").alias("score"))
    left = pairs.select("s1", "s2", F.col("a").alias("f12"))
    right = pairs.select(F.col("s1").alias("s2"), F.col("s2").alias("s3"), F.col("a").alias("f23"))
    three = (triples.join(left, ["s1", "s2"]).join(right, ["s2", "s3"]).join(word(1, True), "s1").join(word(2), "s2")
             .join(word(3), "s3").withColumns({"cut1": _score("a", "f1", "f23"), "cut2": _score("a", "f12", "f3")}))
    later = F.col("cut2") < F.col("cut1")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                         F.when(later, F.col("f12")).otherwise(F.col("f1")).alias("l"),
                         F.when(later, F.col("f3")).otherwise(F.col("f23")).alias("r"),
                         F.least("cut1", "cut2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    n = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                       F.col("score").cast("long").alias("score"))


ORACLE_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
list AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
uni AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM list) GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM uni GROUP BY lang),
two AS (SELECT lang, x, y, count(*) AS a FROM (SELECT lang, unnest(w[:-2]) AS x, unnest(w[2:]) AS y FROM list
  WHERE len(w) > 1) GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, x, y, z, count(*) AS a FROM (SELECT lang, unnest(w[:-3]) AS x, unnest(w[2:-2]) AS y,
  unnest(w[3:]) AS z FROM list WHERE len(w) > 2) GROUP BY ALL HAVING count(*) >= 10),
around AS (SELECT lang, x, y, max(a) AS around FROM (SELECT lang, x, y, a FROM three UNION ALL SELECT lang, y, z, a FROM three)
  GROUP BY ALL),
scored AS (
  SELECT two.lang, two.x || ' ' || two.y AS phrase, two.a, u.f AS l, v.f AS r,
    1000000::HUGEINT * two.a * two.a // (u.f::HUGEINT * v.f) AS score
  FROM two JOIN uni u ON u.lang = two.lang AND u.w = two.x JOIN uni v ON v.lang = two.lang AND v.w = two.y
    LEFT JOIN around o ON o.lang = two.lang AND o.x = two.x AND o.y = two.y
  WHERE 100 * coalesce(around, 0) < 50 * two.a
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN c2 < c1 THEN f12 ELSE f1 END, CASE WHEN c2 < c1 THEN f3 ELSE f23 END, least(c1, c2) FROM (
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.a, u.f AS f1, q.a AS f23, p.a AS f12, v.f AS f3,
      1000000::HUGEINT * t.a * t.a // (u.f::HUGEINT * q.a) AS c1, 1000000::HUGEINT * t.a * t.a // (p.a::HUGEINT * v.f) AS c2
    FROM three t JOIN uni u ON u.lang = t.lang AND u.w = t.x JOIN uni v ON v.lang = t.lang AND v.w = t.z
      JOIN two p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored) JOIN total USING (lang)
WHERE rank <= 2000
"""


@query("op13_trie_phrases", ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
