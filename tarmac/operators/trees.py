"""Tree models from sufficient statistics (M11-M13): forests, boosted trees, boosted stumps.

Rows are binned once (32 quantile bins a feature) into blocks of numpy arrays.
A fit never sees rows again, only sums per (node, feature, bin):

* All trees of all fits (folds x candidates) grow together, one Spark job per
  depth level.  A task adds up the statistics of its block for every node of
  the level; blocks are summed by a shuffle, and the best split of a node
  comes back.  The driver holds the models and nothing of the rows.
* A boosted stump needs one sum per (feature, bin, class) and round.  Since a
  stump looks at one feature, all stumps so far are one table of (feature,
  bin): a row's weight is a function of d lookups however many rounds ran.
* Bootstrap weights, feature subsets and so models are seeded hashes of row
  keys and node paths: partitioning and task retries do not change them.
* Trees see cells: rows of equal bins and class, with the bootstrap weights of
  their rows added up, which are drawn by row.
* Where each dataset's rows are at most ``LOCAL_ROWS``, a task takes a dataset
  and some of its trees and grows them to their end: the same sums and splits,
  without a job per level and without descending from the roots again.  A
  forest's statistics are whole numbers, so both ways give the same trees.
  Fits of one seed and dataset share the draws of their trees.
* Of more rows than that, the weights are added up where a cell's rows lie, and
  tasks grow and score trees on the sums.  Only a dataset with more than
  ``LOCAL_ROWS`` cells grows by level.

Datasets are numbered (``data``); each has training and test rows, so that the
folds of a cross-validation, each scaled and resampled on its own, are fitted
in the same jobs.
"""

from __future__ import annotations

import math
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
#: numbers of one group's statistics, and trees of one group, at most
CELLS, GROUP_TREES = 1 << 21, 64
#: trees that grow in the same jobs at most
BATCH_TREES = 6000
#: rows (some 20 bytes each) of a dataset that a task takes at most, and (tree, row) pairs that it grows at once
LOCAL_ROWS, PAIRS = 1 << 21, 1 << 17
#: bootstrap weights (a byte or a few each) of a group's trees that a task keeps for the dataset's other fits
HELD_SUMS = 1 << 26
#: training rows from which boosted models add up cells; fewer are added row by row, as rounding may decide between
#: splits of equal gain
SUMMED_ROWS = 1 << 16
#: rows of a bucket of cells on average at most, and (tree, cell) sums of trees that grow in the same jobs
BUCKET_ROWS, BATCH_SUMS = 1 << 20, 1 << 30
#: a cell with more than one in so many of a block's rows is dealt to all buckets
HOT = 16
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
#: the same shares of 2^53
_DRAWS = np.ceil(_POISSON * 2.0 ** 53).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public domain constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block(NamedTuple):
    data: int
    test: bool
    key: np.ndarray    # uint64 per row
    y: np.ndarray      # 0 / 1
    bins: np.ndarray   # uint8 [rows, features]


class Blocks:
    """Binned rows of numbered datasets, cached as an RDD of ``Block``.

    ``rows(data, is_test, row_id, label, features)``: quantile edges come from
    a dataset's training rows only.  Close with ``release``.
    """

    def __init__(self, rows: DataFrame, n_features: int):
        sc = rows.sparkSession.sparkContext
        qs = F.array(*[F.lit((i + 1) / BINS) for i in range(BINS - 1)])
        got = rows.filter("not is_test").groupBy("data").agg(
            *[F.percentile_approx(F.col("features")[i], qs, 2000).alias(f"e{i}") for i in range(n_features)]).collect()
        self.edges = {r["data"]: [np.unique(np.array(r[f"e{i}"] or [0.0])) for i in range(n_features)] for r in got}
        self.n_features = n_features
        edges = self.edges

        def cut(frames):
            for pdf in frames:
                for (data, test), part in pdf.groupby(["data", "is_test"]):
                    x = np.stack(part["features"].to_numpy())
                    bins = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges[data])], axis=1)
                    yield pd.DataFrame({"data": [data], "test": [test], "n": [len(part)],
                                        "key": [part["row_id"].to_numpy(dtype=np.int64).tobytes()],
                                        "y": [part["label"].to_numpy(dtype=np.uint8).tobytes()],
                                        "bins": [bins.astype(np.uint8).tobytes()]})

        known = rows.filter(F.col("data").isin(list(edges)))   # a dataset without training rows has no fit
        table = known.mapInPandas(cut, "data int, test boolean, n int, key binary, y binary, bins binary")
        self.rdd = table.rdd.map(lambda r: Block(
            r["data"], r["test"], _mix(np.frombuffer(r["key"], dtype=np.uint64)), np.frombuffer(r["y"], dtype=np.uint8),
            np.frombuffer(r["bins"], dtype=np.uint8).reshape(r["n"], n_features))).persist(StorageLevel.MEMORY_AND_DISK)
        counts = self.rdd.filter(lambda b: not b.test).map(lambda b: b.data).countByValue()
        self.whole = max(counts.values(), default=1) == 1   # a dataset's training rows are one block: nothing to sum
        n = sum(counts.values())
        self.chunks = max(1, sc.defaultParallelism // max(1, n))
        if self.chunks > 1:   # few blocks: several tasks share a block, each with its own groups of trees
            k = self.chunks
            self.train = (self.rdd.filter(lambda b: not b.test).zipWithIndex()
                          .flatMap(lambda x: [(x[1] * k + c, (c, x[0])) for c in range(k)])
                          .partitionBy(n * k, lambda i: i).values().persist(StorageLevel.MEMORY_AND_DISK))
        else:
            self.train = self.rdd.filter(lambda b: not b.test).map(lambda b: (0, b))
        self.sc = sc
        sizes = self.rdd.map(lambda b: (b.data, len(b.y))).reduceByKey(int.__add__).values().collect()   # one a dataset
        self.local, self.rows = max(sizes, default=0) <= LOCAL_ROWS, sum(sizes)
        self._cells = None

    def dealt(self, work: dict[int, list]):
        """(training block, test block, items) of (cost, item) of work on datasets: runs of about equal cost go to a
        task, so that it sees few datasets; a block is None if it has no rows.  For datasets of ``LOCAL_ROWS`` at most."""
        tasks = max(1, min(4 * self.sc.defaultParallelism, sum(len(items) for items in work.values())))
        total, spent, places = sum(c for items in work.values() for c, _ in items), 0, defaultdict(dict)
        for data, items in work.items():
            for cost, x in items:
                places[data].setdefault(min(tasks - 1, int((spent + cost / 2) * tasks / total)), []).append(x)
                spent += cost

        def joined(x):
            data, found = x
            out = []
            for test in (False, True):
                parts = sorted((b for b in found if b.test is test), key=lambda b: b.key.tobytes())
                out.append(Block(data, test, *(np.concatenate(c) for c in list(zip(*parts))[2:])) if parts else None)
            return data, out

        wanted = dict(places)
        whole = self.rdd.filter(lambda b: b.data in wanted).map(lambda b: (b.data, b)).groupByKey().map(joined)
        sent = whole.flatMap(lambda x: [(task, (*x[1], items)) for task, items in wanted[x[0]].items()])
        return sent.partitionBy(tasks, lambda i: i).values()

    @property
    def cells(self) -> Cells:
        if self._cells is None:
            self._cells = Cells(self)
        return self._cells

    def release(self) -> None:
        if self._cells is not None:
            self._cells.release()
        self.train.unpersist()
        self.rdd.unpersist()


def _alike(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal rows together, and the places in it where another row begins."""
    order = np.lexsort(rows.T)
    x = rows[order]
    return order, np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(axis=1)))


def _counted(bins: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of bins, and n added up over each."""
    order, starts = _alike(bins)
    return bins[order[starts]], np.add.reduceat(n[order], starts, axis=0)


def _by_class(y: np.ndarray) -> np.ndarray:
    return np.column_stack((y == 0, y == 1)).astype(np.int64)


def _row_hash(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), dtype=np.uint64)
    for c in rows.T:
        h = _mix(h + c.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return h


class Cells:
    """Rows of blocks by their bins (and class, for training rows), in buckets.

    ``train`` holds (data, keys of rows, where each cell's rows begin, cells [n, bins and class]), ``test`` holds
    (data, bucket, bins, rows by class [n, 2]).  Buckets are dealt by the cells' hash; a cell that many rows share is
    dealt over all of them, in parts that count as cells of their own.
    """

    def __init__(self, blocks: Blocks):
        buckets = max(4 * blocks.sc.defaultParallelism, -(-blocks.rows // BUCKET_ROWS))

        def cut(place):
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(buckets + 1))
            return ((int(p), order[ends[p]:ends[p + 1]]) for p in np.unique(place))

        def spread(b):
            rows = np.column_stack((b.bins, b.y))
            h = _row_hash(rows)
            _, at, n = np.unique(h, return_inverse=True, return_counts=True)
            place = np.where(n[at] * HOT > len(h), b.key, h) % np.uint64(buckets)
            return [(p, (b.data, b.key[some], rows[some])) for p, some in cut(place)]

        def met(part):
            found = defaultdict(list)
            for data, *x in part:
                found[data].append(x)
            for data, x in found.items():
                key, rows = (np.concatenate(c) for c in zip(*x))
                order, starts = _alike(rows)
                yield data, key[order], starts, rows[order[starts]]

        def told(b):
            bins, n = _counted(b.bins, _by_class(b.y))
            return [((b.data, p), (bins[some], n[some])) for p, some in cut(_row_hash(bins) % np.uint64(buckets))]

        def added(x):
            (data, p), parts = x
            return data, p, *_counted(*(np.concatenate(c) for c in zip(*parts)))

        self.train = (blocks.rdd.filter(lambda b: not b.test).flatMap(spread).partitionBy(buckets, lambda p: p).values()
                      .mapPartitions(met).persist(StorageLevel.MEMORY_AND_DISK))
        self.test = (blocks.rdd.filter(lambda b: b.test).flatMap(told).groupByKey(buckets).map(added)
                     .persist(StorageLevel.MEMORY_AND_DISK))
        sizes = [dict(rdd.map(lambda x: (x[0], len(x[3]))).reduceByKey(int.__add__).collect()) for rdd in (self.train, self.test)]
        self.most = max((n for x in sizes for n in x.values()), default=0)
        self.local = self.most <= LOCAL_ROWS
        if not self.local:
            self.release()

    def release(self) -> None:
        self.train.unpersist()
        self.test.unpersist()


class Fit(NamedTuple):
    """One forest on one dataset."""
    data: int
    seed: int = 42
    trees: int = 300
    depth: int = 15
    leaf: int = 2                # rows of a leaf at least
    subset: str = "sqrt"         # features tried at a node: sqrt, log2, or a share
    impurity: str = "gini"       # or entropy
    weight: str | float | None = None   # None, balanced, balanced_subsample, or the positive class's weight

    def n_subset(self, d: int) -> int:
        named = {"sqrt": math.sqrt(d), "log2": math.log2(max(d, 2))}
        return max(1, min(d, int(named[self.subset] if self.subset in named else float(self.subset) * d)))


class Trees:
    """Nodes of many trees as arrays; roots are nodes 0 to n - 1.  A leaf has child -1; ``value`` is class 1's share,
    or a boosted tree's step."""

    def __init__(self, n: int):
        self.feature, self.thr = np.zeros(n, dtype=np.int16), np.zeros(n, dtype=np.int16)
        self.child, self.value = np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.float64)

    def grow(self, parents, feature, thr, left, right) -> np.ndarray:
        """Give parents two children each; returns the left ones' numbers."""
        at = len(self.child) + 2 * np.arange(len(parents))
        self.feature[parents], self.thr[parents], self.child[parents] = feature, thr, at
        k = 2 * len(parents)
        self.feature = np.concatenate((self.feature, np.zeros(k, dtype=np.int16)))
        self.thr = np.concatenate((self.thr, np.zeros(k, dtype=np.int16)))
        self.child = np.concatenate((self.child, np.full(k, -1, dtype=np.int32)))
        self.value = np.concatenate((self.value, np.column_stack((left, right)).ravel()))
        return at


def _descend(trees, roots: np.ndarray, bins: np.ndarray, levels: int) -> np.ndarray:
    """Node of every (tree, row)."""
    node = np.repeat(roots.astype(np.int32)[:, None], len(bins), axis=1)
    row = np.arange(len(bins))[None, :]
    for _ in range(levels):
        c = trees.child[node]
        go = c >= 0
        if not go.any():
            break
        node = np.where(go, c + (bins[row, trees.feature[node]] > trees.thr[node]), node)
    return node


def _bootstrap(key: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Poisson(1) weights of every (tree, row)."""
    out, step = np.empty((len(seeds), len(key)), dtype=np.uint8), 1 << 14   # what fits a core's cache
    for i, seed in enumerate(seeds):
        for a in range(0, len(key), step):
            u = _mix(key[a:a + step] ^ seed) >> np.uint64(11)
            n = (u >= _DRAWS[0]).view(np.uint8)
            for x in _DRAWS[1:]:
                n += u >= x
            out[i, a:a + step] = n
    return out


def _subsets(paths: np.ndarray, d: int, k: int) -> np.ndarray:
    """k features of every node, drawn by its path."""
    if k >= d:
        return np.repeat(np.arange(d)[None, :], len(paths), axis=0)
    draw = _mix(paths[:, None] ^ _mix(np.arange(1, d + 1, dtype=np.uint64))[None, :])
    return np.sort(np.argpartition(draw, k - 1, axis=1)[:, :k], axis=1)


def _sums(slot, row, a, b, bins, feats, n_slots: int) -> np.ndarray:
    """[slot, feature of its subset, bin, 2]: sums of a and b."""
    out = np.empty((n_slots, feats.shape[1], BINS, 2))
    for j in range(feats.shape[1]):
        at = slot * BINS + bins[row, feats[slot, j]]
        for i, v in enumerate((a, b)):
            out[:, j, :, i] = np.bincount(at, v, n_slots * BINS).reshape(n_slots, BINS)
    return out


def _counts(slot, row, n, y, bins, feats, n_slots: int) -> np.ndarray:
    """``_sums`` of the rows' weights n by class, in one pass a feature."""
    out = np.empty((n_slots, feats.shape[1], BINS, 2))
    for j in range(feats.shape[1]):
        at = (slot * BINS + bins[row, feats[slot, j]]) * 2 + y
        out[:, j] = np.bincount(at, n, n_slots * BINS * 2).reshape(n_slots, BINS, 2)
    return out


def _best(sums: np.ndarray, feats: np.ndarray, impurity: str, leaf: float, weights: np.ndarray) -> tuple:
    """Best split of each slot: (gain, feature, bin, left sums, all sums); ``weights`` [slot, 2] weigh the classes.

    For ``newton`` the sums are gradients and curvatures and ``leaf`` bounds the curvature.
    """
    left = sums.cumsum(axis=2)[:, :, :-1]
    total = sums[:, 0].sum(axis=1)
    right = total[:, None, None, :] - left
    if impurity == "newton":
        def cost(s):
            return -s[..., 0] ** 2 / (s[..., 1] + 1.0)
        ok = (left[..., 1] >= leaf) & (right[..., 1] >= leaf)
        gain = cost(total)[:, None, None] - cost(left) - cost(right)
    else:
        def cost(s):
            a, b = s[..., 0], s[..., 1]
            n = a + b
            with np.errstate(divide="ignore", invalid="ignore"):
                if impurity == "gini":
                    c = n - (a * a + b * b) / n
                else:
                    c = -(np.where(a > 0, a * np.log2(a / n), 0.0) + np.where(b > 0, b * np.log2(b / n), 0.0))
            return np.where(n > 0, c, 0.0)
        ok = (left[..., 0] + left[..., 1] >= leaf) & (right[..., 0] + right[..., 1] >= leaf)
        w = weights[:, None, None, :]
        gain = cost(total * weights)[:, None, None] - cost(left * w) - cost(right * w)
    gain = np.where(ok, gain, -1.0).reshape(len(sums), -1)
    at = gain.argmax(axis=1)
    s = np.arange(len(sums))
    k, b = np.divmod(at, BINS - 1)
    return gain[s, at], feats[s, k], b, left[s, k, b], total


class _Group(NamedTuple):
    fit: int
    first: int     # trees
    last: int
    lo: int        # slots of the level
    hi: int


def _groups(slot_tree: np.ndarray, tree_fit: np.ndarray, cells: list[int]) -> list[_Group]:
    """Runs of the level's nodes, of one fit each and bounded in trees and numbers."""
    out, lo = [], 0
    fits = tree_fit[slot_tree]
    while lo < len(slot_tree):
        fit = int(fits[lo])
        most = max(1, CELLS // (cells[fit] * BINS * 2))
        hi = min(lo + most, int(np.searchsorted(fits, fit, side="right")),
                 int(np.searchsorted(slot_tree, slot_tree[lo] + GROUP_TREES)))
        out.append(_Group(fit, int(slot_tree[lo]), int(slot_tree[hi - 1]) + 1, lo, hi))
        lo = hi
    return out


def _seeds(fit: Fit, first: int, last: int) -> np.ndarray:
    return _mix(np.arange(first, last, dtype=np.uint64) ^ _mix(np.array([fit.seed], dtype=np.uint64)) + np.uint64(1))


class _Held:
    """A dataset's training rows in a task, as cells (or each a cell of its own, in the rows' order), and the bootstrap
    weights of the group of trees that it drew last."""

    def __init__(self, block: Block, alike: bool = True):
        self.group, self.kept = None, None
        if not alike:
            self.key, self.bins, self.y, self.starts = block.key, block.bins, block.y.astype(np.int64), np.arange(len(block.y))
            return
        rows = np.column_stack((block.bins, block.y))
        order, self.starts = _alike(rows)
        self.key, rows = block.key[order], rows[order[self.starts]]
        self.bins, self.y = np.ascontiguousarray(rows[:, :-1]), rows[:, -1].astype(np.int64)

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts, append=len(self.key))

    def drawn(self, fit: Fit, first: int, last: int) -> np.ndarray:
        """Weights of every (tree, cell)."""
        if len(self.starts) == len(self.key):
            return _bootstrap(self.key, _seeds(fit, first, last))
        w = np.stack([np.add.reduceat(_bootstrap(self.key, s[None])[0], self.starts, dtype=np.uint32)
                      for s in _seeds(fit, first, last)])
        return w.astype(np.min_scalar_type(w.max()))

    def of_group(self, fit: Fit, first: int, last: int) -> np.ndarray:
        """``drawn``, kept for the next fit of the same seed."""
        if self.group != (fit.seed, first) or len(self.kept) < last - first:
            self.group, self.kept = (fit.seed, first), self.drawn(fit, first, last)
        return self.kept[:last - first]


def _held_to_boost(block: Block) -> _Held:
    return _Held(block, len(block.y) >= SUMMED_ROWS)


def _forest_of(held: _Held, fit: Fit, first: int, last: int):
    """``_trees_of`` a dataset's cells."""
    y = held.y.astype(np.float64)
    if (last - first) * len(y) <= HELD_SUMS:
        w = held.of_group(fit, first, last)
        totals = [np.column_stack((x @ (1.0 - y), x @ y)) for x in (part[None].astype(np.float64) for part in w)]

        def drawn(lo, hi):
            return w[lo - first:hi - first]
    else:
        totals = []
        for t in range(first, last):
            x = held.drawn(fit, t, t + 1).astype(np.float64)
            totals.append(np.column_stack((x @ (1.0 - y), x @ y)))

        def drawn(lo, hi):
            return held.drawn(fit, lo, hi)
    return _trees_of(held.bins, held.y, fit, first, last, _class_weights(fit, np.concatenate(totals)), drawn)


def _trees_of(bins: np.ndarray, y: np.ndarray, fit: Fit, first: int, last: int, weights: np.ndarray, drawn):
    """Grown trees ``first`` to ``last - 1`` of a fit, as (how many, Trees) in order; roots are the first nodes.

    ``drawn(lo, hi)`` gives the trees' bootstrap weights [tree, row], ``weights`` their class weights.
    """
    d, y = bins.shape[1], y.astype(np.int64)
    step = max(1, PAIRS // max(1, len(y)))
    cuts = [(lo, min(lo + step, last)) for lo in range(first, last, step)]
    k = fit.n_subset(d)
    for lo, hi in cuts:
        path = _seeds(fit, lo, hi)
        w = drawn(lo, hi)
        slot, row = np.nonzero(w)
        n, cls = w[slot, row].astype(np.float64), y[row]
        model, node, weigh = Trees(hi - lo), np.arange(hi - lo), weights[lo - first:hi - first]
        for level in range(fit.depth):
            if not len(node):
                break
            feats, found = _subsets(path, d, k), []
            most = max(1, CELLS // (k * BINS * 2))
            for a in range(0, len(node), most):
                b = min(a + most, len(node))
                mine = slice(None) if b - a == len(node) else (slot >= a) & (slot < b)
                sums = _counts(slot[mine] - a, row[mine], n[mine], cls[mine], bins, feats[a:b], b - a)
                found.append(_best(sums, feats[a:b], fit.impurity, fit.leaf, weigh[a:b]))
            gain, feature, thr, left, total = (np.concatenate(x) for x in zip(*found))
            if level == 0:
                model.value[node] = _share(total, weigh)
            ok = gain > 1e-9
            if not ok.any():
                break
            left, right, w_ok = left[ok], (total - left)[ok], weigh[ok]
            at = model.grow(node[ok], feature[ok], thr[ok], _share(left, w_ok), _share(right, w_ok))
            sums = np.stack((left, right), axis=1).reshape(-1, 2)
            mixed = (sums.min(axis=1) > 0) & (sums.sum(axis=1) >= 2 * fit.leaf)
            heir = np.full((len(node), 2), -1, dtype=np.int64)
            heir[ok] = np.where(mixed, np.cumsum(mixed) - 1, -1).reshape(-1, 2)
            slot = heir[slot, (bins[row, feature[slot]] > thr[slot]).astype(np.int64)]
            stay = slot >= 0
            slot, row, n, cls = slot[stay], row[stay], n[stay], cls[stay]
            node = np.column_stack((at, at + 1)).ravel()[mixed]
            path = _mix(np.repeat(path[ok], 2) * np.uint64(2) + np.tile(np.arange(2, dtype=np.uint64), len(at)))[mixed]
            weigh = np.repeat(w_ok, 2, axis=0)[mixed]
        yield hi - lo, model


def _tree_work(fits: list[Fit]) -> dict[int, list]:
    """Per dataset (number of the fit, fit, first tree, last), in runs of the trees whose class weights are one group's."""
    work = defaultdict(list)
    for i, f in enumerate(fits):
        for lo in range(0, f.trees, GROUP_TREES):
            work[f.data].append((i, f, lo, min(lo + GROUP_TREES, f.trees)))
    return dict(work)


def _dealt_work(fits: list[Fit], d: int) -> dict[int, list]:
    """``_tree_work`` with a rough cost of each, those that draw the same weights one after the other."""
    return {data: [((last - first) * f.n_subset(d) * f.depth, (i, f, first, last)) for i, f, first, last
                   in sorted(items, key=lambda x: (x[1].seed, x[2], -x[3], x[0]))] for data, items in _tree_work(fits).items()}


def _shares(trees, bins: np.ndarray, depth: int) -> np.ndarray:
    """Class 1's share at every row, added up over trees (how many, Trees)."""
    share = np.zeros(len(bins))
    for count, t in trees:
        rows = max(1, (PAIRS * 4) // count)
        for a in range(0, len(share), rows):
            share[a:a + rows] += t.value[_descend(t, np.arange(count), bins[a:a + rows], depth)].sum(axis=0)
    return share


def _batches(fits: list[Fit], most: int):
    """Runs of fits, as (number of the first, fits), of ``most`` trees together or one alone."""
    batch, held, at = [], 0, 0
    for i, f in enumerate(fits):
        if batch and held + f.trees > most:
            yield at, batch
            batch, held, at = [], 0, i
        batch.append(f)
        held += f.trees
    if batch:
        yield at, batch


def _from_cells(blocks: Blocks, fits: list[Fit], use, tested: bool):
    """RDD of what ``use(number of the fit, fit, first tree, trees, test cells)`` yields for some trees grown in a task,
    and the sums to unpersist."""
    sc, cells = blocks.sc, blocks.cells
    each = max(1, min(GROUP_TREES, sum(f.trees for f in fits) // (4 * sc.defaultParallelism)))
    items = [(i, f, a, min(a + each, hi)) for work in _tree_work(fits).values() for i, f, lo, hi in work
             for a in range(lo, hi, each)]
    by_data = defaultdict(list)
    for number, (_, f, _, _) in enumerate(items):
        by_data[f.data].append(number)
    by_data = dict(by_data)

    def weighed(x):
        data, key, starts, rows = x
        for number in by_data.get(data, ()):
            _, f, lo, hi = items[number]
            w = np.stack([np.add.reduceat(_bootstrap(key, s[None])[0], starts, dtype=np.uint32) for s in _seeds(f, lo, hi)])
            yield number, (rows, w.astype(np.min_scalar_type(w.max())))

    sums = cells.train.flatMap(weighed).persist(StorageLevel.MEMORY_AND_DISK)

    def totals(x):
        number, (rows, w) = x
        y = rows[:, -1].astype(np.float64)
        return number, np.column_stack((w @ (1.0 - y), w @ y))

    found = dict(sums.map(totals).reduceByKey(np.add).collect())   # two numbers a tree
    groups = defaultdict(list)
    for number, (i, _, lo, _) in enumerate(items):
        if number in found:
            groups[i, lo // GROUP_TREES].append(number)
    weights = {}
    for numbers in groups.values():
        w = _class_weights(items[numbers[0]][1], np.concatenate([found[n] for n in numbers]))
        weights |= zip(numbers, np.split(w, np.cumsum([len(found[n]) for n in numbers])[:-1]))
    sent = sums.mapValues(lambda x: (-1, *x))
    if tested:
        sent = sent.union(cells.test.flatMap(lambda x: [(number, x[1:]) for number in by_data.get(x[0], ())]))

    def grown(x):
        number, parts = x
        i, f, lo, hi = items[number]
        parts = sorted(parts, key=lambda p: p[0])
        train, test = [p for p in parts if p[0] < 0], [p for p in parts if p[0] >= 0]
        rows, w = np.concatenate([p[1] for p in train]), np.concatenate([p[2] for p in train], axis=1)
        trees = _trees_of(rows[:, :-1], rows[:, -1], f, lo, hi, weights[number], lambda a, b: w[a - lo:b - lo])
        return use(i, f, lo, trees, test)

    return sent.groupByKey(len(items)).flatMap(grown), sums


def _cell_counts(blocks: Blocks, fits: list[Fit]) -> dict[int, np.ndarray]:
    """``forest_counts`` of trees grown and scored on cells."""
    out = {}
    for at, batch in _batches(fits, min(BATCH_TREES, BATCH_SUMS // max(1, blocks.cells.most))):
        trees = [f.trees for f in batch]

        def scored(i, f, first, grown, test):
            if test:
                share = _shares(grown, np.concatenate([bins for _, bins, _ in test]), f.depth)
                ends = np.cumsum([len(bins) for _, bins, _ in test])[:-1]
                for (p, _, n), part in zip(test, np.split(share, ends)):
                    yield (i, p), (first, part, n)

        def judged(x, trees=trees):
            (i, _), parts = x
            parts = sorted(parts, key=lambda p: p[0])
            return i, _cells_confusion(parts[0][2], sum(p[1] for p in parts) / trees[i] - 0.5 > 0)

        rdd, sums = _from_cells(blocks, batch, scored, True)
        out |= {at + i: c for i, c in rdd.groupByKey().map(judged).reduceByKey(np.add).collect()}
        sums.unpersist()
    return out


def forest_counts(blocks: Blocks, fits: list[Fit]) -> dict[int, np.ndarray]:
    """{number of the fit: [tp, fp, fn, tn]} of forests that nobody keeps.

    Tasks that grow their trees whole add up their shares on the test rows; models do not leave them.
    """
    if not blocks.local:
        return _cell_counts(blocks, fits) if blocks.cells.local else forest_confusion(blocks, fits, grow_forests(blocks, fits))

    def shares(x):
        train, test, items = x
        if test is None:
            return
        held = _Held(train) if train is not None else None
        bins, n = _counted(test.bins, _by_class(test.y))
        for i, f, first, last in items:
            share = _shares(_forest_of(held, f, first, last), bins, f.depth) if held is not None else np.zeros(len(bins))
            yield i, (first, share, None if first else n)

    sizes = [f.trees for f in fits]

    def judged(x):
        i, parts = x
        parts = sorted(parts, key=lambda p: p[0])
        return i, _cells_confusion(parts[0][2], sum(p[1] for p in parts) / sizes[i] - 0.5 > 0)

    return dict(blocks.dealt(_dealt_work(fits, blocks.n_features)).flatMap(shares).groupByKey().map(judged).collect())


def _grow_whole(blocks: Blocks, fits: list[Fit]) -> list[tuple[Trees, np.ndarray]]:
    def grown(x):
        train, _, items = x
        if train is not None:
            held = _Held(train)
            for i, f, first, last in items:
                yield i, first, list(_forest_of(held, f, first, last))

    return _joined(fits, blocks.dealt(_dealt_work(fits, blocks.n_features)).flatMap(grown).collect())


def _grow_cells(blocks: Blocks, fits: list[Fit]) -> list[tuple[Trees, np.ndarray]]:
    rdd, sums = _from_cells(blocks, fits, lambda i, f, first, trees, _: [(i, first, list(trees))], False)
    out = _joined(fits, rdd.collect())
    sums.unpersist()
    return out


def _joined(fits: list[Fit], grown) -> list[tuple[Trees, np.ndarray]]:
    """(trees, roots) of every fit from (number of the fit, first tree, [(how many, Trees)])."""
    parts = defaultdict(list)
    for i, first, trees in grown:
        parts[i].append((first, trees))
    out = []
    for i, f in enumerate(fits):
        if i not in parts:
            out.append((Trees(f.trees), np.arange(f.trees)))   # no row of the dataset: single leaves
            continue
        model, roots, at, found = Trees(0), [], 0, [t for _, ts in sorted(parts[i], key=lambda p: p[0]) for t in ts]
        for count, t in found:
            roots.append(at + np.arange(count))
            t.child = np.where(t.child >= 0, t.child + at, -1).astype(np.int32)
            at += len(t.child)
        for c in ("feature", "thr", "child", "value"):
            setattr(model, c, np.concatenate([getattr(t, c) for _, t in found]))
        out.append((model, np.concatenate(roots)))
    return out


def grow_forests(blocks: Blocks, fits: list[Fit]) -> list[tuple[Trees, np.ndarray]]:
    """(trees, roots) of every fit; fits grow together in batches of bounded numbers of trees."""
    if blocks.local:
        return _grow_whole(blocks, fits)
    most, grow = BATCH_TREES, _grow
    if blocks.cells.local:
        most, grow = min(BATCH_TREES, BATCH_SUMS // max(1, blocks.cells.most)), _grow_cells
    return [x for _, batch in _batches(fits, most) for x in grow(blocks, batch)]


def _grow(blocks: Blocks, fits: list[Fit]) -> list[tuple[Trees, np.ndarray]]:
    sizes = [f.trees for f in fits]
    tree_fit = np.repeat(np.arange(len(fits)), sizes)
    n_trees, d = len(tree_fit), blocks.n_features
    nth = np.concatenate([np.arange(n) for n in sizes]).astype(np.uint64)
    seeds = _mix(nth ^ _mix(np.array([f.seed for f in fits], dtype=np.uint64))[tree_fit] + np.uint64(1))
    model, cells = Trees(n_trees), [f.n_subset(d) for f in fits]
    # the level's nodes, sorted by tree
    node, tree, path = np.arange(n_trees), np.arange(n_trees), seeds.copy()
    weights = np.ones((n_trees, 2))
    chunks, whole = blocks.chunks, blocks.whole
    for level in range(max(f.depth for f in fits) + 1):
        deep = np.array([f.depth for f in fits])[tree_fit[tree]] > level
        node, tree, path = node[deep], tree[deep], path[deep]
        if not len(node) and level:
            break
        groups = _groups(tree, tree_fit, cells)
        by_data = defaultdict(list)
        for g, x in enumerate(groups):
            by_data[fits[x.fit].data].append(g)
        slot_of = np.full(len(model.child), -1, dtype=np.int32)
        slot_of[node] = np.arange(len(node))
        state = blocks.sc.broadcast((model, slot_of, seeds, path, weights[tree], groups, dict(by_data), fits, cells, level))

        def split(g, sums, state=state):
            _, _, _, path, weights, groups, _, fits, cells, _ = state.value
            x = groups[g]
            feats = _subsets(path[x.lo:x.hi], d, cells[x.fit])
            w = weights[x.lo:x.hi]
            fit, total = fits[x.fit], sums[:, 0].sum(axis=1)
            if state.value[-1] == 0:   # the root: class weights follow from the bootstrap's counts
                w = _class_weights(fit, total)
            return (*_best(sums, feats, fit.impurity, fit.leaf, w), w)

        def summed(part, state=state):
            model, slot_of, seeds, path, _, groups, by_data, fits, cells, level = state.value
            for c, b in part:
                for g in by_data.get(b.data, [])[c::chunks]:
                    x = groups[g]
                    at = slot_of[_descend(model, np.arange(x.first, x.last), b.bins, level)] - x.lo
                    w = _bootstrap(b.key, seeds[x.first:x.last])
                    t, row = np.nonzero((at >= 0) & (at < x.hi - x.lo) & (w > 0))
                    n, y = w[t, row].astype(np.float64), b.y[row]
                    feats = _subsets(path[x.lo:x.hi], d, cells[x.fit])
                    sums = _sums(at[t, row], row, n * (1 - y), n * y, b.bins, feats, x.hi - x.lo)
                    yield (g, split(g, sums, state)) if whole else (g, sums)

        found = blocks.train.mapPartitions(summed)
        if not whole:
            found = found.reduceByKey(np.add).map(lambda x: (x[0], split(x[0], x[1])))
        got = dict(found.collect())
        state.unpersist()
        parents, keep, parts = [], [], []
        for g, x in enumerate(groups):
            if g not in got:
                continue   # no row of the dataset: its trees stay single leaves
            gain, feature, thr, left, total, w = got[g]
            if level == 0:
                weights[x.first:x.last] = w
                model.value[node[x.lo:x.hi]] = _share(total, w)
            ok = gain > 1e-9
            parents.append(node[x.lo:x.hi][ok])
            keep.append(np.arange(x.lo, x.hi)[ok])
            parts.append((feature[ok], thr[ok], left[ok], (total - left)[ok], w[ok]))
        if not parents:
            break
        feature, thr, left, right, w = (np.concatenate(p) for p in zip(*parts))
        parents, keep = np.concatenate(parents), np.concatenate(keep)
        at = model.grow(parents, feature, thr, _share(left, w), _share(right, w))
        node = np.column_stack((at, at + 1)).ravel()
        tree = np.repeat(tree[keep], 2)
        path = _mix(np.repeat(path[keep], 2) * np.uint64(2) + np.tile(np.arange(2, dtype=np.uint64), len(keep)))
        sums = np.stack((left, right), axis=1).reshape(-1, 2)
        leaf = np.array([f.leaf for f in fits])[tree_fit[tree]]
        mixed = (sums.min(axis=1) > 0) & (sums.sum(axis=1) >= 2 * leaf)
        node, tree, path = node[mixed], tree[mixed], path[mixed]
    ends = np.cumsum(sizes)
    return [(model, np.arange(e - n, e)) for n, e in zip(sizes, ends)]


def _class_weights(fit: Fit, total: np.ndarray) -> np.ndarray:
    """[tree, 2] from the bootstrap's class counts: ``balanced_subsample`` by tree, ``balanced`` by all trees' mean."""
    if fit.weight is None:
        return np.ones_like(total)
    if not isinstance(fit.weight, str):
        return np.repeat([[1.0, float(fit.weight)]], len(total), axis=0)
    n = total if fit.weight == "balanced_subsample" else np.repeat(total.mean(axis=0)[None, :], len(total), axis=0)
    return n.sum(axis=1, keepdims=True) / (2.0 * np.maximum(n, 1.0))


def _share(sums: np.ndarray, weights: np.ndarray) -> np.ndarray:
    s = sums * weights
    return s[:, 1] / np.maximum(s.sum(axis=1), 1e-12)


def _confusion(y: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """[tp, fp, fn, tn]"""
    y = y == 1
    return np.array([(y & hit).sum(), (~y & hit).sum(), (y & ~hit).sum(), (~y & ~hit).sum()])


def _cells_confusion(n: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """``_confusion`` of cells of n rows by class"""
    return np.array([n[hit, 1].sum(), n[hit, 0].sum(), n[~hit, 1].sum(), n[~hit, 0].sum()])


def _tested(blocks: Blocks, by_data: dict, score) -> dict[int, np.ndarray]:
    """Confusion counts of every fit over its dataset's test rows; ``score(fit, bins)`` is positive for class 1."""
    def run(part):
        for b in part:
            if b.test:
                for f in by_data.get(b.data, ()):
                    yield f, _confusion(b.y, score(f, b.bins) > 0)
    return dict(blocks.rdd.mapPartitions(run).reduceByKey(np.add).collect())


def forest_confusion(blocks: Blocks, fits: list[Fit], grown: list[tuple[Trees, np.ndarray]]) -> dict[int, np.ndarray]:
    """{number of the fit: [tp, fp, fn, tn]}; a row is class 1 if its trees' mean share is above one half."""
    out = {}
    models = {id(t): t for t, _ in grown}
    for model in models.values():   # fits of a batch share their arrays
        mine = {i: roots for i, (t, roots) in enumerate(grown) if t is model}
        by_data = defaultdict(list)
        for i in mine:
            by_data[fits[i].data].append(i)
        state = blocks.sc.broadcast((model, mine, max(fits[i].depth for i in mine)))

        def score(f, bins, state=state):
            trees, mine, depth = state.value
            share = np.zeros(len(bins))
            for lo in range(0, len(mine[f]), GROUP_TREES):
                share += trees.value[_descend(trees, mine[f][lo:lo + GROUP_TREES], bins, depth)].sum(axis=0)
            return share / len(mine[f]) - 0.5

        out |= _tested(blocks, dict(by_data), score)
    return out


# ---- boosted trees

class Boosted(NamedTuple):
    """Boosted trees by second-order steps of the logistic loss."""
    rounds: int = 200
    depth: int = 6
    rate: float = 0.1
    positive_weight: float = 1.0


#: rounds after which the rows' margins are stored anew
STORED_ROUNDS = 25


def _boosted_of(block: _Held, spec: Boosted) -> list[Trees]:
    """A dataset's model, grown in one task: the same steps as over many blocks, margins and nodes kept beside the cells,
    whose rows have the same gradient."""
    m, models = np.zeros(len(block.y)), []
    feats, row = np.arange(block.bins.shape[1])[None, :], np.arange(len(block.y))
    w = np.where(block.y == 1, spec.positive_weight, 1.0) * block.sizes()
    for _ in range(spec.rounds):
        p = 1.0 / (1.0 + np.exp(-m))
        g, h = w * (p - block.y), w * p * (1.0 - p)
        tree, slots, nodes = Trees(1), np.zeros(1, dtype=np.int64), np.zeros(len(row), dtype=np.int64)
        live, at = row, np.zeros(len(row), dtype=np.int64)   # rows of the level's nodes, and which
        for level in range(spec.depth):
            if not len(slots):
                break
            every = np.repeat(feats, len(slots), axis=0)
            gain, feature, thr, left, total = _best(_sums(at, live, g[live], h[live], block.bins, every, len(every)), every, "newton", 1.0, None)
            if level == 0:
                tree.value[0] = -spec.rate * total[0, 0] / (total[0, 1] + 1.0)
            ok = gain > 1e-9
            step = [-spec.rate * s[ok, 0] / (s[ok, 1] + 1.0) for s in (left, total - left)]
            first = tree.grow(slots[ok], feature[ok], thr[ok], *step)
            go = ok[at]
            live, at = live[go], at[go]
            at = 2 * (np.cumsum(ok) - 1)[at] + (block.bins[live, feature[at]] > thr[at])
            slots = np.column_stack((first, first + 1)).ravel()
            nodes[live] = slots[at]
        m = m + tree.value[nodes]
        models.append(tree)
    return models


def grow_boosted(blocks: Blocks, data: list[int], spec: Boosted) -> dict[int, list[Trees]]:
    """One boosted model per dataset; all grow in the same jobs, one per round and level.

    Margins are kept beside the blocks and stored in the checkpoint folder every ``STORED_ROUNDS`` rounds; in
    between, a task adds the latest trees' steps.
    """
    if blocks.local:
        def whole_model(x):
            train, _, [k] = x
            return [(k, _boosted_of(_held_to_boost(train), spec))] if train is not None else []

        found = dict(blocks.dealt({k: [(1, k)] for k in data}).flatMap(whole_model).collect())
        return {k: found.get(k) or [Trees(1) for _ in range(spec.rounds)] for k in data}
    models: dict[int, list[Trees]] = {k: [] for k in data}
    d = blocks.n_features
    feats = np.arange(d)[None, :]
    state = blocks.rdd.filter(lambda b: not b.test and b.data in models).map(lambda b: (b, np.zeros(len(b.y))))
    fresh: dict[int, list[Trees]] = {k: [] for k in data}
    whole = blocks.whole

    def margin(b, m, trees):
        for t in trees:
            m = m + t.value[_descend(t, np.zeros(1, dtype=np.int32), b.bins, spec.depth)[0]]
        return m

    for r in range(spec.rounds):
        trees = {k: Trees(1) for k in data}
        slots = {k: np.zeros(1, dtype=np.int64) for k in data}
        for level in range(spec.depth):
            slots = {k: s for k, s in slots.items() if len(s)}
            if not slots:
                break

            def summed(part, fresh=fresh, trees=trees, slots=slots, level=level):   # at most STORED_ROUNDS trees a model
                for b, m in part:
                    if b.data in slots:
                        p = 1.0 / (1.0 + np.exp(-margin(b, m, fresh[b.data])))
                        w = np.where(b.y == 1, spec.positive_weight, 1.0)
                        g, h = w * (p - b.y), w * p * (1.0 - p)
                        nodes = _descend(trees[b.data], np.zeros(1, dtype=np.int32), b.bins, level)[0]
                        of = np.full(len(trees[b.data].child), -1, dtype=np.int64)
                        of[slots[b.data]] = np.arange(len(slots[b.data]))
                        at = of[nodes]
                        row = np.flatnonzero(at >= 0)
                        every = np.repeat(feats, len(slots[b.data]), axis=0)
                        yield b.data, _sums(at[row], row, g[row], h[row], b.bins, every, len(every))

            def split(x):
                k, sums = x
                return k, _best(sums, np.repeat(feats, len(sums), axis=0), "newton", 1.0, None)

            found = state.mapPartitions(summed)
            got = dict((found if whole else found.reduceByKey(np.add)).map(split).collect())
            nxt = {}
            for k, (gain, feature, thr, left, total) in got.items():
                if level == 0:
                    trees[k].value[0] = -spec.rate * total[0, 0] / (total[0, 1] + 1.0)
                ok = gain > 1e-9
                step = [-spec.rate * s[ok, 0] / (s[ok, 1] + 1.0) for s in (left, total - left)]
                at = trees[k].grow(slots[k][ok], feature[ok], thr[ok], *step)
                nxt[k] = np.column_stack((at, at + 1)).ravel()
            slots = nxt
        for k in data:
            models[k].append(trees[k])
            fresh[k].append(trees[k])
        if (r + 1) % STORED_ROUNDS == 0 and r + 1 < spec.rounds:
            added = blocks.sc.broadcast(fresh)
            old, state = state, state.map(lambda x, added=added: (x[0], margin(x[0], x[1], added.value[x[0].data])))
            state.persist(StorageLevel.MEMORY_AND_DISK)
            state.checkpoint()
            state.count()
            old.unpersist()
            fresh = {k: [] for k in data}
    state.unpersist()
    return models


def boosted_confusion(blocks: Blocks, models: dict[int, list[Trees]], spec: Boosted) -> dict[int, np.ndarray]:
    state = blocks.sc.broadcast(models)

    def score(k, bins):
        return sum(t.value[_descend(t, np.zeros(1, dtype=np.int32), bins, spec.depth)[0]] for t in state.value[k])

    return _tested(blocks, {k: [k] for k in models}, score)


# ---- boosted stumps

class Stump(NamedTuple):
    feature: int
    thr: int       # bins up to this one go left
    left: int      # class on the left
    right: int
    alpha: float


def _votes_sums(table: np.ndarray, bins: np.ndarray, y: np.ndarray, n) -> np.ndarray:
    """``_sums`` of a round: rows (n of each) weighed by the votes so far."""
    every = np.arange(bins.shape[1])[None, :]
    m = table[every, bins].sum(axis=1)
    w = n * np.exp(np.clip(np.where(y == 1, -m, m) / 2.0, -300, 300))
    row = np.arange(len(w))
    return _sums(np.zeros(len(w), dtype=np.int64), row, w * (y == 0), w * (y == 1), bins, every, 1)


def _next_stump(sums: np.ndarray, model: list[Stump], table: np.ndarray) -> bool:
    """Add the stump of a round's sums to a model and its table of votes; False if it was the last one."""
    gain, feature, thr, left, total = _best(sums, np.arange(len(table))[None, :], "gini", 0.0, np.ones((1, 2)))
    sides = (left[0], (total - left)[0]) if gain[0] > 0 else (total[0], np.zeros(2))
    votes = [int(s[1] > s[0]) for s in sides] if gain[0] > 0 else [int(total[0, 1] > total[0, 0])] * 2
    err = sum(s[1 - v] for s, v in zip(sides, votes)) / total[0].sum()
    if err >= 0.5:
        return False
    alpha = math.log((1.0 - err) / max(err, 1e-10)) if err > 1e-10 else math.log(1e10)
    model.append(Stump(int(feature[0]), int(thr[0]), *votes, alpha))
    table[feature[0], :thr[0] + 1] += alpha * (2 * votes[0] - 1)
    table[feature[0], thr[0] + 1:] += alpha * (2 * votes[1] - 1)
    return err > 1e-10


def _stumps_of(held: _Held, rounds: int) -> list[Stump]:
    """A dataset's model, grown in one task on its cells."""
    model, table, n = [], np.zeros((held.bins.shape[1], BINS)), held.sizes()
    for _ in range(rounds):
        if not _next_stump(_votes_sums(table, held.bins, held.y, n), model, table):
            break
    return model


def grow_stumps(blocks: Blocks, data: list[int], rounds: int = 150) -> dict[int, list[Stump]]:
    """SAMME boosting of depth-1 trees, one model per dataset.

    ``table[feature, bin]`` adds up the votes of a model's stumps, so that a row's weight is exp(-y margin / 2) with
    the margin a sum of d lookups.  A round's sums are d x 32 x 2 numbers a dataset, whatever the rows; datasets of more
    than ``LOCAL_ROWS`` rows take one job per round for all of them.
    """
    if blocks.local:
        def whole_model(x):
            train, _, [k] = x
            return [(k, _stumps_of(_held_to_boost(train), rounds))] if train is not None else []

        found = dict(blocks.dealt({k: [(1, k)] for k in data}).flatMap(whole_model).collect())
        return {k: found.get(k, []) for k in data}
    tables = {k: np.zeros((blocks.n_features, BINS)) for k in data}
    models: dict[int, list[Stump]] = {k: [] for k in data}
    live = set(data)
    for _ in range(rounds):
        if not live:
            break

        def summed(part, tables={k: tables[k] for k in live}):
            for b in part:
                if not b.test and b.data in tables:
                    yield b.data, _votes_sums(tables[b.data], b.bins, b.y, 1.0)

        found = blocks.rdd.mapPartitions(summed)
        found = dict((found if blocks.whole else found.reduceByKey(np.add)).collect())
        for k in list(live):   # a dataset without rows has no sums
            if k not in found or not _next_stump(found[k], models[k], tables[k]):
                live.discard(k)
    return models


def vote_table(stumps: list[Stump], d: int) -> np.ndarray:
    table = np.zeros((d, BINS))
    for s in stumps:
        table[s.feature, :s.thr + 1] += s.alpha * (2 * s.left - 1)
        table[s.feature, s.thr + 1:] += s.alpha * (2 * s.right - 1)
    return table


def stump_confusion(blocks: Blocks, models: dict[int, list[Stump]]) -> dict[int, np.ndarray]:
    d = blocks.n_features
    state = blocks.sc.broadcast({k: vote_table(v, d) for k, v in models.items()})

    def score(k, bins):
        return state.value[k][np.arange(d)[None, :], bins].sum(axis=1)

    return _tested(blocks, {k: [k] for k in models}, score)


# ---- models as rows

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, weight double"


def node_rows(trees: Trees, roots, edges: list[np.ndarray], weight: float = 1.0, first_tree: int = 0) -> list[tuple]:
    """One row per node: rows with a feature value up to the threshold go left; leaves have no feature."""
    out = []
    for t, root in enumerate(roots):
        queue = [int(root)]
        number = {int(root): 0}
        while queue:
            n = queue.pop(0)
            c = int(trees.child[n])
            if c < 0:
                out.append((first_tree + t, number[n], None, None, None, None, float(trees.value[n]), weight))
                continue
            for x in (c, c + 1):
                number[x] = len(number)
                queue.append(x)
            f = int(trees.feature[n])
            out.append((first_tree + t, number[n], f, _edge(edges[f], int(trees.thr[n])), number[c], number[c + 1],
                        float(trees.value[n]), weight))
    return out


def _edge(edges: np.ndarray, b: int) -> float:
    return float(edges[min(b, len(edges) - 1)])


def stump_rows(stumps: list[Stump], edges: list[np.ndarray]) -> list[tuple]:
    """The same rows for stumps: three nodes each, leaves vote -1 or 1, ``weight`` is alpha."""
    out = []
    for t, s in enumerate(stumps):
        out += [(t, 0, s.feature, _edge(edges[s.feature], s.thr), 1, 2, 0.0, s.alpha),
                (t, 1, None, None, None, None, 2.0 * s.left - 1, s.alpha), (t, 2, None, None, None, None, 2.0 * s.right - 1, s.alpha)]
    return out


def score_rows(df: DataFrame, nodes: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with ``tree_score``: the weighted sum of a stored model's leaf values.

    The model (``node_rows``) is as large as its number of nodes, which its fit bounds, and goes to the tasks whole.
    """
    got = nodes.orderBy("tree", "node").collect()
    models: dict = {}
    for r in got:
        models.setdefault(r["tree"], []).append(r)
    arrays = {}
    for t, rows in models.items():
        leaf = np.array([r["feature"] is None for r in rows])
        arrays[t] = (leaf, np.array([r["feature"] or 0 for r in rows]), np.array([r["threshold"] or 0.0 for r in rows]),
                     np.array([r["left"] or 0 for r in rows]), np.array([r["value"] for r in rows]), rows[0]["weight"])
    sent = df.sparkSession.sparkContext.broadcast(arrays)
    columns = list(features)

    @F.pandas_udf("double")
    def score(*values: pd.Series) -> pd.Series:
        x = np.column_stack([v.to_numpy(dtype=np.float64) for v in values])
        total, row = np.zeros(len(x)), np.arange(len(x))
        for leaf, feature, thr, left, value, weight in sent.value.values():
            node = np.zeros(len(x), dtype=np.int64)
            while not leaf[node].all():
                right = x[row, feature[node]] > thr[node]
                node = np.where(leaf[node], node, left[node] + right)
            total += weight * value[node]
        return pd.Series(total)

    return df.withColumn("tree_score", score(*[F.col(c).cast("double") for c in columns]))
