"""Multilayer perceptrons of several datasets, fitted together by L-BFGS.

The model is Spark ML's: sigmoid layers, softmax output, cross-entropy averaged
over the rows.  A round is one Spark job for all datasets: each task passes its
cached blocks of training rows through the networks and returns one loss and
one gradient a dataset; the driver holds weights only.  Steps, line search
(strong Wolfe) and stopping rules are those of Spark ML's own fit.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

BLOCK = 1024   # rows passed through a network at once: its layers' values stay in a core's cache
VALUES = 1 << 24   # feature values of a task's blocks, at most
CORRECTIONS = 10   # pairs of steps and gradient differences kept by L-BFGS
WINDOW = 20   # iterations over which the loss has to fall
SEARCH_STEPS = 10   # of a line search, and then of its bracket


def shapes(layers: Sequence[int]) -> list[tuple[int, int]]:
    """(inputs and one for the bias, outputs) of every layer; the flat weights are these matrices, row after row."""
    return [(a + 1, b) for a, b in zip(layers, layers[1:])]


class Network:
    """The network of flat weights; its work space serves block after block of up to ``BLOCK`` rows."""

    def __init__(self, layers: Sequence[int], weights: np.ndarray):
        mats, at = [], 0
        for a, b in shapes(layers):
            mats.append(weights[at:at + a * b].reshape(a, b))
            at += a * b
        self.forth = [np.ascontiguousarray(-m.T) for m in mats[:-1]] + [np.ascontiguousarray(mats[-1].T)]
        self.back = [np.ascontiguousarray(m[:-1]) for m in mats]
        self.space, self.n_classes = {}, layers[-1]
        self.loss, self.grads = 0.0, [np.zeros((m.shape[1], m.shape[0])) for m in mats]

    def _space(self, n: int):
        if n not in self.space:
            hidden = [len(m) for m in self.forth[:-1]]
            self.space = {n: ([np.ones((k + 1, n)) for k in hidden], [np.empty((k, n)) for k in hidden], np.empty((self.n_classes, n)))}
        return self.space[n]

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        """Add the rows' cross-entropy and its gradient; ``x`` holds a row a column, its last line is ones."""
        hidden, deltas, out = self._space(x.shape[1])
        values = [x, *hidden]
        for m, v, h in zip(self.forth, values, hidden):   # h is 1 / (1 + exp(-z)), below it a line of ones
            s = h[:-1]
            np.matmul(m, v, out=s)
            np.exp(s, out=s)
            s += 1.0
            np.reciprocal(s, out=s)
        np.matmul(self.forth[-1], values[-1], out=out)
        target = (y == np.arange(self.n_classes, dtype=np.uint8)[:, None]).astype(float)
        out -= out.max(axis=0)
        self.loss -= np.vdot(out, target)
        np.exp(out, out=out)
        total = out.sum(axis=0)
        self.loss += np.log(total).sum()
        out /= total
        out -= target
        delta = out
        for i in range(len(self.forth) - 1, -1, -1):
            self.grads[i] += delta @ values[i].T
            if i:
                s, d = hidden[i - 1][:-1], deltas[i - 1]
                np.matmul(self.back[i], delta, out=d)
                d *= s
                np.subtract(1.0, s, out=s)
                d *= s
                delta = d

    def sums(self) -> tuple[float, np.ndarray]:
        return float(self.loss), np.concatenate([g.T.ravel() for g in self.grads])


class Blocks:
    """Training rows of ``vectors(data, is_test, row_id, label, features)`` in blocks of ``BLOCK`` rows of a dataset.

    Every task holds about as many rows of each dataset, in a fixed order.  Close with ``release``.
    """

    def __init__(self, vectors: DataFrame, n_features: int, n_classes: int = 2):
        spark = vectors.sparkSession
        ship_package(spark)
        rows = vectors.filter("not is_test").select("data", "row_id", "label", vector_to_array("features").alias("features"))
        self.counts = {r["data"]: r["count"] for r in rows.groupBy("data").count().collect()}
        cores = spark.sparkContext.defaultParallelism
        tasks = cores * max(1, math.ceil(sum(self.counts.values()) * n_features / (cores * VALUES)))
        cols = ["data", "row_id", "label", "features"]

        def cut(frames):
            for pdf in frames:
                for data, part in pdf.groupby("data"):
                    x = np.stack(part["features"].to_numpy())
                    if not (part["label"].isin(range(n_classes)).all() and np.isfinite(x).all()):
                        raise ValueError(f"labels must be 0 to {n_classes - 1} and features finite numbers")
                    y = part["label"].to_numpy(dtype=np.uint8)
                    for i in range(0, len(x), BLOCK):
                        b = np.vstack([x[i:i + BLOCK].T, np.ones(len(x[i:i + BLOCK]))])
                        yield pd.DataFrame({"data": [data], "x": [b.tobytes()], "y": [y[i:i + BLOCK].tobytes()]})

        table = rows.repartition(tasks, *cols).sortWithinPartitions(*cols).mapInPandas(cut, "data int, x binary, y binary")
        self.rdd = table.rdd.coalesce(tasks).map(lambda r: (
            r["data"], np.frombuffer(r["x"]).reshape(n_features + 1, -1), np.frombuffer(r["y"], dtype=np.uint8))
        ).persist(StorageLevel.MEMORY_AND_DISK)

    def evaluate(self, layers: Sequence[int], points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        """Mean loss and gradient of every dataset at its point, in one job."""
        def sums(blocks):
            nets = {}
            with np.errstate(over="ignore"):   # of exp, whose reciprocal is 0 then
                for data, x, y in blocks:
                    if data in points:
                        if data not in nets:
                            nets[data] = Network(layers, points[data])
                        nets[data].add(x, y)
            yield {k: net.sums() for k, net in nets.items()}

        total = {k: [0.0, 0.0] for k in points}
        for part in self.rdd.mapPartitions(sums).collect():   # a loss and a gradient a dataset from each task
            for k, (loss, grad) in part.items():
                total[k] = [total[k][0] + loss, total[k][1] + grad]
        return {k: (loss / self.counts[k], grad / self.counts[k]) for k, (loss, grad) in total.items()}

    def release(self) -> None:
        self.rdd.unpersist()


class NoStep(Exception):
    """No step along the direction lowers the loss."""


def _cubic(a, b):
    """The minimum between points (step, loss, slope, ..) of the cubic through them, not too near to either."""
    (t1, f1, s1), (t2, f2, s2) = sorted([a[:3], b[:3]], key=lambda p: p[0])
    d1 = s1 + s2 - 3 * (f1 - f2) / (t1 - t2)
    d2 = np.sqrt(d1 * d1 - s1 * s2)
    t = t2 - (t2 - t1) * (s2 + d2 - d1) / (s2 - s1 + 2 * d2)
    if np.isnan(t):
        raise NoStep
    return min(max(t, t1 + 0.1 * (t2 - t1)), t1 + 0.9 * (t2 - t1))


def _line_search(x, direction, loss, grad, t):
    """Generator of points; returns (step, loss, slope, gradient) where the strong Wolfe conditions hold."""
    slope = grad @ direction
    if slope > 0:
        raise NoStep

    def at(t):
        f, g = yield x + t * direction
        return t, np.float64(f), g @ direction, g

    low, high = (np.float64(0.0), np.float64(loss), slope, grad), None
    for i in range(SEARCH_STEPS):
        c = yield from at(t)
        if not np.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > loss + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            high = c
            break
        if abs(c[2]) <= 0.9 * abs(slope):
            return c
        if c[2] >= 0:
            low, high = c, low
            break
        low = c
        t *= 1.5
    if high is None:
        raise NoStep
    for _ in range(SEARCH_STEPS):
        c = yield from at(_cubic(low, high))
        if c[1] > loss + 1e-4 * c[0] * slope or c[1] >= low[1]:
            high = c
            continue
        if abs(c[2]) <= 0.9 * abs(slope):
            return c
        if c[2] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise NoStep


def _direction(grad, steps, diffs):
    """The gradient times the inverse Hessian that the last steps tell, downwards."""
    d, pairs, scale = grad.copy(), [], 1.0
    if steps:
        sy = steps[0] @ diffs[0]
        if not sy >= 0:
            raise NoStep
        scale = sy / (diffs[0] @ diffs[0])
    for s, z in zip(steps, diffs):
        rho = s @ z
        a = (s @ d) / rho
        if np.isnan(a):
            raise NoStep
        d -= a * z
        pairs.append((s, z, rho, a))
    d *= scale
    for s, z, rho, a in reversed(pairs):
        d += (a - (z @ d) / rho) * s
    return -d


def lbfgs(x: np.ndarray, max_iter: int, tol: float):
    """Generator of points to evaluate, to which (loss, gradient) are sent; returns (weights, losses).

    Ends after ``max_iter`` iterations, when the loss fell by less than ``tol`` of the first one over ``WINDOW``
    iterations, when the gradient is small, or when two searches in a row, the second without history, find no step.
    """
    loss, grad = yield x
    first, losses = loss, [loss]
    recent = deque([math.inf], maxlen=WINDOW)
    steps, diffs = deque(maxlen=CORRECTIONS), deque(maxlen=CORRECTIONS)
    done, failed = 0, False
    while not (done >= max_iter or len(recent) > 1 and abs(loss - max(recent)) <= tol * first
               or np.linalg.norm(grad) <= max(tol * loss, 1e-8)):
        try:
            with np.errstate(all="ignore"):
                d = _direction(grad, steps, diffs)
                t = np.float64(1.0) if done else 1.0 / np.linalg.norm(d)
                step, new_loss, _, new_grad = yield from _line_search(x, d, loss, grad, t)
            if step * np.linalg.norm(grad) < 1e-10:
                raise NoStep
        except NoStep:
            if failed:
                break
            failed = True
            steps.clear()
            diffs.clear()
            continue
        new_x = x + step * d
        steps.appendleft(new_x - x)
        diffs.appendleft(new_grad - grad)
        x, loss, grad, failed = new_x, new_loss, new_grad, False
        done += 1
        recent.append(loss)
        losses.append(loss)
    return x, losses


def fit(blocks: Blocks, layers: Sequence[int], data: Sequence[int], start: np.ndarray, max_iter: int, tol: float) -> dict[int, np.ndarray]:
    """Weights of every dataset's network; one without training rows keeps the starting weights."""
    fits, found = {k: lbfgs(start.copy(), max_iter, tol) for k in data if blocks.counts.get(k)}, {}
    points = {k: next(f) for k, f in fits.items()}
    while points:
        asked, points = blocks.evaluate(layers, points), {}
        for k, got in asked.items():
            try:
                points[k] = fits[k].send(got)
            except StopIteration as end:
                found[k] = end.value[0]
    return {k: found.get(k, start) for k in data}
