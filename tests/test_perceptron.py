"""Perceptrons fitted together on summed gradients, against Spark ML's own fit."""
import numpy as np
import pytest

from tarmac.operators import perceptron as PC
from tarmac.plans import ml as ML

FEATURES = ["a", "b", "c", "d"]
SCHEMA = "data int, is_test boolean, row_id long, label int, features array<double>"


def rows_of(data, n, seed, test=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = x[:, 0] + 0.7 * x[:, 1] * x[:, 3] + rng.normal(scale=0.4, size=n) > 0.3
    return [(data, i < test, i, int(t), [float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]


def folds_of(spark, rows):
    return ML.Folds(spark.createDataFrame(rows, SCHEMA).coalesce(1), FEATURES)


def minimum(fun, x, max_iter=200, tol=0.0):
    fit = PC.lbfgs(np.array(x, dtype=float), max_iter, tol)
    at = next(fit)
    while True:
        try:
            at = fit.send(fun(at))
        except StopIteration as end:
            return end.value


def test_lbfgs_finds_the_minimum_of_a_bent_valley():
    def fun(p):
        x, y = p
        return 100 * (y - x * x) ** 2 + (1 - x) ** 2, np.array([-400 * x * (y - x * x) - 2 * (1 - x), 200 * (y - x * x)])

    x, losses = minimum(fun, [-1.2, 1.0])
    assert np.allclose(x, 1.0, atol=1e-5) and all(b < a for a, b in zip(losses, losses[1:]))
    assert len(minimum(fun, [-1.2, 1.0], 7)[1]) == 8


def test_gradient_is_that_of_the_loss_for_more_classes_and_layers():
    layers, rng = [3, 5, 4, 3], np.random.default_rng(1)
    w = rng.normal(size=sum(a * b for a, b in PC.shapes(layers)))
    x, y = np.vstack([rng.normal(size=(3, 9)), np.ones(9)]), rng.integers(0, 3, 9).astype(np.uint8)

    def at(v):
        net = PC.Network(layers, v)
        net.add(x[:, :6], y[:6])
        net.add(x[:, 6:], y[6:])
        return net.sums()

    grad, e = at(w)[1], 1e-6
    found = [(at(w + e * u)[0] - at(w - e * u)[0]) / (2 * e) for u in np.eye(len(w))]
    assert np.allclose(grad, found, atol=1e-5)


def test_perceptrons_equal_spark_mls_fits(spark):
    """At most 128 rows are one block of Spark ML's, whose mean over blocks is then the mean over rows."""
    folds = folds_of(spark, rows_of(0, 120, 3) + rows_of(4, 90, 5))
    fits = ML.perceptrons(folds, [0, 4], {"maxIter": 25})
    for k in (0, 4):
        own = ML.make_model("mlp", {"maxIter": 25}, 42, 4).fit(folds.vectors.filter(f"data = {k}").coalesce(1))
        assert np.allclose(fits[k].weights.toArray(), own.weights.toArray(), atol=1e-6)
    stopped = ML.perceptrons(folds, [4], {"tol": 0.05})[4]
    own = ML.make_model("mlp", {"tol": 0.05}, 42, 4).fit(folds.vectors.filter("data = 4").coalesce(1))
    assert len(own.summary().objectiveHistory) < 100 and np.allclose(stopped.weights.toArray(), own.weights.toArray(), atol=1e-6)
    folds.release()


def test_all_training_rows_of_one_file_are_dealt_over_all_tasks(spark, monkeypatch):
    """One job a round serves all datasets, whose rows lie evenly in the tasks however few files held them."""
    monkeypatch.setattr(PC, "BLOCK", 64)
    folds = folds_of(spark, rows_of(0, 2000, 3, 400) + rows_of(1, 1000, 5))
    blocks = PC.Blocks(folds.vectors, 4)
    cores = spark.sparkContext.defaultParallelism
    held = blocks.rdd.mapPartitions(lambda bs: [[(d, len(y)) for d, _, y in bs]]).collect()
    for data, n in ((0, 1600), (1, 1000)):
        own = [sum(k for d, k in task if d == data) for task in held]
        assert len(own) == cores and sum(own) == blocks.counts[data] == n and max(own) < 1.6 * n / cores
    asked = []
    real = PC.Blocks.evaluate
    monkeypatch.setattr(PC.Blocks, "evaluate", lambda self, layers, points: asked.append(sorted(points)) or real(self, layers, points))
    start = np.random.default_rng(0).normal(size=sum(a * b for a, b in PC.shapes([4, 6, 2])))
    found = PC.fit(blocks, [4, 6, 2], [0, 1, 7], start, 3, 1e-4)
    assert asked[0] == [0, 1] and len(asked) < 12 and (found[7] == start).all() and not (found[0] == start).all()
    blocks.release()
    folds.release()


def test_rows_that_spark_ml_refuses_are_refused(spark):
    for label, value in ((None, 1.0), (2, 1.0), (1, float("nan"))):
        folds = folds_of(spark, [*rows_of(0, 20, 3), (0, False, 99, label, [value, 0.0, 0.0, 0.0])])
        with pytest.raises(Exception, match="labels must be 0 to 1"):
            ML.perceptrons(folds, [0], {"maxIter": 2})
        folds.release()
