"""Tree models against row-wise twins, and the model queries run to their end on small settings."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import trees as TR
from tarmac.plans import learning_q as L
from tarmac.plans import ml as ML
from tarmac.session import ship_package

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def xy(spark):
    ship_package(spark)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)).round(2)
    x[:, 3] = (x[:, 3] > 0.5).astype(float)
    y = ((x[:, 0] + 0.7 * x[:, 1] * x[:, 3] + rng.normal(scale=0.4, size=400)) > 0.6).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, label int").persist()


def folds_of(xy, k=3):
    return ML.Folds(ML._union(ML.prepare_folds(xy, FEATURES, None, k, 42)), FEATURES)


def in_small_blocks(spark, xy, k=3):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        folds = folds_of(xy, k)
        assert not folds.blocks.whole and folds.blocks.rdd.count() > 3 * k
        return folds
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def same(t1, t2):
    return all(np.allclose(getattr(t1, c), getattr(t2, c)) for c in ("feature", "thr", "child", "value"))


FITS = [TR.Fit(f, 7, 9, 6, 2, s, i, w) for f in range(3) for s, i, w in
        [("sqrt", "gini", None), ("0.5", "entropy", "balanced"), ("log2", "gini", "balanced_subsample"), ("1.0", "gini", 2.4)]]


def test_models_do_not_depend_on_blocks(spark, xy, monkeypatch):
    whole, cut = folds_of(xy), in_small_blocks(spark, xy)
    a = TR.grow_forests(whole.blocks, FITS)
    monkeypatch.setattr(TR, "CELLS", 512)   # many groups
    monkeypatch.setattr(TR, "BATCH_TREES", 30)   # several batches
    b = TR.grow_forests(cut.blocks, FITS)
    assert TR.forest_confusion(whole.blocks, FITS, a) != {}
    one, two = (TR.forest_confusion(x.blocks, FITS, g) for x, g in ((whole, a), (cut, b)))
    assert {k: v.tolist() for k, v in one.items()} == {k: v.tolist() for k, v in two.items()}
    spec = TR.Boosted(rounds=4, depth=3)
    monkeypatch.setattr(TR, "STORED_ROUNDS", 2)
    g1, g2 = (TR.grow_boosted(x.blocks, [0, 1], spec) for x in (whole, cut))
    assert all(same(s, t) for k in (0, 1) for s, t in zip(g1[k], g2[k]))
    assert TR.grow_stumps(whole.blocks, [0, 2], 5).keys() == {0, 2}
    for s, t in zip(TR.grow_stumps(whole.blocks, [0], 6)[0], TR.grow_stumps(cut.blocks, [0], 6)[0]):
        assert s[:4] == t[:4] and math.isclose(s.alpha, t.alpha)


def test_trees_grown_in_one_task_equal_those_grown_by_level(spark, xy, monkeypatch):
    """Datasets of several blocks: whole trees per task give the trees and scores of one job per level."""
    local = in_small_blocks(spark, xy)
    monkeypatch.setattr(TR, "LOCAL_ROWS", 10)
    level = in_small_blocks(spark, xy)
    assert local.blocks.local and not level.blocks.local
    fits = [*FITS, TR.Fit(0, 3, 70, 9, 1), TR.Fit(1, 3, 2, 1), TR.Fit(2, 3, 3, 30, 1)]
    monkeypatch.setattr(TR, "PAIRS", 1000)
    a, b = (TR.grow_forests(x.blocks, fits) for x in (local, level))
    assert [[nested(t, r) for r in roots] for t, roots in a] == [[nested(t, r) for r in roots] for t, roots in b]
    want = TR.forest_confusion(level.blocks, fits, b)
    for x in (local, level):
        assert {k: v.tolist() for k, v in TR.forest_counts(x.blocks, fits).items()} == {k: v.tolist() for k, v in want.items()}
    spec = TR.Boosted(rounds=5, depth=4, positive_weight=2.4)
    g1, g2 = (TR.grow_boosted(x.blocks, [0, 2], spec) for x in (local, level))
    assert all(same(s, t) for k in (0, 2) for s, t in zip(g1[k], g2[k]))


def test_search_and_boosting_need_few_jobs(spark, xy):
    """A forest search and boosted trees of several blocks take a bounded number of jobs, not one a level and round."""
    folds = in_small_blocks(spark, xy)
    sc = spark.sparkContext
    sc.setJobGroup("few", "few")
    try:
        folds.blocks
        before = len(sc.statusTracker().getJobIdsForGroup("few"))
        TR.forest_counts(folds.blocks, FITS)
        TR.grow_boosted(folds.blocks, [0, 1, 2], TR.Boosted(rounds=10, depth=4))
        assert len(sc.statusTracker().getJobIdsForGroup("few")) - before <= 4
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_forests_on_cells_equal_those_on_rows(spark, monkeypatch):
    """More rows than a task takes, of few different bins, one of them a hot one: few jobs, the same trees and scores."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, [9, 7, 3, 2], size=(3000, 4)).astype(float)
    x[rng.random(3000) < 0.4] = [2.0, 3.0, 1.0, 0.0]
    y = ((x[:, 0] + x[:, 1] * x[:, 3] + rng.normal(scale=2.0, size=3000)) > 5).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    xy = spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, label int")
    fits = [*FITS, TR.Fit(0, 3, 70, 9, 1, "sqrt", "gini", "balanced"), TR.Fit(1, 3, 70, 4, 1, "1.0", "gini", "balanced_subsample")]
    local = in_small_blocks(spark, xy)
    assert local.blocks.local
    want, counts = TR.grow_forests(local.blocks, fits), TR.forest_counts(local.blocks, fits)
    monkeypatch.setattr(TR, "LOCAL_ROWS", 1500)
    monkeypatch.setattr(TR, "BATCH_TREES", 100)   # several batches
    cells = in_small_blocks(spark, xy)
    sc = spark.sparkContext
    sc.setJobGroup("cells", "cells")
    try:
        assert not cells.blocks.local
        before = len(sc.statusTracker().getJobIdsForGroup("cells"))
        found = TR.forest_counts(cells.blocks, fits)
        assert len(sc.statusTracker().getJobIdsForGroup("cells")) - before <= 2 + 2 * 3   # sizes, then two a batch
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert {k: v.tolist() for k, v in found.items()} == {k: v.tolist() for k, v in counts.items()}
    assert cells.blocks.cells.local and cells.blocks.cells.most < 600
    grown = TR.grow_forests(cells.blocks, fits)
    assert [[nested(t, r) for r in roots] for t, roots in grown] == [[nested(t, r) for r in roots] for t, roots in want]
    cells.blocks.release()


def arrays(folds, data, test):
    got = [b for b in folds.blocks.rdd.collect() if b.data == data and b.test == test]
    return (np.concatenate([b.key for b in got]), np.concatenate([b.y for b in got]), np.concatenate([b.bins for b in got]))


def gini(w0, w1):
    n = w0 + w1
    return n - (w0 ** 2 + w1 ** 2) / n if n else 0.0


def brute_tree(y, w, bins, depth, leaf):
    """Nested (feature, bin, left, right) or class 1's share, all features tried."""
    tot = (w[y == 0].sum(), w[y == 1].sum())
    best = (1e-9, None)
    if depth and min(tot) > 0 and sum(tot) >= 2 * leaf:
        for f in range(bins.shape[1]):
            for b in range(TR.BINS - 1):
                left = bins[:, f] <= b
                lo, hi = ((w[m & (y == 0)].sum(), w[m & (y == 1)].sum()) for m in (left, ~left))
                if min(sum(lo), sum(hi)) >= leaf:
                    gain = gini(*tot) - gini(*lo) - gini(*hi)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, b))
    if best[1] is None:
        return tot[1] / max(sum(tot), 1e-12)
    f, b = best[1]
    left = bins[:, f] <= b
    return (f, b, *(brute_tree(y[m], w[m], bins[m], depth - 1, leaf) for m in (left, ~left)))


def nested(t, n):
    c = int(t.child[n])
    return float(t.value[n]) if c < 0 else (int(t.feature[n]), int(t.thr[n]), nested(t, c), nested(t, c + 1))


def flat(x):
    return [v for part in x for v in flat(part)] if isinstance(x, tuple) else [x]


def test_forest_trees_match_brute_force(xy):
    folds = folds_of(xy)
    [(t, roots)] = TR.grow_forests(folds.blocks, [TR.Fit(1, 5, 4, 4, 3, "1.0")])
    key, y, bins = arrays(folds, 1, False)
    seeds = TR._mix(np.arange(4, dtype=np.uint64) ^ TR._mix(np.array([5], dtype=np.uint64)) + np.uint64(1))
    for root, w in zip(roots, TR._bootstrap(key, seeds).astype(float)):
        assert 0.9 < w.mean() < 1.1 or len(w) < 300
        assert np.allclose(flat(nested(t, root)), flat(brute_tree(y, w, bins, 4, 3)))


def test_stumps_match_row_wise_boosting(xy):
    folds = folds_of(xy)
    found = TR.grow_stumps(folds.blocks, [0], 12)[0]
    _, y, bins = arrays(folds, 0, False)
    w = np.ones(len(y))
    for s in found:
        t = brute_tree(y, w, bins, 1, 0)
        votes = [int(v > 0.5) for v in t[2:]]
        miss = np.where(bins[:, t[0]] <= t[1], votes[0], votes[1]) != y
        err = w[miss].sum() / w.sum()
        assert (s.feature, s.thr, s.left, s.right) == (*t[:2], *votes) and math.isclose(s.alpha, math.log((1 - err) / err))
        w = w * np.exp(s.alpha * miss)


def test_boosted_trees_lower_the_loss(xy):
    folds = folds_of(xy)
    spec = TR.Boosted(rounds=10, depth=3)
    trees = TR.grow_boosted(folds.blocks, [0], spec)[0]
    _, y, bins = arrays(folds, 0, False)
    m, losses = np.zeros(len(y)), []
    for t in trees:
        p = 1 / (1 + np.exp(-m))
        losses.append(-np.log(np.where(y == 1, p, 1 - p)).sum())
        leaf = TR._descend(t, np.zeros(1, dtype=np.int32), bins, 3)[0]
        for n in np.unique(leaf):   # every leaf takes the second-order step of its rows
            g, h = (p - y)[leaf == n].sum(), (p * (1 - p))[leaf == n].sum()
            assert math.isclose(t.value[n], -0.1 * g / (h + 1), rel_tol=1e-9)
        m = m + t.value[leaf]
    assert all(b < a for a, b in zip(losses, losses[1:]))


@pytest.mark.parametrize("model", ["forest", "adaboost", "boosted"])
def test_saved_model_scores_like_the_fit(spark, xy, monkeypatch, model):
    monkeypatch.setitem(ML.FOREST, "numTrees", 7)
    monkeypatch.setitem(ML.BOOSTED, "rounds", 5)
    monkeypatch.setattr(ML, "ADABOOST_ROUNDS", 6)
    facts = ML.refit(xy, FEATURES, model)
    assert facts["fitted_rows"] == facts["all_rows"] == 400
    scored = TR.score_rows(xy, spark.read.parquet(f"{facts['path']}/nodes"), FEATURES)
    cut = 0.5 if model == "forest" else 0.0
    right = scored.filter((F.col("tree_score") > cut) == (F.col("label") == 1)).count()
    assert right > 330 and spark.read.parquet(f"{facts['path']}/scaler").count() == 1


def test_datasets_without_rows_or_with_one_class(spark, xy):
    one = xy.withColumn("label", F.lit(0))
    for model in ("forest", "adaboost", "boosted"):
        rows = ML.cross_validate(one.limit(30), FEATURES, model, None, None, 3, 42,
                                 {"forest": {"numTrees": 3}, "adaboost": {"rounds": 3}, "boosted": {"rounds": 2}}[model])
        assert len(rows) == 3 and all(r["tp"] == r["fn"] == r["fp"] == 0 and r["tn"] == 10 for r in rows)


# ---- the registered queries, to their end

@pytest.fixture
def small(monkeypatch):
    monkeypatch.setitem(ML.SEARCH_SPACE, "numTrees", [2, 3, 4, 5])
    monkeypatch.setitem(ML.FOREST, "numTrees", 5)
    monkeypatch.setitem(ML.BOOSTED, "rounds", 3)
    monkeypatch.setattr(ML, "ADABOOST_ROUNDS", 4)
    monkeypatch.setattr(ML, "MLP_MAX_ITER", 3)


def test_search_scores_all_candidates(spark, small):
    rows = L.search(spark, SF_SMALL).collect()
    assert len(rows) == 40 and sorted(r["candidate"] for r in rows) == list(range(40))
    by_f1 = sorted(rows, key=lambda r: -r["mean_test_f1"])
    assert by_f1[0]["rank_test_f1"] == 1 and all(r["rank_test_f1"] == 1 + sum(q["mean_test_f1"] > r["mean_test_f1"] for q in rows)
                                                 for r in rows)
    base = ML.best_params([r.asDict() for r in rows])
    assert "weight" not in base and base["numTrees"] in (2, 3, 4, 5)


def test_sweep_log_resumes_and_feeds_the_summaries(spark, small, monkeypatch):
    real, asked = ML.run_sweep, []

    def counted(*args, strategies, **kw):
        asked.append([s[0] for s in strategies])
        return real(*args, strategies=strategies, **kw)

    monkeypatch.setattr(ML, "run_sweep", counted)
    every = list(ML.STRATEGIES)
    monkeypatch.setattr(ML, "STRATEGIES", every[:3])
    assert L.sweep(spark, SF_SMALL).count() == 3 * 6
    monkeypatch.setattr(ML, "STRATEGIES", every)   # the run goes on where it was stopped
    rows = L.sweep(spark, SF_SMALL).collect()
    assert asked == [[s[0] for s in every[:3]], [s[0] for s in every[3:]]]
    assert len(rows) == 7 * 6 and {r["scheme"] for r in rows} == {"stratified_kfold", "later_ids"}
    s = L.sweep_summary(spark, SF_SMALL).collect()
    assert len(s) == 14 and all(r["runs"] == r["files"] == 1 and r["run_ids"] == [1] for r in s) and len(asked) == 2
    by = {(r["strategy"], r["scheme"]): r["mean_f1"] for r in s}
    for r in L.sweep_gap(spark, SF_SMALL).collect():
        assert math.isclose(r["gap"], by[r["strategy"], "stratified_kfold"] - by[r["strategy"], "later_ids"], abs_tol=2e-6)
    effects = L.search_effects(spark, SF_SMALL).collect()
    assert sum(r["n"] for r in effects) == 40 * len(ML.SEARCH_SPACE)


def test_grid_writes_a_document_per_configuration_and_resumes(spark, small, monkeypatch):
    from tarmac.plans import grid as GR
    assert len(GR.grid_configs()) == 120 and len({GR.run_key(c) for c in GR.grid_configs()}) == 120
    configs = GR.grid_configs((5, 15), ("label",), ("undersample",), (1, 2))
    run = GR.departure_runs(spark, SF_SMALL, ("forest", "nb"), {"forest": {"numTrees": 3}}, k=2)
    log, seen = GR.RunLog(spark, f"grid-{id(configs)}"), []

    def stopped(c):
        if len(seen) == 2:
            raise RuntimeError("stopped")
        seen.append(c)
        return run(c)

    with pytest.raises(RuntimeError):
        GR.run_grid(log, configs, stopped)
    assert len(log.finished()) == 2
    assert GR.run_grid(GR.RunLog(spark, f"grid-{id(configs)}"), configs, run) == 2 and GR.run_grid(log, configs, run) == 0
    docs = log.documents()
    assert docs.count() == 4 and docs.filter("dataset.row_count > 0 and dataset.feature_count > 0").count() == 4
    s = GR.summary(docs).collect()
    assert len(s) == 4 and {(r["threshold"], r["encoding"], r["resampling"], r["model"]) for r in s} == {
        (t, "label", "undersample", m) for t in (5, 15) for m in ("forest", "nb")}
    assert all(r["runs"] == 2 and r["run_ids"] == [1, 2] and len(r["files"]) == 2 for r in s)


def test_final_refit_compares_five_and_saves_the_winner(spark, small):
    rows = L.final_refit(spark, SF_SMALL).collect()
    assert len(rows) == 5 and len({r["model"] for r in rows}) == 1
    path, model = rows[0]["path"], rows[0]["model"]
    assert rows[0]["all_rows"] == L.documents_xy(spark, SF_SMALL).count() and rows[0]["fitted_rows"] > 0
    assert spark.read.parquet(f"{path}/scaler").count() == 1
    if model in ("forest", "boosted", "adaboost"):
        assert spark.read.parquet(f"{path}/nodes").filter("node = 0").count() > 0


def test_forests_in_a_task_see_cells_and_share_draws(monkeypatch):
    """Rows of equal bins and class are one cell, a tree's weights are drawn once for all fits: the trees of all rows."""
    rng = np.random.default_rng(5)
    bins = rng.integers(0, [9, 7, 3, 2], size=(3000, 4)).astype(np.uint8)
    y = ((bins[:, 0] + bins[:, 1] * bins[:, 3] + rng.normal(scale=2.0, size=3000)) > 5).astype(np.uint8)
    block = TR.Block(0, False, TR._mix(np.arange(3000, dtype=np.uint64)), y, bins)
    draw, grow, drawn, seen = TR._bootstrap, TR._trees_of, [], []
    monkeypatch.setattr(TR, "_bootstrap", lambda key, seeds: drawn.append(len(seeds)) or draw(key, seeds))
    monkeypatch.setattr(TR, "_trees_of", lambda bins, *a: seen.append(len(bins)) or grow(bins, *a))
    fits = [TR.Fit(0, 7, 20, 9, leaf, "0.5", i, w) for leaf, i, w in
            [(1, "gini", None), (2, "entropy", "balanced"), (4, "gini", "balanced_subsample"), (1, "entropy", 2.4)]]
    for sums in (1 << 26, 1 << 10):   # draws kept, and drawn anew
        monkeypatch.setattr(TR, "HELD_SUMS", sums)
        drawn.clear()
        held = TR._Held(block)
        got = [list(TR._forest_of(held, f, 0, n)) for f, n in zip(fits, (20, 20, 12, 20))]
        assert max(seen) <= 9 * 7 * 3 * 2 * 2 and (sum(drawn) == 20) == (sums > 1 << 20)
        for f, n, trees in zip(fits, (20, 20, 12, 20), got):
            w = draw(block.key, TR._seeds(f, 0, n)).astype(float)
            weights = TR._class_weights(f, np.column_stack((w @ (1 - y.astype(int)), w @ y)))
            want = list(grow(bins, y, f, 0, n, weights, lambda lo, hi: draw(block.key, TR._seeds(f, lo, hi))))
            assert [t for m, x in trees for t in (nested(x, r) for r in range(m))] == [t for m, x in want for t in (nested(x, r) for r in range(m))]
    key = TR._mix(np.arange(40000, dtype=np.uint64))
    u = (TR._mix(key) >> np.uint64(11)).astype(float) * 2.0 ** -53
    assert (draw(key, np.zeros(1, dtype=np.uint64))[0] == np.searchsorted(TR._POISSON, u, side="right")).all()


def test_boosted_trees_in_a_task_see_cells(monkeypatch):
    rng = np.random.default_rng(6)
    bins = rng.integers(0, [9, 7, 3, 2], size=(3000, 4)).astype(np.uint8)
    y = ((bins[:, 0] + bins[:, 1] * bins[:, 3] + rng.normal(scale=2.0, size=3000)) > 5).astype(np.uint8)
    block = TR.Block(0, False, TR._mix(np.arange(3000, dtype=np.uint64)), y, bins)
    assert (TR._held_to_boost(block).bins == bins).all()   # few rows stay as they are
    monkeypatch.setattr(TR, "SUMMED_ROWS", 3000)
    held = TR._held_to_boost(block)
    assert len(held.y) <= 9 * 7 * 3 * 2 * 2 and held.sizes().sum() == 3000
    spec = TR.Boosted(rounds=3, depth=3, positive_weight=2.4)
    m = np.zeros(3000)
    for t in TR._boosted_of(held, spec):
        p, w = 1 / (1 + np.exp(-m)), np.where(y == 1, 2.4, 1.0)
        root = TR._sums(np.zeros(3000, dtype=int), np.arange(3000), w * (p - y), w * p * (1 - p), bins, np.arange(4)[None], 1)
        gain, feature, thr, _, total = TR._best(root, np.arange(4)[None], "newton", 1.0, None)
        assert (t.feature[0], t.thr[0]) == (feature[0], thr[0])
        assert math.isclose(t.value[0], -spec.rate * total[0, 0] / (total[0, 1] + 1))
        m += t.value[TR._descend(t, np.zeros(1, dtype=np.int32), bins, 3)[0]]


@pytest.mark.parametrize("method", ["undersample", "smote", "smoteenn", "smotetomek"])
def test_datasets_resampled_together_equal_those_resampled_alone(spark, method):
    from tarmac.operators import resample as RS
    rng = np.random.default_rng(9)
    rows = [(k, i, *map(float, rng.integers(0, 12, 2) + 5 * (i % 4 == 0)), int(i % 4 == 0) if i % 11 else None)
            for k, n in ((3, 130), (7, 90)) for i in range(n)]
    rows += rows[:20]   # rows that come twice
    df = spark.createDataFrame(rows, "data int, row_id long, a double, b double, label int").persist()
    got = RS.resample(df, method, "label", ["a", "b"], 5, "row_id", "data").select("data", "row_id", "label", "a", "b").collect()
    want = [(k, *r) for k in (3, 7) for r in RS.resample(df.filter(F.col("data") == k).drop("data"), method, "label", ["a", "b"], 5)
            .select("row_id", "label", "a", "b").collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and len(want) > 60


def test_sweep_grows_and_searches_all_folds_together(spark, xy, monkeypatch):
    """The resamplings of a sweep take one SMOTE and one k-NN join each, not one per fold and strategy."""
    from tarmac.operators import resample as RS
    smote, knn, made, joined = RS.smote, RS.knn, [], []
    monkeypatch.setattr(RS, "smote", lambda *a, **kw: made.append(1) or smote(*a, **kw))
    monkeypatch.setattr(RS, "knn", lambda *a, **kw: joined.append(1) or knn(*a, **kw))
    split = xy.select("row_id", (F.col("row_id") >= 320).cast("int").alias("is_test"))
    rows = ML.run_sweep(xy, split, FEATURES, {"numTrees": 3}, 3)
    assert len(made) == 1 and len(joined) == 3
    assert len(rows) == 7 * 4 and all(sum(r[c] for c in ("tp", "fp", "fn", "tn")) == 80 for r in rows if r["scheme"] == "split")
    assert all(sum(sum(r[c] for c in ("tp", "fp", "fn", "tn")) for r in rows if (r["strategy"], r["scheme"]) ==
                   (s, "stratified_kfold")) == 400 for s, _, _ in ML.STRATEGIES)


def test_stumps_in_a_task_equal_those_of_a_job_a_round(spark, xy, monkeypatch):
    local = in_small_blocks(spark, xy)
    monkeypatch.setattr(TR, "LOCAL_ROWS", 10)
    rounds = in_small_blocks(spark, xy)
    assert local.blocks.local and not rounds.blocks.local
    sc = spark.sparkContext
    sc.setJobGroup("stumps", "stumps")
    try:
        got = TR.grow_stumps(local.blocks, [0, 1, 2], 12)
        assert len(sc.statusTracker().getJobIdsForGroup("stumps")) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    want = TR.grow_stumps(rounds.blocks, [0, 1, 2], 12)
    for k in (0, 1, 2):
        assert [s[:4] for s in got[k]] == [s[:4] for s in want[k]] and len(got[k]) > 3
        assert all(math.isclose(s.alpha, t.alpha) for s, t in zip(got[k], want[k]))


def test_a_step_removes_its_checkpoints_and_no_others(spark):
    import os

    from tarmac import session as SS

    def folder():
        return spark.sparkContext.getCheckpointDir().removeprefix("file:")

    kept = SS.checkpoint(spark.range(10))
    first = folder()
    with SS.step(spark):
        assert SS.checkpoint(spark.range(5)).count() == 5
        inner = folder()
        assert os.path.isdir(inner) and inner != first
    assert not os.path.exists(inner) and kept.count() == 10
