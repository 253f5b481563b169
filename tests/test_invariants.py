"""Invariants of the rows-only operators and brute-force checks."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from tarmac.functions import special as SP
from tarmac.operators import knn as KNN
from tarmac.operators import ranks as RK
from tarmac.operators import resample as RS
from tarmac.operators import scaling as SC
from tarmac.operators import stats as ST
from tarmac.operators import validation as V
from tarmac.plans import learning_q as L
from tarmac.sources import tables as TB


def test_special_functions():
    assert abs(SP.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-12
    assert abs(SP.t_two_sided(2.228138851986274, 10) - 0.05) < 1e-12
    assert abs(SP.f_sf(4.964602743730711, 1, 10) - 0.05) < 1e-12
    assert abs(SP.norm_two_sided(-0.550) - 0.5823) < 1e-4
    assert SP.median_ci_ranks(101) == (41, 41, 61, 61)


def test_folds_balanced(spark):
    d = L.documents_xy(spark, SF_SMALL)
    f = V.stratified_folds(d, "label", 5, 42).groupBy("label", "fold").count().collect()
    by = {}
    for r in f:
        by.setdefault(r["label"], []).append(r["count"])
    for counts in by.values():
        assert max(counts) - min(counts) <= 1
    assert f  # non-empty


def test_undersample_equal_classes(spark):
    d = L.documents_xy(spark, SF_SMALL)
    c = {r["label"]: r["count"] for r in RS.undersample(d, "label").groupBy("label").count().collect()}
    assert len(set(c.values())) == 1


def test_smote_grows_minority_on_segments(spark):
    d = L.documents_xy(spark, SF_SMALL)
    before = {r["label"]: r["count"] for r in d.groupBy("label").count().collect()}
    s = RS.smote(d, "label", L.DOC_FEATURES, 5, 42).cache()
    after = {r["label"]: r["count"] for r in s.groupBy("label").count().collect()}
    assert after[0] == after[1] == max(before.values())
    # every synthetic point lies in the bounding box of the minority points (convex combinations)
    mino = min(before, key=before.get)
    syn = s.filter("synthetic = 1").toPandas()
    orig = d.filter(F.col("label") == mino).toPandas()
    for c in L.DOC_FEATURES:
        assert syn[c].min() >= orig[c].min() - 1e-9 and syn[c].max() <= orig[c].max() + 1e-9


def test_knn_matches_brute_force_with_duplicates(spark):
    e = TB.table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding", "label")
    # a hot duplicated vector: 30 copies of one embedding
    hot = e.limit(1).crossJoin(spark.range(30).withColumnRenamed("id", "_i")) \
        .select((F.col("_i") + 100000).alias("vec_id"), "embedding", "label")
    pts = e.unionByName(hot)
    got = KNN.knn(pts, "vec_id", "embedding", 5, group="label").select("vec_id", "j", "distance").toPandas()
    p = pts.toPandas()
    X = np.array([np.array(v, dtype=float) for v in p["embedding"]])
    ids, labs = p["vec_id"].to_numpy(), p["label"].to_numpy()
    exp = {}
    for i in range(len(p)):
        same = np.where((labs == labs[i]) & (np.arange(len(p)) != i))[0]
        dd = np.sqrt(((X[same] - X[i]) ** 2).sum(axis=1))
        exp[ids[i]] = sorted(dd)[:5]
    for vid, grp in got.groupby("vec_id"):
        assert np.allclose(sorted(grp["distance"]), exp[vid], atol=1e-9)
    assert set(got["vec_id"]) == set(ids)


def test_kruskal_matches_brute_force(spark):
    t = TB.transit(spark, SF_SMALL).select("o_orderpriority", "value").toPandas()
    k = ST.kruskal(TB.transit(spark, SF_SMALL), "o_orderpriority", "value").first()
    r = t["value"].rank().to_numpy()
    n = len(t)
    ss = sum(r[(t["o_orderpriority"] == g).to_numpy()].sum() ** 2 / (t["o_orderpriority"] == g).sum()
             for g in t["o_orderpriority"].unique())
    h = 12 / (n * (n + 1)) * ss - 3 * (n + 1)
    ties = t["value"].value_counts().to_numpy().astype(float)
    h /= 1 - (ties ** 3 - ties).sum() / (n ** 3 - n)
    assert math.isclose(k["H"], h, rel_tol=1e-9)


def test_median_ci_brackets_median(spark):
    t = TB.transit(spark, SF_SMALL)
    ci = ST.median_ci(t, "o_orderpriority", "value").toPandas().set_index("o_orderpriority")
    med = t.groupBy("o_orderpriority").agg(F.median("value").alias("m")).toPandas().set_index("o_orderpriority")
    for g in ci.index:
        assert ci.loc[g, "ci_lo"] <= med.loc[g, "m"] <= ci.loc[g, "ci_hi"]


def test_global_row_number_is_a_permutation(spark):
    d = TB.scan_departures(spark, SF_SMALL).select("row_id", "planned_ts")
    rn = RK.global_row_number(d, ["planned_ts", "row_id"]).toPandas().sort_values(["planned_ts", "row_id"])
    assert list(rn["rn"]) == list(range(1, len(rn) + 1))


def test_scaler_fitted_on_train_only(spark):
    d = L.departures_xy(spark, SF_SMALL).select("row_id", "lat", "lon", "elev", "distance_km", "day_of_month")
    train, test = d.filter("row_id % 2 = 0"), d.filter("row_id % 2 = 1")
    p = SC.fit(train)
    tt = SC.transform(test, p).toPandas().set_index("row_id")
    tr = train.toPandas()
    raw = test.toPandas().set_index("row_id")
    mu, sd = tr["lat"].mean(), tr["lat"].std(ddof=0)
    assert np.allclose(tt["lat"], (raw["lat"] - mu) / sd)


def test_chronological_split_is_time_ordered(spark):
    from tarmac.plans.windows_q import chronological_split
    s = chronological_split(spark, SF_SMALL).toPandas()
    n = len(s)
    assert s["is_test"].sum() == max(1, round(0.2 * n))
    assert s[s.is_test == 0]["planned_ts"].max() <= s[s.is_test == 1]["planned_ts"].min()


def test_proportion_ci_matches_simulation():
    rng = np.random.default_rng(0)
    k, n = 37, 120
    sims = rng.binomial(n, k / n, 200000) / n
    lo, hi = SP.proportion_ci(k, n)
    assert abs(lo - np.quantile(sims, 0.025)) <= 1.0 / n + 1e-12
    assert abs(hi - np.quantile(sims, 0.975)) <= 1.0 / n + 1e-12


def test_share_ci_brackets_share(spark):
    from tarmac.plans.stats_q import late_share_ci_day_part
    rows = late_share_ci_day_part(spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        assert r["ci_lo"] <= r["pct"] <= r["ci_hi"]


def test_smote_with_few_minority_rows_reaches_the_majority(spark):
    from tarmac.operators.resample import smote
    for few in (1, 2, 4, 5):
        rows = [(i, int(i < few), float(i), float(i * i % 7)) for i in range(20 + few)]
        out = smote(spark.createDataFrame(rows, "row_id long, y int, a double, b double"), "y", ["a", "b"])
        assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 20, 1: 20}


def test_knn_with_many_copies_and_one_outlier(spark):
    from tarmac.operators.knn import knn
    rows = [(i, [float(i // 10), 0.0]) for i in range(200)] + [(200, [1e6, 0.0])]
    out = knn(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 3).collect()
    assert len(out) == 3 * 201
    assert all(r["distance"] == 0 for r in out if r["id"] < 200)


def _brute_neighbours(x, y, k):
    """Per distinct (vector, label) the k nearest others with copies, and whether a tie makes the k-th ambiguous."""
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :k], np.sort(d, axis=1)


def _points(spark, n=260, seed=4):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.4, (n // 4, 3)) for c in (0.0, 1.0, 4.0, 9.0)])
    y = (rng.random(len(x)) < np.where(x[:, 0] > 0.6, 0.8, 0.2)).astype(int)
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))],
                               "row_id long, label int, a double, b double, c double")
    return x, y, df


def test_enn_equals_brute_force(spark):
    x, y, df = _points(spark)
    near, _ = _brute_neighbours(x, y, 3)
    want = {i for i in range(len(x)) if (y[near[i]] == y[i]).all()}
    assert {r["row_id"] for r in RS.enn_clean(df, "label", ["a", "b", "c"]).collect()} == want and 0 < len(want) < len(x)


def test_tomek_equals_brute_force(spark):
    x, y, df = _points(spark, seed=5)
    one = _brute_neighbours(x, y, 1)[0][:, 0]
    want = {i for i in range(len(x)) if not (one[one[i]] == i and y[one[i]] != y[i])}
    assert {r["row_id"] for r in RS.tomek_clean(df, "label", ["a", "b", "c"]).collect()} == want and 0 < len(want) < len(x)


@pytest.mark.parametrize("block", [1024, 16])
def test_knn_cells_are_exact_and_prune(spark, monkeypatch, block):
    """Clustered points: the same neighbours as all pairs, from few of them, whatever the size of a block."""
    monkeypatch.setattr(KNN, "BLOCK", block)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.05, (60, 4)) for c in range(20)])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    cells = KNN.Cells(KNN.distinct_points(df, "v", None, []), 4)
    assert cells.candidates() < 0.2 * len(x) ** 2
    _, d = _brute_neighbours(x, None, 4)
    got = np.full((len(x), 4), np.nan)
    for r in KNN.knn(df, "id", "v", 4).collect():
        got[r["id"], r["j"] - 1] = r["distance"]
    assert np.allclose(got, d[:, :4])


def test_knn_tells_each_point_once_per_tile(spark, monkeypatch):
    monkeypatch.setattr(KNN, "BLOCK", 16)
    x = np.random.default_rng(4).normal(size=(400, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    cells = KNN.Cells(KNN.distinct_points(df, "v", None, []), 3)
    blocks = cells.blocks.count()
    assert cells.pairs.count() > blocks * 10   # random vectors: nearly all pairs of blocks are compared
    assert cells.nearest(3).groupBy("no").count().agg({"count": "max"}).first()[0] == 3


def test_knn_prunes_departure_features(spark):
    x = L.departures_xy(spark, SF_CHECK, 15, "label")
    feats = [c for c in x.columns if c not in ("row_id", "label")]
    scaled, _, _ = SC.fit_transform(x)
    df = scaled.select("row_id", F.array(*[F.col(c).cast("double") for c in feats]).alias("v"))
    dv = KNN.distinct_points(df, "v", None, [])
    assert KNN.Cells(dv, 5).candidates() < 0.1 * dv.count() ** 2


def test_knn_tasks_get_a_block_once_a_tile(spark, monkeypatch):
    """Python gets a tile's blocks and each block they meet once, not a row with both blocks for every pair."""
    monkeypatch.setattr(KNN, "BLOCK", 16)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 3)).round(2)
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "row_id long, v array<double>")
    cells = KNN.Cells(KNN.distinct_points(df, "v", None, []), 4)
    blocks, pairs, met = cells.blocks.count(), cells.pairs.count(), cells._met()
    assert met.filter("wanted is null").count() == blocks
    assert met.filter("wanted is not null").groupBy("tile", "part", "cell", "sub").count().filter("count > 1").isEmpty()
    assert met.select(F.sum(F.size("wanted")).alias("n")).first()["n"] == pairs > 2 * met.count()
    plan = cells.nearest(4)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "ExistingRDD" not in plan.split("MapInArrow")[0]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for r in KNN.knn(df, "row_id", "v", 4).groupBy("row_id").agg(F.sort_array(F.collect_list("distance")).alias("d")).collect():
        assert np.allclose(r["d"], np.sort(d[r["row_id"]])[:4])


def test_samples_are_the_first_by_hash(spark):
    from tarmac.operators.windows import hash_key
    df = spark.range(5000).selectExpr("id * 7 as row_id", "cast(id % 10 = 0 as int) as label", "id").repartition(6)
    order = [r["row_id"] for r in df.withColumn("h", hash_key("row_id", 3)).orderBy("h", "row_id").collect()]
    label = {r["row_id"]: r["label"] for r in df.collect()}
    for n in (1, 40, 4999, 9000):
        assert {r["row_id"] for r in RS.sample_n(df, n, 3).collect()} == set(order[:n])
    got = {r["row_id"] for r in RS.undersample(df, "label", 3).collect()}
    assert got == {x for c in (0, 1) for x in [y for y in order if label[y] == c][:500]}
    s = RS.stratified_sample(df, "label", 37, 3)
    assert s.columns == df.columns and s.count() == 37 and RS.stratified_sample(df, "label", 6000, 3).count() == 5000
    assert RS.undersample(df.selectExpr("row_id", "if(id < 9, null, label) as label", "id"), "label", 3).count() == 2 * 499
    assert RS.sample_n(df.limit(0), 5).collect() == [] and RS.undersample(df.limit(0), "label").collect() == []
    late = df.join(spark.createDataFrame([(x,) for x in order[-600:]], "row_id long"), "row_id")
    assert {r["row_id"] for r in RS.sample_n(late, 40, 3).collect()} == set(order[-600:][:40])   # thresholds had to be raised
