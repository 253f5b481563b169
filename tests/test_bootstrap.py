"""Bootstrap intervals against plain resampling of the rows."""
import numpy as np
import pytest

from tarmac.operators import bootstrap as BS
from tarmac.session import ship_package


@pytest.fixture(scope="module")
def sample(spark):
    ship_package(spark)
    rng = np.random.default_rng(6)
    groups = {"a": rng.exponential(10, 201).round(0), "b": rng.normal(5, 2, 90).round(1), "one": np.array([3.0]),
              "same": np.full(50, 7.0), "two": np.array([1.0, 5.0])}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [(None, 1.0), ("a", None)]
    return groups, spark.createDataFrame(rows, "g string, x double").repartition(5)


def plain(x, statistic, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    return np.percentile([statistic(rng.choice(x, len(x))) for _ in range(n)], [2.5, 97.5])


def got(df):
    return {r["g"]: (r["n"], r["ci_lo"], r["ci_hi"]) for r in df.collect()}


def quartile():
    """Per replicate the smallest value with three quarters of the weight at or below it; made here, so that it is
    pickled by value."""
    def statistic(values, weights):
        cum = weights.cumsum(axis=1)
        return values[(cum >= 0.75 * cum[:, -1:]).argmax(axis=1)]
    return statistic


upper_quartile = quartile()


@pytest.mark.parametrize("statistic, row_wise", [
    (BS.Quantile(0.5), np.median), (BS.Quantile(0.9), lambda x: np.percentile(x, 90)), (BS.MEAN, np.mean),
    (upper_quartile, lambda x: np.sort(x)[int(np.ceil(0.75 * len(x))) - 1])])
def test_interval_is_that_of_plain_resampling(sample, statistic, row_wise):
    groups, df = sample
    found = got(BS.bootstrap_ci(df, "g", "x", statistic))
    assert set(found) == set(groups) and found["one"] == (1, None, None) and found["same"] == (50, 7.0, 7.0)
    for g in ("a", "b", "two"):
        lo, hi = plain(groups[g], row_wise)
        step = np.diff(np.unique(groups[g])).max() if len(groups[g]) < 3 else 0.08 * (groups[g].max() - groups[g].min())
        assert found[g][0] == len(groups[g]) and abs(found[g][1] - lo) <= step and abs(found[g][2] - hi) <= step


def test_large_groups_are_merged_and_do_not_depend_on_partitions(sample, monkeypatch):
    groups, df = sample
    small = got(BS.bootstrap_ci(df, "g", "x", BS.MEAN))
    monkeypatch.setattr(BS, "MOST_VALUES", 10)
    merged = got(BS.bootstrap_ci(df, "g", "x", BS.MEAN))
    again = got(BS.bootstrap_ci(df.repartition(9), "g", "x", BS.MEAN))
    for g in ("a", "b"):
        assert np.allclose(merged[g], again[g]) and np.allclose(merged[g], small[g], rtol=0.05)
    with pytest.raises(ValueError, match="Mergeable"):
        BS.bootstrap_ci(df, "g", "x", upper_quartile)


def test_quantile_pieces_do_not_change_the_interval(sample, monkeypatch):
    _, df = sample
    a = got(BS.bootstrap_ci(df, "g", "x"))
    monkeypatch.setattr(BS, "PIECES", 3)
    assert got(BS.bootstrap_ci(df.repartition(3), "g", "x")) == a


def test_empty(spark):
    assert BS.bootstrap_ci(spark.createDataFrame([], "g string, x double"), "g", "x").collect() == []
