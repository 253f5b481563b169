"""Selection by narrowing brackets against numpy and against row numbers, with rounds forced by small limits."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from tarmac.operators import selection as SEL
from tarmac.plans import enrich as EN
from tarmac.sources import tables as TB

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def _shapes():
    rng = np.random.default_rng(3)
    return {"normal": rng.normal(size=3000), "ties": rng.integers(0, 3, 3000).astype(float),
            "hot": np.where(rng.random(3000) < 0.4, 7.0, rng.normal(7, 1, 3000)),
            "two": np.repeat([1.0, 2.0], 1500), "scales": 10.0 ** rng.uniform(-300, 300, 3000) * rng.choice([-1, 1], 3000)}


@pytest.mark.parametrize("gather,accuracy", [(SEL.GATHER, SEL.ACCURACY), (40, 30)])
def test_quantiles_equal_numpy(spark, gather, accuracy):
    s = _shapes()
    names = list(s)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*s.values())],
                               ", ".join(f"{n} double" for n in names)).repartition(5)
    got = SEL.quantiles(df, {n: (n, QS) for n in names}, gather, accuracy)
    for n in names:
        assert np.allclose(got[n], np.quantile(s[n], QS), rtol=1e-12), n


def test_quantiles_of_odd_columns(spark):
    df = spark.createDataFrame([(None, None, 4, math.nan), (2.0, None, 1, 1.0), (None, None, None, math.inf), (3.0, None, 9, -math.inf)],
                               "a double, b double, c int, d double")
    got = SEL.quantiles(df, {"a": ("a", [0.5]), "b": ("b", [0.5, 1.0]), "c": (F.col("c") * 2, [0.0, 0.25, 1.0]), "d": ("d", [0.0, 1.0])})
    assert got["a"] == [2.5] and got["b"] == [None, None] and got["c"] == [2.0, 5.0, 18.0]
    assert got["d"][0] == -math.inf and math.isnan(got["d"][1])
    assert SEL.quantiles(df.limit(0), {"a": ("a", [0.5])}) == {"a": [None]} and SEL.quantiles(df, {}) == {}


@pytest.mark.parametrize("gather,accuracy", [(SEL.GATHER, SEL.ACCURACY), (30, 40)])
def test_last_share_is_the_end_of_the_order(spark, gather, accuracy):
    """A time that a third of all rows share, nulls, keys beyond 2^53 and negative ones."""
    rows = [((1 << 60) * (-1) ** i + i, None if i % 50 == 0 else f"2024-01-{1 + (5 if i % 3 == 0 else i % 9):02d} 10:00:00.{i % 7:06d}")
            for i in range(900)]
    df = spark.createDataFrame(rows, "k long, t string").withColumn("t", F.col("t").cast("timestamp_ntz")).repartition(4)
    order = [r["k"] for r in sorted(df.collect(), key=lambda r: (r["t"] is not None, str(r["t"]), r["k"]))]
    for share in (0.2, 0.0001):
        cond = SEL.last_share(df, ["t", "k"], share, gather=gather, accuracy=accuracy)
        got = {r["k"] for r in df.filter(cond).collect()}
        assert got == set(order[-max(1, round(share * 900)):])
    assert df.limit(0).filter(SEL.last_share(df.limit(0), ["t", "k"], 0.2)).collect() == []


def test_fence_equals_percentile(spark):
    raw, locs = TB.scan_departures(spark, SF_CHECK), TB.locations(spark, SF_CHECK)
    d = EN.cleaned(raw, locs)
    q1, q3 = d.agg(F.percentile("delay_min", F.array(F.lit(0.25), F.lit(0.75)))).first()[0]
    assert EN.outlier_fence(d) == q3 + 1.5 * (q3 - q1)
    flagged = EN.flag_outliers(spark.createDataFrame([(None,), (1.0,), (3.0,)], "delay_min double"), 2.0)
    assert [r["is_outlier"] for r in flagged.collect()] == [0, 0, 1]
    assert {r["is_outlier"] for r in EN.flag_outliers(flagged.drop("is_outlier"), None).collect()} == {0}
