"""Bootstrap intervals of any statistic (F2, H13) from value-count tables.

A resample is never written out.  What is drawn depends on the statistic:

* ``Quantile``: the m-th of n sorted draws from a sample lies at the share
  U ~ Beta(m, n - m + 1) of its sorted values, so a replicate is one draw (two
  where ranks are interpolated) and a look-up in the group's running counts.
  Groups of any size.
* ``Mergeable``: sums over values and weights.  Weights are Poisson, drawn by
  a generator that belongs to (group, value), and summed per replicate before
  the shuffle.  Groups of any size; of few rows, multinomial weights.
* any function of (values, weights) for groups of up to ``MOST_VALUES``
  different values, with multinomial weights.

Intervals are percentile intervals over ``n_resamples`` replicates.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import N_BOOTSTRAP
from .aggregates import value_counts_table
from .ranks import prefix_counts

#: different values of a group that one task resamples at most
MOST_VALUES = 50_000
#: pieces into which the ranks that a group's replicates fall on are cut
PIECES = 512


class Quantile(NamedTuple):
    """The q-quantile with linear interpolation between order statistics."""
    q: float = 0.5


class Mergeable(NamedTuple):
    """A statistic of sums: ``parts(values [m], weights [B, m])`` gives arrays [B] that add up over pieces of the data,
    and ``finish`` makes the statistic of their totals."""
    parts: Callable
    finish: Callable


MEAN = Mergeable(lambda v, w: (w @ v, w.sum(axis=1)), lambda s, n: s / n)


def _seed(seed: int, key: int) -> np.random.Generator:
    """The generator that belongs to a key, whichever task asks for it."""
    return np.random.Generator(np.random.Philox(key=np.array([seed, int(key) & ((1 << 64) - 1)], dtype=np.uint64)))


def _ends(level: float):
    return F.array(F.lit((1 - level) / 2), F.lit((1 + level) / 2))


def _interval(replicates: DataFrame, group: str, level: float) -> DataFrame:
    """(group, ci_lo, ci_hi) of (group, stat): a fixed number of replicates per group."""
    return replicates.groupBy(group).agg(F.percentile("stat", _ends(level)).alias("c")).select(
        group, F.col("c")[0].alias("ci_lo"), F.col("c")[1].alias("ci_hi"))


def _quantile_replicates(counts: DataFrame, group: str, value: str, q: float, n_resamples: int, seed: int) -> DataFrame:
    """(group, stat): replicates of a quantile."""
    running = prefix_counts(counts, value, [group])   # before, total
    sizes = running.select(group, "total").distinct().withColumn("key", F.xxhash64(group))

    def draw(frames):
        for pdf in frames:
            out = []
            for g, n, key in zip(pdf[group], pdf["total"], pdf["key"]):
                rng, at = _seed(seed, key), q * (n - 1)
                m, part = int(at) + 1, at - int(at)
                u = rng.beta(m, n - m + 1, n_resamples)
                ranks = [np.clip(np.ceil(u * n), 1, n)]
                if part > 0:   # the next order statistic, given this one
                    ranks.append(np.clip(np.ceil((u + (1 - u) * rng.beta(1, n - m, n_resamples)) * n), 1, n))
                for r, w in zip(ranks, (1 - part, part)):
                    out.append(pd.DataFrame({group: g, "replicate": np.arange(n_resamples), "rank": r.astype(np.int64), "w": w}))
            if out:
                yield pd.concat(out)

    kind = dict(counts.dtypes)[group]
    drawn = sizes.mapInPandas(draw, f"`{group}` {kind}, replicate int, rank long, w double")
    span = drawn.groupBy(group).agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    span = span.withColumn("width", F.ceil((F.col("hi") - F.col("lo") + 1) / PIECES))
    piece = F.floor((F.col("rank") - F.col("lo")) / F.col("width"))
    asked = drawn.join(span, group).withColumn("piece", piece)
    first, last = F.greatest(F.col("before") + 1, F.col("lo")), F.least(F.col("before") + F.col("cnt"), F.col("hi"))
    held = running.join(span, group).withColumns({"first": first, "last": last}).filter("first <= last").withColumn(
        "piece", F.explode(F.sequence(F.floor((F.col("first") - F.col("lo")) / F.col("width")),
                                      F.floor((F.col("last") - F.col("lo")) / F.col("width"))))).select(
        group, "piece", "first", "last", F.col(value).cast("double").alias("x"))
    met = asked.join(held, [group, "piece"]).filter("rank between first and last")
    return met.groupBy(group, "replicate").agg(F.sum(F.col("w") * F.col("x")).alias("stat")).select(group, "stat")


def _small_replicates(small: DataFrame, group: str, value: str, statistic: Callable, n_resamples: int, seed: int) -> DataFrame:
    """(group, stat) with multinomial weights; a group's values are in one task, ``MOST_VALUES`` at most."""
    kind = dict(small.dtypes)[group]

    def run(pdf):
        pdf = pdf.sort_values(value)
        v, c = pdf[value].to_numpy(dtype=np.float64), pdf["cnt"].to_numpy(dtype=np.int64)
        rng, stats = _seed(seed, pdf["key"].iloc[0]), []
        step = max(1, (1 << 22) // len(v))
        for at in range(0, n_resamples, step):
            w = rng.multinomial(c.sum(), c / c.sum(), min(step, n_resamples - at))
            stats.append(np.asarray(statistic(v, w), dtype=np.float64))
        return pd.DataFrame({group: pdf[group].iloc[0], "stat": np.concatenate(stats)})

    return small.withColumn("key", F.xxhash64(group)).groupBy(group).applyInPandas(run, f"`{group}` {kind}, stat double")


def _merged_replicates(counts: DataFrame, group: str, value: str, statistic: Mergeable, n_resamples: int, seed: int) -> DataFrame:
    """(group, stat) with Poisson weights, summed wherever the values are."""
    kind = dict(counts.dtypes)[group]
    n_parts = len(statistic.parts(np.ones(1), np.ones((1, 1))))
    sums = [f"s{i}" for i in range(n_parts)]

    def partial(frames):
        for pdf in frames:
            for g, part in pdf.groupby(group, sort=False):
                v, c = part[value].to_numpy(dtype=np.float64), part["cnt"].to_numpy()
                total = [np.zeros(n_resamples)] * n_parts
                for at in range(0, len(v), 512):
                    w = np.stack([_seed(seed, k).poisson(n, n_resamples) for k, n in
                                  zip(part["key"].iloc[at:at + 512], c[at:at + 512])], axis=1)
                    total = [t + s for t, s in zip(total, statistic.parts(v[at:at + 512], w))]
                yield pd.DataFrame({group: g, "replicate": np.arange(n_resamples), **dict(zip(sums, total))})

    keyed = counts.select(group, value, "cnt", F.xxhash64(group, value).alias("key"))
    merged = keyed.mapInPandas(partial, f"`{group}` {kind}, replicate int, " + ", ".join(f"{s} double" for s in sums)).groupBy(
        group, "replicate").agg(*[F.sum(s).alias(s) for s in sums])

    def finish(frames):
        for pdf in frames:
            yield pd.DataFrame({group: pdf[group], "stat": statistic.finish(*(pdf[s].to_numpy() for s in sums))})

    return merged.mapInPandas(finish, f"`{group}` {kind}, stat double")


def bootstrap_ci(df: DataFrame, group: str, value: str, statistic: Quantile | Mergeable | Callable = Quantile(0.5),
                 n_resamples: int = N_BOOTSTRAP, level: float = 0.95, seed: int = 42) -> DataFrame:
    """(group, n, ci_lo, ci_hi): percentile bootstrap interval of a statistic per group.

    Null groups and values are left out.  A group of one value has no interval
    (null ends).  The same seed gives the same intervals however the data are partitioned.
    """
    d = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    counts = value_counts_table(d, value, [group])
    sizes = counts.groupBy(group).agg(F.sum("cnt").alias("n"), F.count("*").alias("values"))
    several = counts.join(sizes.filter("n > 1").select(group, "values"), group)
    if isinstance(statistic, Quantile):
        found = _quantile_replicates(several.drop("values"), group, value, statistic.q, n_resamples, seed)
    else:
        merge = isinstance(statistic, Mergeable)

        def whole(v, w):
            return statistic.finish(*statistic.parts(v, w)) if merge else statistic(v, w)

        small, large = several.filter(F.col("values") <= MOST_VALUES), several.filter(F.col("values") > MOST_VALUES)
        found = _small_replicates(small.drop("values"), group, value, whole, n_resamples, seed)
        if merge:
            found = found.unionByName(_merged_replicates(large.drop("values"), group, value, statistic, n_resamples, seed))
        elif not large.isEmpty():
            raise ValueError(f"a group has more than {MOST_VALUES} values: give the statistic as Mergeable or Quantile")
    return sizes.select(group, "n").join(_interval(found, group, level), group, "left")
