"""Class resampling M7-M9 and sampling B1-B2.

All randomness is a seeded hash of row keys (``xxhash64``), so results do
not depend on partitioning or task retries; no step collects a class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import joins as J
from ..session import checkpoint
from .knn import knn
from .ranks import HASH64, global_row_number
from .windows import hash_key


def _u01(*cols, seed: int) -> F.Column:
    """Deterministic uniform [0, 1) from a seeded hash of the given columns."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(2 ** 31)).cast("double") / float(2 ** 31)


#: span of ``hash_key``, the seeded order of sampling; SQL has the same function
SPAN = 1 << 31


def _least_hashes(df: DataFrame, quotas: DataFrame, keys: list[str], seed: int, key: str) -> DataFrame:
    """Per group the ``_quota`` rows that come first by (hash, key); ``quotas(keys, _n, _quota)`` has the groups' sizes.

    Only rows below a group's hash threshold, which its quota and size give with room to spare, are shuffled and
    ranked; should one fall short, the thresholds are raised.
    """
    room, spare = 1, F.col("_quota") + 6 * F.sqrt("_quota") + 16
    rows = df.withColumn("_h", hash_key(key, seed))
    while True:
        q = quotas.withColumn("_below", F.least(F.lit(float(SPAN)), F.ceil(spare * room / F.col("_n") * SPAN).cast("double")))
        near = (J.with_global(rows, q) if not keys else rows.join(F.broadcast(q), keys)).filter(F.col("_h") < F.col("_below"))
        got = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("_got"))
        met = q.join(got, keys, "left") if keys else J.with_global(q, got)
        if met.filter(F.coalesce("_got", F.lit(0)) < F.least("_quota", "_n")).isEmpty():
            break
        room *= 4
    placed = near.withColumn("_u", F.col("_h") / F.col("_below"))   # uniform in every group
    r = global_row_number(placed, ["_u", key], keys=keys, out="_rn", hashed=(0, 1))
    return r.filter(F.col("_rn") <= F.col("_quota")).select(*df.columns)


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "row_id") -> DataFrame:
    """B1: min(n, N) rows without replacement: the first by a seeded hash of their key."""
    quota = df.agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0").withColumn("_quota", F.least(F.lit(n), F.col("_n")))
    return _least_hashes(df, quota, [], seed, key)


def stratified_sample(df: DataFrame, label: str, max_samples: int, seed: int = 42, key: str = "row_id") -> DataFrame:
    """B2: per class max(1, round(n_c * max_samples / N)) rows, cut to ``max_samples`` in all; a table of no more rows
    than that stays whole.  Rows without a class are left out."""
    df = df.filter(F.col(label).isNotNull())
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    if (total.first()["_all"] or 0) <= max_samples:
        return df
    quota = F.least("_n", F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(float(max_samples)) / F.col("_all")).cast("long")))
    q = J.with_global(counts, total).withColumn("_quota", quota).drop("_all")
    return sample_n(_least_hashes(df, q, [label], seed, key), max_samples, seed, key)


def undersample(df: DataFrame, label: str, seed: int = 42, key: str = "row_id", group: str | None = None) -> DataFrame:
    """M7: every class cut to the minority size (seeded hash order within class); rows without a class are left out."""
    df, by = df.filter(F.col(label).isNotNull()), _by(group)
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_n"))
    q = _with_own(counts, counts.groupBy(*by).agg(F.min("_n").alias("_quota")), by)
    return _least_hashes(df, q, [*by, label], seed, key)


def _by(group: str | None) -> list[str]:
    return [group] if group else []


def _with_own(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Every row with its group's row of ``stats``; groups are few datasets."""
    return df.join(F.broadcast(stats), by) if by else J.with_global(df, stats)


def smote(df: DataFrame, label: str, features: Sequence[str], k: int = 5, seed: int = 42,
          key: str = "row_id", group: str | None = None) -> DataFrame:
    """M8: grow the minority class to the majority size with synthetic points
    x + u * (nn - x), nn one of the k nearest minority neighbours of x.

    With k or fewer minority points each has all others as neighbours, and a
    single one is its own neighbour, so the minority class always reaches the
    majority size.  Minority point of rank i spawns floor(need / n_min) (+1 if i < need mod
    n_min) points; neighbour choice and u come from seeded hashes.  Each ``group`` (a number of a dataset, never null)
    is grown on its own, as in every function here; all of them in the same jobs.
    """
    by = _by(group)
    vec = F.array(*[F.col(c).cast("double") for c in features])
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_nc"))
    ext = counts.groupBy(*by).agg(F.min_by(label, "_nc").alias("_minlab"), F.min("_nc").alias("_nmin"), F.max("_nc").alias("_nmax"))
    base = _with_own(df.withColumn("_vec", vec), ext, by)
    mino = base.filter(F.col(label) == F.col("_minlab"))
    nn = knn(mino.select(key, *by, "_vec"), key, "_vec", k, group).select(key, *by, "j", "nn_vec")
    h = mino.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    r = global_row_number(h, ["_h", key], by, out="_rn", hashed=HASH64).drop("total")
    need = F.col("_nmax") - F.col("_nmin")
    per = F.floor(need / F.col("_nmin")) + F.when(F.col("_rn") - 1 < F.pmod(need, F.col("_nmin")), 1).otherwise(0)
    spawn = r.withColumn("_per", per.cast("int")).filter(F.col("_per") > 0)
    spawn = spawn.select(key, *by, label, "_vec", "_nmin", F.explode(F.sequence(F.lit(1), F.col("_per"))).alias("_t"))
    spawn = spawn.withColumn("j", (F.pmod(F.xxhash64(F.col(key), F.col("_t"), F.lit(seed)),
                                              F.greatest(F.least(F.lit(k), F.col("_nmin") - 1), F.lit(1))) + 1).cast("int"))
    s = spawn.join(nn, [key, *by, "j"], "left").withColumn("nn_vec", F.coalesce("nn_vec", "_vec"))
    u = _u01(F.col(key), F.col("_t"), seed=seed + 1)
    synth = s.select(*by, label, F.zip_with("_vec", "nn_vec", lambda a, b: a + u * (b - a)).alias("_vec"),
                     F.lit(1).alias("synthetic"), F.col(key).alias("parent"), "_t")
    synth = synth.withColumn(key, -(F.abs(F.xxhash64(F.col("parent"), F.col("_t"), F.lit(seed))) + 1))
    orig = base.select(key, *by, label, "_vec", F.lit(0).alias("synthetic"), F.col(key).alias("parent"))
    out = orig.unionByName(synth.drop("_t"))
    return out.select(key, *by, label, "synthetic", "parent",
                      *[F.col("_vec")[i].alias(c) for i, c in enumerate(features)])


def enn_clean(df: DataFrame, label: str, features: Sequence[str], k: int = 3, key: str = "row_id",
              group: str | None = None, stored: bool = False) -> DataFrame:
    """Edited nearest neighbours: keep a row only if all k nearest neighbours share its label.

    ``stored``: ``df`` is a checkpoint already.
    """
    vec = F.array(*[F.col(c).cast("double") for c in features])
    df, ids = df if stored else checkpoint(df), [key, *_by(group)]
    pts = df.withColumn("_vec", vec)
    nn = knn(pts.select(*ids, label, "_vec"), key, "_vec", k, group, payload=(label,))
    bad = nn.join(pts.select(*ids, label), ids).filter(F.col(f"nn_{label}") != F.col(label)).select(*ids).distinct()
    return df.join(bad, ids, "left_anti")


def tomek_clean(df: DataFrame, label: str, features: Sequence[str], key: str = "row_id", group: str | None = None,
                stored: bool = False) -> DataFrame:
    """Remove both members of every Tomek link (mutual 1-NN of opposite classes)."""
    vec = F.array(*[F.col(c).cast("double") for c in features])
    df, by = df if stored else checkpoint(df), _by(group)
    ids = [key, *by]
    pts = df.withColumn("_vec", vec)
    nn = knn(pts.select(*ids, label, "_vec"), key, "_vec", 1, group, payload=(label,)).filter(F.col("j") == 1)
    a = nn.select(*ids, F.col("vkey").alias("_a"), F.col("nn_key").alias("_b"), F.col(f"nn_{label}").alias("_nl"))
    a = a.join(pts.select(*ids, label), ids).filter(F.col("_nl") != F.col(label))
    pairs = nn.select(*by, F.col("vkey").alias("_b"), F.col("nn_key").alias("_back")).distinct()
    linked = a.join(pairs, [*by, "_b"]).filter(F.col("_back") == F.col("_a")).select(*ids)
    return df.join(linked, ids, "left_anti")


def smote_enn(df, label, features, seed=42, key="row_id", group=None, grown=None):
    """SMOTE (``grown`` if it is a checkpoint already), then edited nearest neighbours (3 neighbours)."""
    points = smote(df, label, features, 5, seed, key, group) if grown is None else grown
    return enn_clean(points, label, features, 3, key, group, grown is not None)


def smote_tomek(df, label, features, seed=42, key="row_id", group=None, grown=None):
    """SMOTE (``grown`` if it is a checkpoint already), then Tomek-link removal."""
    points = smote(df, label, features, 5, seed, key, group) if grown is None else grown
    return tomek_clean(points, label, features, key, group, grown is not None)


#: resamplings that begin with SMOTE
GROWING = ("smote", "smoteenn", "smotetomek")


def resample(df: DataFrame, method: str | None, label: str, features: Sequence[str], seed: int = 42,
             key: str = "row_id", group: str | None = None, grown: DataFrame | None = None) -> DataFrame:
    if method in (None, "none"):
        return df
    if method == "undersample":
        return undersample(df, label, seed, key, group)
    if method == "smote":
        return (smote(df, label, features, 5, seed, key, group) if grown is None else grown).drop("synthetic", "parent")
    if method == "smoteenn":
        return smote_enn(df, label, features, seed, key, group, grown).drop("synthetic", "parent")
    if method == "smotetomek":
        return smote_tomek(df, label, features, seed, key, group, grown).drop("synthetic", "parent")
    raise ValueError(f"unknown resampling method {method!r}")
