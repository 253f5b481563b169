"""Metrics and validation helpers (M10, M16, M17 pieces, W6/W7 reuse).

Scores come from confusion counts aggregated in one pass; a fold's score
never needs its rows on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import joins as J
from .ranks import global_row_number
from .windows import hash_key


def scores_from_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> tuple[Column, Column]:
    """Positive-class F1 (0 when undefined) and balanced accuracy."""
    f1 = F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))
    rec1 = F.try_divide(tp.cast("double"), tp + fn)
    rec0 = F.try_divide(tn.cast("double"), tn + fp)
    ba = (F.coalesce(rec1, F.lit(0.0)) + F.coalesce(rec0, F.lit(0.0))) / 2.0
    return f1, ba


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              group: Sequence[str] = ()) -> DataFrame:
    """tp/fp/fn/tn (+ f1, balanced accuracy) per group in one aggregate."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    a = pred.groupBy(*group).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                                 F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    f1, ba = scores_from_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return a.withColumn("f1", f1).withColumn("balanced_accuracy", ba)


def stratified_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42, key: str = "row_id",
                     keys: Sequence[str] = ()) -> DataFrame:
    """Within each class (and ``keys``), rows in seeded-hash order are dealt
    round-robin to ``k`` folds; class shares per fold differ by at most one row.

    The within-class order comes from range-partitioned prefix counts, so a
    majority class holding most rows is still spread over many tasks.
    """
    seed_col = F.col("_seed") if "_seed" in df.columns else F.lit(seed)
    h = df.withColumn("_h", F.pmod(F.pmod(F.col(key).cast("long"), F.lit(2147483648)) * F.lit(1103515245)
                                   + seed_col * 97 + 13, F.lit(2147483648)))
    rn = global_row_number(h, ["_h", key], keys=[*keys, label], out="_rn", hashed=(0, 1 << 31))
    return rn.withColumn("fold", F.pmod(F.col("_rn") - 1, F.lit(k)).cast("int")).drop("_h", "_rn", "total")


def class_weights(df: DataFrame, label: str = "is_late") -> DataFrame:
    """M10 'balanced': w_c = N / (k * n_c), one row per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    t = c.agg(F.sum("n_c").alias("_N"), F.count(F.lit(1)).alias("_k"))
    return J.with_global(c, t).select(label, "n_c", (F.col("_N") / (F.col("_k") * F.col("n_c"))).alias("weight"))


def with_weights(df: DataFrame, label: str = "is_late", mode: str | None = "balanced",
                 positive_weight: float | None = None) -> DataFrame:
    """Attach a ``weight`` column: none (1.0), balanced, or a fixed positive-class weight."""
    if mode is None and positive_weight is None:
        return df.withColumn("weight", F.lit(1.0))
    if positive_weight is not None:
        return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(positive_weight))).otherwise(1.0))
    w = class_weights(df, label).select(label, "weight")
    return df.join(F.broadcast(w), label)     # one row per class


def group_rate_cv(cells: DataFrame, keys: Sequence[str], group: str = "g") -> DataFrame:
    """Cross-validated group-rate classifier from (keys.., fold, g, pos, n) cell counts.

    For each held-out fold the model is the late rate of every group on the
    other folds (group total minus the fold's own cell); a group is predicted
    late when its training rate exceeds the training base rate.  Everything
    is arithmetic on count tables, independent of the number of rows.
    """
    keys = list(keys)
    gt = cells.groupBy(*keys, group).agg(F.sum("pos").alias("gpos"), F.sum("n").alias("gn"))
    ft = cells.groupBy(*keys, "fold").agg(F.sum("pos").alias("fpos"), F.sum("n").alias("fn_"))
    at = cells.groupBy(*keys).agg(F.sum("pos").alias("apos"), F.sum("n").alias("an"))
    j = cells.join(gt, [*keys, group]).join(ft, [*keys, "fold"]).join(at, keys)
    rate = F.try_divide((F.col("gpos") - F.col("pos")).cast("double"), F.col("gn") - F.col("n"))
    base = F.try_divide((F.col("apos") - F.col("fpos")).cast("double"), F.col("an") - F.col("fn_"))
    pred = F.coalesce(rate > base, F.lit(False))
    neg = F.col("n") - F.col("pos")
    c = j.groupBy(*keys, "fold").agg(
        F.sum(F.when(pred, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(pred, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(~pred, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~pred, neg).otherwise(0)).alias("tn"))
    f1, ba = scores_from_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return c.withColumn("f1", f1).withColumn("balanced_accuracy", ba)
