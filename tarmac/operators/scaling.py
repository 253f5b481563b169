"""Feature scalers M3-M6 with an explicit, storable fit table.

``fit`` is one aggregate over the training rows (one row of parameters), with
exact quartiles by selection (``selection.py``: no buffer of a column's
values); ``transform`` joins that row (broadcast, size 1) and applies column math.
Fitting on the training fold only and transforming both folds is what
keeps cross-validation leakage-free.  Spark ML's scalers differ on the
details that matter here (sample vs population std, approximate
quantiles), so the parameters are computed directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import joins as J
from . import selection as SEL

# Column groups of the reference's column transformer (present columns only).
STANDARD_COLS = ["lat"]
ROBUST_COLS = ["lon", "elev"]
LOG_COLS = ["distance_km", "n_chars", "n_words"]   # right-skewed magnitudes
MINMAX_COLS = ["day_of_month"]


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def fit(df: DataFrame, standard=STANDARD_COLS, robust=ROBUST_COLS, log=LOG_COLS, minmax=MINMAX_COLS) -> DataFrame:
    """One-row parameter table: mean/std (population), quartiles, log mean/std, min/max.

    With robust columns ``df`` is read several times, those columns only.
    """
    aggs = []
    for c in _present(df, standard):
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    quartiles = SEL.quantiles(df, {c: (c, [0.25, 0.5, 0.75]) for c in _present(df, robust)})
    for c in _present(df, log):
        aggs += [F.avg(F.log1p(c)).alias(f"{c}__mean"), F.stddev_pop(F.log1p(c)).alias(f"{c}__std")]
    for c in _present(df, minmax):
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    out = df.agg(*(aggs or [F.count(F.lit(1)).alias("rows")]))   # nothing to scale: one row all the same
    return out.select("*", *[F.array(*[F.lit(v).cast("double") for v in q]).alias(f"{c}__q") for c, q in quartiles.items()])


def transform(df: DataFrame, params: DataFrame, standard=STANDARD_COLS, robust=ROBUST_COLS, log=LOG_COLS,
              minmax=MINMAX_COLS) -> DataFrame:
    """Apply a fit table; other columns pass through unchanged."""
    j = J.with_global(df, params)
    out = {}

    def scale(x, centre, spread):
        # zero spread -> divide by 1, as the source scalers do
        return (x - centre) / F.when((spread.isNull()) | (spread == 0), F.lit(1.0)).otherwise(spread)

    for c in _present(df, standard):
        out[c] = scale(F.col(c), F.col(f"{c}__mean"), F.col(f"{c}__std"))
    for c in _present(df, robust):
        q = F.col(f"{c}__q")
        out[c] = scale(F.col(c), q[1], q[2] - q[0])
    for c in _present(df, log):
        out[c] = scale(F.log1p(F.col(c)), F.col(f"{c}__mean"), F.col(f"{c}__std"))
    for c in _present(df, minmax):
        out[c] = scale(F.col(c), F.col(f"{c}__min"), F.col(f"{c}__max") - F.col(f"{c}__min"))
    return j.select(*[out[c].alias(c) if c in out else F.col(c) for c in df.columns])


def fit_transform(train: DataFrame, test: DataFrame | None = None, **kw):
    p = fit(train, **kw)
    return (transform(train, p), transform(test, p) if test is not None else None, p)


def save_params(params: DataFrame, path: str) -> None:
    """Keep the fit table as Parquet next to the model (shared storage)."""
    params.write.mode("overwrite").parquet(path)
