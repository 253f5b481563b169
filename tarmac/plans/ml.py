"""Estimators, cross-validation, out-of-time evaluation, search, sweep, refit, PCA.

Folds are prepared once (scaler fitted on the training rows, which alone are
resampled) and written to the shared folder as numbered datasets.  Tree models
of all folds, candidates and strategies grow together from sufficient
statistics (``operators.trees``), the perceptrons of all folds on summed
gradients (``operators.perceptron``); naive Bayes is a Spark ML fit.  Scores are
confusion counts, summed where the rows are.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import MultilayerPerceptronClassifier, NaiveBayes
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import perceptron as PC
from ..operators import resample as RS
from ..operators import scaling as SC
from ..operators import trees as TR
from ..operators import validation as V
from ..session import checkpoint, shared_path, step

LABEL = "label"  # target column of the ML layer (0/1)

# Default model settings of the reference's comparison grid.
FOREST = dict(numTrees=300, maxDepth=15, minInstancesPerNode=2)
BOOSTED = dict(rounds=200, depth=6, rate=0.1)
ADABOOST_ROUNDS = 150
MLP_LAYERS = (64, 32)
MLP_MAX_ITER = 500
MLP_TOL = 1e-4  # stands in for early stopping (no validation split in Spark ML)
POS_WEIGHT = 2.4
# Independent preparations and Spark ML fits submitted concurrently from driver threads.
PARALLEL_FITS = 8


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(df)


def make_model(name: str, params: dict | None = None, seed: int = 42, n_features: int = 0):
    """Spark ML's estimators; tree models are ``operators.trees``, and ``perceptrons`` fits the perceptron."""
    p = dict(params or {})
    if name == "nb":
        return NaiveBayes(labelCol=LABEL, featuresCol="features", modelType="gaussian")
    if name == "mlp":
        layers = [n_features, *MLP_LAYERS, 2]
        return MultilayerPerceptronClassifier(labelCol=LABEL, featuresCol="features", layers=layers,
                                              maxIter=int(p.get("maxIter", MLP_MAX_ITER)), seed=seed,
                                              tol=float(p.get("tol", MLP_TOL)))
    raise ValueError(f"unknown model {name!r}")


def _scores(counts) -> dict:
    """M16 from one fold's [tp, fp, fn, tn]."""
    tp, fp, fn, tn = (int(c) for c in counts)
    f1 = 2.0 * tp / (2.0 * tp + fp + fn) if tp else 0.0
    ba = ((tp / (tp + fn) if tp + fn else 0.0) + (tn / (tn + fp) if tn + fp else 0.0)) / 2.0
    return {"tp": tp, "fp": fp, "fn": fn, "tn": tn, "f1": f1, "balanced_accuracy": ba}


class Folds:
    """Numbered datasets, each scaled on its training rows and resampled there, written once for all fits.

    ``rows(data, is_test, row_id, label, features)`` lie in the shared folder; tree models share one set of binned
    blocks, Spark ML models one cached table of vectors.
    """

    def __init__(self, rows: DataFrame, features: Sequence[str], name: str = "folds", steps: Sequence[Callable[[], DataFrame]] = ()):
        """``steps`` make further rows; each is written, and what it stored on the way removed, before the next one."""
        import uuid
        self.spark, self.features = rows.sparkSession, list(features)
        path = shared_path(self.spark, f"{name}/{uuid.uuid4().hex[:12]}")
        rows.hint("rebalance").write.parquet(path)
        for make in steps:
            with step(self.spark):
                make().hint("rebalance").write.mode("append").parquet(path)
        self.rows = self.spark.read.parquet(path)
        self.data = sorted(r["data"] for r in self.rows.select("data").distinct().collect())
        self._blocks = self._vectors = None

    @property
    def blocks(self) -> TR.Blocks:
        if self._blocks is None:
            self._blocks = TR.Blocks(self.rows, len(self.features))
        return self._blocks

    @property
    def vectors(self) -> DataFrame:
        if self._vectors is None:
            from pyspark.ml.functions import array_to_vector
            v = self.rows.select("data", "is_test", "row_id", F.col("label").alias(LABEL),
                                 array_to_vector("features").alias("features"))
            self._vectors = v.persist()
        return self._vectors

    def release(self) -> None:
        if self._blocks is not None:
            self._blocks.release()
        if self._vectors is not None:
            self._vectors.unpersist()


def scaled(train: DataFrame, test: DataFrame | None, number: int) -> DataFrame:
    """One dataset's rows with its number (``data``) and ``is_test``: the scaler is fitted on ``train``."""
    tr, te, _ = SC.fit_transform(train, test)
    parts = [df.withColumns({"data": F.lit(number), "is_test": F.lit(t)}) for df, t in ((tr, False), (te, True)) if df is not None]
    return _union(parts)


def datasets(rows: DataFrame, features: Sequence[str], resampling: str | None, seed: int = 42, first: int = 0,
             grown: DataFrame | None = None) -> DataFrame:
    """``scaled`` rows as datasets, numbered from ``first`` on; the training rows of each are resampled on their own, all
    in the same jobs.  ``grown``: their training rows after SMOTE, if made already."""
    train = RS.resample(rows.filter("not is_test").drop("is_test"), resampling, LABEL, features, seed, "row_id", "data", grown)

    def picked(df, is_test):
        return df.select((F.col("data") + first).alias("data"), F.lit(is_test).alias("is_test"), F.col("row_id").cast("long"),
                         F.col(LABEL).cast("int").alias("label"),
                         F.array(*[F.col(c).cast("double") for c in features]).alias("features"))

    return picked(train, False).unionByName(picked(rows.filter("is_test"), True))


def dataset(train: DataFrame, test: DataFrame | None, features: Sequence[str], resampling: str | None, number: int,
            seed: int = 42) -> DataFrame:
    """One dataset: the scaler is fitted on ``train``, which alone is resampled."""
    return datasets(checkpoint(scaled(train, test, 0)), features, resampling, seed, number)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scaled_folds(xy: DataFrame, features: Sequence[str], k: int = 5, seed: int = 42) -> list[DataFrame]:
    """``scaled`` rows of the folds of a stratified k-fold, numbered from 0 on."""
    from ..functions.columns import require_columns
    require_columns(xy, [LABEL, "row_id", *features], forbidden=["carrier", "text"], numeric=features)   # P32
    folds = checkpoint(V.stratified_folds(xy, LABEL, k, seed))

    def one(f: int) -> DataFrame:
        return scaled(folds.filter(F.col("fold") != f).drop("fold"), folds.filter(F.col("fold") == f).drop("fold"), f)

    with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as ex:   # fitting a scaler may take jobs
        return list(ex.map(one, range(k)))


def prepare_folds(xy: DataFrame, features: Sequence[str], resampling: str | None = None, k: int = 5, seed: int = 42,
                  first: int = 0) -> list[DataFrame]:
    """Datasets ``first`` to ``first + k - 1``: the folds of a stratified k-fold, prepared in the same jobs."""
    return [datasets(checkpoint(_union(scaled_folds(xy, features, k, seed))), features, resampling, seed, first)]


def forest_fit(data: int, params: dict | None = None, weight_mode: str | None = None, seed: int = 42) -> TR.Fit:
    p = {**FOREST, **(params or {})}
    weight = POS_WEIGHT if weight_mode == "positive" else weight_mode
    return TR.Fit(data, seed, int(p["numTrees"]), int(p["maxDepth"]), int(p["minInstancesPerNode"]),
                  str(p.get("featureSubsetStrategy", "sqrt")), str(p.get("impurity", "gini")), weight)


def forest_scores(folds: Folds, fits: Sequence[TR.Fit]) -> list[dict]:
    """Scores of each forest on its dataset's test rows; all of them grow in the same jobs."""
    found = TR.forest_counts(folds.blocks, list(fits))
    return [_scores(found.get(i, (0, 0, 0, 0))) for i in range(len(fits))]


def perceptrons(folds: Folds, data: Sequence[int], params: dict | None = None, seed: int = 42) -> dict:
    """Spark ML's perceptron model of every dataset, fitted on its training rows; all of them in the same jobs."""
    n = len(folds.features)
    est = make_model("mlp", params, seed, n)
    layers, max_iter, tol = est.getLayers(), est.getMaxIter(), est.getTol()
    est.setMaxIter(0)   # a fit of no iterations gives a model of the starting weights
    schema = StructType([StructField(LABEL, IntegerType()), StructField("features", VectorUDT())])
    none = folds.spark.createDataFrame([(0, Vectors.dense([0.0] * n))], schema)
    start = est.fit(none).weights.toArray()
    blocks = PC.Blocks(folds.vectors.withColumnRenamed(LABEL, "label"), n)
    try:
        found = PC.fit(blocks, layers, data, start, max_iter, tol)
    finally:
        blocks.release()
    return {k: est.copy().setInitialWeights(Vectors.dense(w)).fit(none) for k, w in found.items()}


def evaluate(folds: Folds, model: str, weight_mode: str | None = None, seed: int = 42, params: dict | None = None,
             data: Sequence[int] | None = None) -> list[dict]:
    """One dict of scores per dataset."""
    data = list(folds.data if data is None else data)
    p = params or {}
    if model == "forest":
        scores = forest_scores(folds, [forest_fit(k, params, weight_mode, seed) for k in data])
    elif model == "boosted":
        spec = TR.Boosted(**{**BOOSTED, **p}, positive_weight=POS_WEIGHT if weight_mode == "positive" else 1.0)
        found = TR.boosted_confusion(folds.blocks, TR.grow_boosted(folds.blocks, data, spec), spec)
        scores = [_scores(found.get(k, (0, 0, 0, 0))) for k in data]
    elif model == "adaboost":
        found = TR.stump_confusion(folds.blocks, TR.grow_stumps(folds.blocks, data, p.get("rounds", ADABOOST_ROUNDS)))
        scores = [_scores(found.get(k, (0, 0, 0, 0))) for k in data]
    else:
        fits = perceptrons(folds, data, params, seed) if model == "mlp" else {}

        def one(k: int) -> dict:
            rows = folds.vectors.filter(F.col("data") == k)
            fitted = fits.get(k) or make_model(model, params, seed, len(folds.features)).fit(rows.filter("not is_test"))
            c = V.confusion(fitted.transform(rows.filter("is_test")).select(F.col(LABEL).alias("label"), "prediction")).first()
            return _scores((c["tp"], c["fp"], c["fn"], c["tn"]))

        with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as ex:
            scores = list(ex.map(one, data))
    return [{"fold": k, **s} for k, s in zip(data, scores)]


def cross_validate(xy: DataFrame, features: Sequence[str], model: str, resampling: str | None = None,
                   weight_mode: str | None = None, k: int = 5, seed: int = 42, params: dict | None = None) -> list[dict]:
    """Stratified k-fold CV; one dict per fold returns, rows stay on the executors."""
    folds = Folds(_union(prepare_folds(xy, features, resampling, k, seed)), features)
    try:
        return evaluate(folds, model, weight_mode, seed, params)
    finally:
        folds.release()


def scaled_split(xy: DataFrame, split: DataFrame, number: int = 0) -> DataFrame:
    """``scaled`` rows of a split (row_id, is_test): the past trains, the future tests."""
    d = checkpoint(xy.join(split.select("row_id", "is_test"), "row_id"))
    return scaled(d.filter("is_test = 0").drop("is_test"), d.filter("is_test = 1").drop("is_test"), number)


def split_dataset(xy: DataFrame, split: DataFrame, features: Sequence[str], resampling: str | None = None, number: int = 0,
                  seed: int = 42) -> DataFrame:
    """The dataset of a split."""
    return datasets(checkpoint(scaled_split(xy, split)), features, resampling, seed, number)


def out_of_time(xy: DataFrame, split: DataFrame, features: Sequence[str], model: str, resampling: str | None = None,
                weight_mode: str | None = None, seed: int = 42, params: dict | None = None) -> dict:
    """Train on the past, score the future (``split`` = row_id, is_test)."""
    folds = Folds(split_dataset(xy, split, features, resampling, 0, seed), features)
    try:
        return evaluate(folds, model, weight_mode, seed, params)[0]
    finally:
        folds.release()


#: the reference's estimators, in its order
ESTIMATORS = ("forest", "adaboost", "boosted", "nb", "mlp")


def refit(xy: DataFrame, features: Sequence[str], model: str, resampling: str | None = None,
          weight_mode: str | None = None, seed: int = 42, params: dict | None = None) -> dict:
    """Scale, resample and fit on all rows; the model and its scaler table go to the shared folder.

    Tree models are saved as a table of their nodes (``trees.score_rows`` applies it), the others as Spark ML models.
    """
    import uuid
    spark = xy.sparkSession
    path = shared_path(spark, f"models/{model}-{uuid.uuid4().hex[:12]}")
    SC.save_params(SC.fit(xy), f"{path}/scaler")
    folds = Folds(dataset(xy, None, features, resampling, 0, seed), features)
    n = folds.rows.count()
    if model in ("forest", "boosted", "adaboost"):
        b, p = folds.blocks, params or {}
        if model == "forest":
            fit = forest_fit(0, params, weight_mode, seed)
            [(trees, roots)] = TR.grow_forests(b, [fit])
            rows = TR.node_rows(trees, roots, b.edges[0], 1.0 / len(roots))
        elif model == "boosted":
            spec = TR.Boosted(**{**BOOSTED, **p}, positive_weight=POS_WEIGHT if weight_mode == "positive" else 1.0)
            rows = [r for i, t in enumerate(TR.grow_boosted(b, [0], spec)[0]) for r in TR.node_rows(t, [0], b.edges[0], 1.0, i)]
        else:
            rows = TR.stump_rows(TR.grow_stumps(b, [0], p.get("rounds", ADABOOST_ROUNDS))[0], b.edges[0])
        spark.createDataFrame(rows, TR.NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    else:
        fitted = (perceptrons(folds, [0], params, seed)[0] if model == "mlp"
                  else make_model(model, params, seed, len(features)).fit(folds.vectors))
        fitted.write().overwrite().save(f"{path}/model")
    folds.release()
    return {"fitted_rows": n, "all_rows": xy.count(), "path": path}


# M19 search space of the reference's forest tuning: 4 x 5 x 3 x 3 x 2 x 3 = 1080 combinations.
# Fixed values; an unlimited depth maps to Spark's cap of 30.
SEARCH_SPACE = {
    "numTrees": [100, 200, 300, 500],
    "maxDepth": [10, 15, 20, 25, 30],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2", "0.5"],
    "impurity": ["gini", "entropy"],
    "weight": ["none", "balanced", "balanced_subsample"],
}


def search_candidates(n: int = 40, seed: int = 42, grid: bool = False) -> list[dict]:
    keys = list(SEARCH_SPACE)
    combos = [dict(zip(keys, v)) for v in itertools.product(*[SEARCH_SPACE[k] for k in keys])]
    if grid:
        return combos
    return random.Random(seed).sample(combos, min(n, len(combos)))


def _weight_mode(value: str) -> str | None:
    return None if value == "none" else value


def run_search(xy: DataFrame, features: Sequence[str], n: int = 40, k: int = 5, seed: int = 42) -> list[dict]:
    """Random search; every candidate is scored by k-fold F1 and balanced accuracy.

    The folds are prepared once; the forests of all candidates and folds grow together.
    """
    candidates = search_candidates(n, seed)
    folds = Folds(_union(prepare_folds(xy, features, None, k, seed)), features)
    fits = [forest_fit(f, {x: v for x, v in c.items() if x != "weight"}, _weight_mode(c["weight"]), seed)
            for c in candidates for f in range(k)]
    scores = forest_scores(folds, fits)
    folds.release()
    out = []
    for i, cand in enumerate(candidates):
        f1s, bas = ([s[m] for s in scores[i * k:(i + 1) * k]] for m in ("f1", "balanced_accuracy"))
        mean = sum(f1s) / k
        std = (sum((x - mean) ** 2 for x in f1s) / k) ** 0.5
        out.append({"candidate": i, "params": {x: str(v) for x, v in cand.items()}, "mean_test_f1": mean,
                    "std_test_f1": std, "mean_test_balanced_accuracy": sum(bas) / k})
    return out


def best_params(results: Sequence[dict]) -> dict:
    """Forest settings of the search's F1 winner (the first of equals), without its class weight."""
    best = max(results, key=lambda r: (r["mean_test_f1"], -r["candidate"]))
    kinds = {"numTrees": int, "maxDepth": int, "minInstancesPerNode": int}
    return {x: kinds.get(x, str)(v) for x, v in best["params"].items() if x != "weight"}


#: (name, resampling, class weight)
STRATEGIES = [("cw_none", None, None), ("cw_balanced", None, "balanced"),
              ("cw_balanced_subsample", None, "balanced_subsample"), ("undersample", "undersample", None),
              ("smote", "smote", None), ("smoteenn", "smoteenn", None), ("smotetomek", "smotetomek", None)]


def run_sweep(xy: DataFrame, split: DataFrame, features: Sequence[str], base: dict | None = None, k: int = 5,
              seed: int = 42, strategies: Sequence[tuple] | None = None) -> list[dict]:
    """Every strategy under k-fold and under the given split (row_id, is_test), with forest settings ``base``.

    Folds are dealt and scaled once for all resamplings, each resamples all of them in the same jobs, and those that
    begin with SMOTE share its points; all strategies' forests grow together.
    """
    strategies = STRATEGIES if strategies is None else strategies
    kinds = list(dict.fromkeys(r for _, r, _ in strategies))
    rows = checkpoint(_union([*scaled_folds(xy, features, k, seed), scaled_split(xy, split, k)]))
    grown = None
    if sum(r in RS.GROWING for r in kinds) > 1:
        grown = checkpoint(RS.smote(rows.filter("not is_test").drop("is_test"), LABEL, features, 5, seed, "row_id", "data"))

    def prepared(i: int) -> DataFrame:
        return datasets(rows, features, kinds[i], seed, i * (k + 1), grown)

    folds = Folds(prepared(0), features, steps=[lambda i=i: prepared(i) for i in range(1, len(kinds))])
    plan = [(name, f, forest_fit(kinds.index(r) * (k + 1) + f, base, w, seed)) for name, r, w in strategies for f in range(k + 1)]
    scores = forest_scores(folds, [fit for _, _, fit in plan])
    folds.release()
    return [{"strategy": name, "scheme": "split" if f == k else "stratified_kfold", "fold": 0 if f == k else f, **s}
            for (name, f, _), s in zip(plan, scores)]


def pca_2d(df: DataFrame, features: Sequence[str], label: str = LABEL, k: int = 2):
    """Z-score every feature (population std), PCA to k components, class kept."""
    params = SC.fit(df, standard=list(features), robust=[], log=[], minmax=[])
    z = SC.transform(df, params, standard=list(features), robust=[], log=[], minmax=[])
    v = assemble(z, features)
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(v)
    from pyspark.ml.functions import vector_to_array
    out = model.transform(v).select("row_id", label, vector_to_array("pc").alias("_pc"))
    out = out.select("row_id", label, *[F.col("_pc")[i].alias(f"pc{i + 1}") for i in range(k)])
    return out, list(model.explainedVariance.toArray())
