"""Boosted trees on feature tables: training per fold, scoring, parameter search, importances, storage."""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefeatures.functions.rows import nan_to_null
from casefeatures.functions.schema import quoted
from casefeatures.sources.files import checkpointed, expand, scratch_path
from casefeatures.training.scores import auc, weighted_auc

# Spark's trees take no nulls: they get a value below any real one, next to a flag.
FILL = -1e9

# Sizes of the job, as far as Spark's trees have them. Spark bounds a tree by depth alone, so 62 leaves are depth 6.
TRAIN_PARAMS = {"maxDepth": 6, "maxIter": 3000, "stepSize": 0.016, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.77"}
SEARCH_PARAMS = {"maxIter": 2500, "stepSize": 0.04}
# Trees without a better score on the held-out fold after which training stops, and trees of the first fit.
PATIENCE, FIRST_FIT = 100, 100
# Categories of more codes than this are read as ordered numbers: every feature's histograms are as wide as the largest category.
MAX_CODES = 1024
_SCORES = "trial int, params map<string,string>, fold int, auc double"
SEARCH_RANGES = {"maxDepth": (3, 20), "featureSubsetStrategy": (0.5, 1.0), "subsamplingRate": (0.5, 1.0)}


@dataclass(frozen=True)
class Features:
    """Which columns a model sees: numbers, and categories given as 0-based codes below ``codes[name]``."""

    numeric: Sequence[str]
    codes: Mapping[str, int] = field(default_factory=dict)
    flag_nulls: bool = True
    max_codes: int = MAX_CODES

    def nominal(self, name: str) -> bool:
        return self.codes[name] < self.max_codes

    @property
    def names(self) -> list[str]:
        flags = [f"{c}_null" for c in self.numeric] if self.flag_nulls else []
        return [*self.codes, *self.numeric, *flags]


def code_sizes(data: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Codes per category column (largest + 1); one row reaches the driver."""
    if not columns:
        return {}
    row = data.agg(*[F.max(quoted(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: int(row[i] or 0) + 1 for i, c in enumerate(columns)}


def model_input(data: DataFrame, features: Features) -> DataFrame:
    """Add ``features``: one vector per row, nulls filled and flagged, categories marked as such."""
    cols = []
    for c, n in features.codes.items():
        if not features.nominal(c):
            cols.append(F.coalesce(quoted(c).cast("double"), F.lit(FILL)).alias(f"_x_{c}"))
            continue
        meta = {"ml_attr": {"type": "nominal", "vals": [str(i) for i in range(n + 1)], "name": c}}
        code = F.when(quoted(c).between(0, n - 1), quoted(c).cast("double")).otherwise(F.lit(float(n)))
        cols.append(code.alias(f"_x_{c}", metadata=meta))
    for c in features.numeric:
        cols.append(F.coalesce(nan_to_null(quoted(c).cast("double")), F.lit(FILL)).alias(f"_x_{c}"))
    if features.flag_nulls:
        cols += [nan_to_null(quoted(c).cast("double")).isNull().cast("double").alias(f"_x_{c}_null") for c in features.numeric]
    ready = data.select("*", *cols).withColumnsRenamed({f"_x_{n}": f"_x_{n}".replace(".", "_") for n in features.names})
    made = [f"_x_{n}".replace(".", "_") for n in features.names]
    return VectorAssembler(inputCols=made, outputCol="features").transform(ready).drop(*made)


def classifier(features: Features, params: Mapping, target: str, weight: str | None, seed: int) -> GBTClassifier:
    gbt = GBTClassifier(featuresCol="features", labelCol=target, seed=seed, **dict(params))
    gbt.setMaxBins(max([32, *[n + 1 for c, n in features.codes.items() if features.nominal(c)]]))
    return gbt.setWeightCol(weight) if weight else gbt


def fit_with_patience(gbt: GBTClassifier, rows: DataFrame, held_out: DataFrame, patience: int = PATIENCE) -> PipelineModel:
    """Trees are added until ``patience`` of them bring no lower loss on the held-out rows (or ``maxIter``); the best number is kept.

    Fits of growing size, seeded alike, share their first trees, so the losses per number of trees come from the largest one.
    """
    most = gbt.getMaxIter()
    size = min(most, max(FIRST_FIT, 2 * patience))
    while True:
        model = gbt.copy({gbt.maxIter: size}).fit(rows)
        losses = model.evaluateEachIteration(held_out)
        best = min(range(len(losses)), key=lambda i: losses[i]) + 1 if losses else size
        if size >= most or size - best >= patience:
            break
        size = min(most, 2 * size)
    return PipelineModel([first_trees(model, best) if best < size else model])


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble of a model's first n trees: what a fit of n trees gives, without fitting again."""
    java, sc = model._java_obj, SparkContext._active_spark_context
    trees, weights = java.trees(), java.treeWeights()
    kept, kept_weights = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n), sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        kept[i], kept_weights[i] = trees[i], weights[i]
    cut = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), kept, kept_weights, java.numFeatures(), 2)
    return GBTClassificationModel(java.copyValues(cut, java.extractParamMap()))


def train_boosted_trees(
    data: DataFrame,
    features: Features,
    params: Mapping = TRAIN_PARAMS,
    fold: str = "fold",
    folds: int = 5,
    target: str = "target",
    weight: str | None = "weights",
    seed: int = 42,
    patience: int = PATIENCE,
) -> dict[int, PipelineModel]:
    """A model per fold, trained on the other folds; trees stop on the held-out fold by ``patience``.

    Rows whose weight is null (a week without positives has no weights) are left out of the fit and of the stopping rule; they are scored
    like all others. A fold without rows to stop by keeps ``maxIter`` trees.
    """
    ready = model_input(data, features).withColumn(target, F.col(target).cast("double"))
    kept = [c for c in (target, weight, fold, "features") if c]
    ready = ready.where(F.col(weight).isNotNull()) if weight else ready
    ready = checkpointed(ready.select(*kept))
    if params.get("subsamplingRate", 1.0) == 1.0:
        ready, weight = merged_rows(ready, weight)
    return _fitted(ready, features, params, fold, range(folds), target, weight, seed, patience)


def merged_rows(ready: DataFrame, weight: str | None) -> tuple[DataFrame, str | None]:
    """Equal rows as one row of their summed weight, and the name of the weight, where that at least halves the rows.

    Nodes and losses see only sums of weights, so an ensemble fitted on all rows is the same on either table. With subsampling
    it is not: trees would draw or leave equal rows together.
    """
    row = ready.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*ready.columns)).alias("apart")).first()
    if 2 * row["apart"] > row["n"]:
        return ready, weight
    rows = ready.groupBy(*ready.columns).agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    if weight:
        rows = rows.withColumn(weight, F.col(weight) * F.col("_rows")).drop("_rows")
    return checkpointed(rows), weight or "_rows"


def _fitted(ready: DataFrame, features: Features, params: Mapping, fold: str, folds: Iterable[int], target: str, weight: str | None, seed: int, patience: int) -> dict[int, PipelineModel]:
    models = {}
    for k in folds:
        held_out = ready.where(F.col(fold) == k)
        rows = ready.where(F.col(fold) != k)
        gbt = classifier(features, params, target, weight, seed)
        models[k] = PipelineModel([gbt.fit(rows)]) if held_out.isEmpty() else fit_with_patience(gbt, rows, held_out, patience)
    return models


def tree_counts(models: Mapping[int, PipelineModel]) -> dict[int, int]:
    """Trees kept per fold."""
    return {k: m.stages[-1].getNumTrees for k, m in models.items()}


def predict_score(model: PipelineModel, data: DataFrame, features: Features, name: str = "score") -> DataFrame:
    """Add the probability of class 1."""
    scored = model.transform(model_input(data, features))
    return scored.withColumn(name, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def predict_held_out(models: Mapping[int, PipelineModel], data: DataFrame, features: Features, fold: str = "fold", name: str = "score") -> DataFrame:
    """Score each fold by the model that did not see it."""
    out = None
    for k, model in models.items():
        part = predict_score(model, data.filter(F.col(fold) == k), features, name)
        out = part if out is None else out.unionByName(part)
    return out


def fold_scores(scored: DataFrame, target: str = "target", weight: str | None = "weights", fold: str = "fold", name: str = "score") -> DataFrame:
    """Area under the curve per fold."""
    return weighted_auc(scored, name, target, weight, [fold]) if weight else auc(scored, name, target, [fold])


def draw_params(trials: int, ranges: Mapping[str, tuple] = SEARCH_RANGES, fixed: Mapping = SEARCH_PARAMS, seed: int = 42) -> list[dict]:
    """Seeded random draws: whole numbers from whole ranges, else even over the range."""
    rng = random.Random(seed)
    draws = []
    for _ in range(trials):
        drawn = {k: rng.randint(lo, hi) if isinstance(lo, int) else rng.uniform(lo, hi) for k, (lo, hi) in ranges.items()}
        if "featureSubsetStrategy" in drawn:
            drawn["featureSubsetStrategy"] = str(round(drawn["featureSubsetStrategy"], 4))
        draws.append({**fixed, **drawn})
    return draws


def param_search(
    data: DataFrame,
    features: Features,
    draws: Sequence[Mapping],
    fold: str = "fold",
    folds: int = 5,
    target: str = "target",
    weight: str | None = "weights",
    seed: int = 42,
    patience: int = PATIENCE,
    at_once: int = 4,
    folder: str | None = None,
    keep: float = 1.0,
) -> DataFrame:
    """Mean fold score (without weights) of every draw, best first. One row per draw. The input is computed once for all draws.

    Rows that no model tells apart are scored as one row that counts as many, where that at least halves the rows (see ``merged_rows``).
    ``at_once`` trials run at a time, as jobs in pools of their own (they share the cluster evenly if the session schedules fairly). The
    scores of a trial are written to ``folder`` when it ends, and a search that finds them there, with the same parameters,
    takes them as they are: a driver that was lost goes on where it stopped. One folder belongs to one search over one input. With
    ``keep`` below 1 all draws are fitted for fold 0 first, and only that share of them, the best, for the other folds; the
    others have no mean score and come last.
    """
    data = checkpointed(data)
    spark = data.sparkSession
    ready = model_input(data, features).withColumn(target, F.col(target).cast("double"))
    ready = ready.where(F.col(weight).isNotNull()) if weight else ready
    ready = checkpointed(ready.select(*[c for c in (target, weight, fold, "features") if c]))
    to_score, count = merged_rows(data.select(*[quoted(c) for c in dict.fromkeys((target, fold, *features.codes, *features.numeric))]), None)
    words = [{k: str(v) for k, v in params.items()} for params in draws]
    scores = _stored_scores(spark, folder, words) if folder else {}

    def trial(i: int, wanted: Sequence[int]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{i}")
        models = _fitted(ready, features, draws[i], fold, wanted, target, weight, seed, patience)
        scored = checkpointed(predict_held_out(models, to_score, features, fold).select(*[c for c in (target, fold, count, "score") if c]))
        found = {r[fold]: r["auc"] for r in fold_scores(scored, target, count, fold).collect()}
        own = [(i, words[i], k, found.get(k)) for k in wanted]
        if folder:
            table = spark.createDataFrame(own, _SCORES).coalesce(1)
            table.write.mode("overwrite").parquet(f"{folder}/trial-{i}-{'-'.join(map(str, wanted))}")
        scores.update({(i, k): score for _, _, k, score in own})

    def rung(chosen: Iterable[int], of: Sequence[int]) -> None:
        open_folds = {i: [k for k in of if (i, k) not in scores] for i in chosen}
        with ThreadPoolExecutor(at_once) as pool:
            for done in [pool.submit(inheritable_thread_target(spark)(trial), i, ks) for i, ks in open_folds.items() if ks]:
                done.result()

    chosen = list(range(len(draws)))
    if keep < 1:
        rung(chosen, [0])
        first = {i: -1.0 if scores[i, 0] is None else scores[i, 0] for i in chosen}
        chosen = sorted(chosen, key=lambda i: (-first[i], i))[: max(1, math.ceil(keep * len(draws)))]
    rung(chosen, range(folds))
    rows = []
    for i in range(len(draws)):
        own = [scores[i, k] for k in range(folds) if scores.get((i, k)) is not None] if i in chosen else []
        rows.append((i, words[i], sum(own) / len(own) if own else None))
    found = spark.createDataFrame(rows, "trial int, params map<string,string>, mean_score double")
    return found.orderBy(F.col("mean_score").desc_nulls_last(), "trial")


def _stored_scores(spark: SparkSession, folder: str, words: Sequence[Mapping[str, str]]) -> dict[tuple[int, int], float | None]:
    """Scores by trial and fold that earlier runs wrote whole; at most one row per draw and fold."""
    whole = [p.rsplit("/", 1)[0] for p in expand(spark, f"{folder}/trial-*/_SUCCESS")]
    rows = spark.read.schema(_SCORES).parquet(*whole).collect() if whole else []
    return {(r["trial"], r["fold"]): r["auc"] for r in rows if r["trial"] < len(words) and r["params"] == words[r["trial"]]}


def feature_importance(spark: SparkSession, models: PipelineModel | Mapping[int, PipelineModel], features: Features) -> DataFrame:
    """Per feature: how many splits in the trees of all models use it, and its mean gain share. One row per feature.

    Splits are counted from the node tables of the saved ensembles, on the executors.
    """
    models = list(models.values()) if isinstance(models, Mapping) else [models]
    nodes = None
    for model in models:
        path = scratch_path(spark, "ensemble")
        model.stages[-1].write().save(path)
        used = spark.read.parquet(f"{path}/data").select(F.col("nodeData.split.featureIndex").alias("place")).where("place >= 0")
        nodes = used if nodes is None else nodes.unionByName(used)
    gains = sum(m.stages[-1].featureImportances.toArray() for m in models) / len(models)
    names = spark.createDataFrame([(i, n, float(gains[i])) for i, n in enumerate(features.names)], "place int, feature_name string, importance_gain double")
    splits = nodes.groupBy("place").agg(F.count("*").cast("int").alias("n"))
    return names.join(splits, "place", "left").select("feature_name", F.coalesce("n", F.lit(0)).alias("importance_split"), "importance_gain")


def select_weak_features(importance: DataFrame, below: float = 10) -> DataFrame:
    """Names of features used in fewer splits than the bound."""
    return importance.filter(F.col("importance_split") < below).select("feature_name")


def save_models(models: Mapping[int, PipelineModel], path: str) -> None:
    for k, model in models.items():
        model.write().overwrite().save(f"{path}/fold={k}")


def load_models(path: str, folds: int) -> dict[int, PipelineModel]:
    return {k: PipelineModel.load(f"{path}/fold={k}") for k in range(folds)}


def save_names(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """A list of names as a table of one column, with places, so that the order is kept."""
    spark.createDataFrame(list(enumerate(names)), "place int, name string").write.mode("overwrite").parquet(path)


def load_names(spark: SparkSession, path: str) -> list[str]:
    return [r["name"] for r in spark.read.parquet(path).orderBy("place").collect()]
