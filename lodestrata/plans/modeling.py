"""Prediction of the next cycle and vulnerability clusters, on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from lodestrata.functions.numeric import half_up, safe_ratio
from lodestrata.operators import centroids
from lodestrata.operators.keys import stratified_split
from lodestrata.plans.rules import Rules
from lodestrata.storage import materialise

# Known before the predicted cycle; anything measured with the outcome would leak it.
LEAK_FREE = ("prior_rate", "prior_mean_score", "prior_participation", "prior_parent_rate",
             "target_cycle", "target_final")
OUTCOME = "y_rate"
BASELINE, RIDGE, FOREST = "baseline", "ridge", "random_forest"
#: Trees that are fitted together and training rows of a task. Every task sends statistics of every open node of its trees,
#: so many small tasks cost more than few whole ones; the fits of a forest run side by side instead.
FIT_TREES, FIT_ROWS = 10, 100_000


def modelling_rows(features: DataFrame) -> DataFrame:
    """Units with history and outcome."""
    return features.na.drop(subset=["prior_rate", OUTCOME])


def split_rows(features: DataFrame, seed: int = 42, test_share: float = 0.2) -> DataFrame:
    return stratified_split(modelling_rows(features), "region_name", ["unit_id"], test_share, seed)


def usable_columns(train: DataFrame, numeric: Sequence[str]) -> list[str]:
    """Columns with at least one value; a median cannot fill the others."""
    filled = train.agg(*[F.count(c).alias(c) for c in numeric]).first()
    return [c for c in numeric if filled[c]]


def feature_pipeline(numeric: Sequence[str], category: str) -> Pipeline:
    """Median imputation, one-hot category, one vector; fitted on training rows only."""
    filled = [f"{c}_filled" for c in numeric]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(numeric), outputCols=filled),
        StringIndexer(inputCol=category, outputCol="_category", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="_category", outputCol="_onehot", dropLast=True),
        VectorAssembler(inputCols=[*filled, "_onehot"], outputCol="features"),
    ])


def feature_names(prepared: PipelineModel, numeric: Sequence[str], category: str) -> list[str]:
    return [*numeric, *[f"{category}={label}" for label in prepared.stages[1].labels]]


def error_metrics(actual: str, predicted: str) -> dict[str, Column]:
    """MAE, RMSE and R2 as plain aggregates."""
    miss = F.col(actual) - F.col(predicted)
    rows = F.count(F.lit(1))
    spread = F.sum(F.col(actual) * F.col(actual)) - F.sum(actual) * F.sum(actual) / rows
    return {"mae": half_up(F.avg(F.abs(miss)), 2), "rmse": half_up(F.sqrt(F.avg(miss * miss)), 2),
            "r2": half_up(1.0 - safe_ratio(F.sum(miss * miss), spread), 3)}


def metrics_row(rows: DataFrame, model: str, actual: str, predicted: str) -> DataFrame:
    measured = rows.agg(*[c.alias(n) for n, c in error_metrics(actual, predicted).items()])
    return measured.select(F.lit(model).alias("model"), "mae", "rmse", "r2")


@dataclass
class Fitted:
    """Fitted models with their test predictions."""

    features: list[str]
    models: dict[str, Transformer]
    predictions: dict[str, DataFrame]


def _ridge(train: DataFrame, alpha: float) -> PipelineModel:
    """Ridge on standardised features.

    Spark scales the label by its population deviation inside the normal solver, so
    the penalty that equals ``alpha`` on the sum of squares is alpha * std(y) / n.
    ``StandardScaler`` divides by the sample deviation; the penalty is corrected for it.
    """
    scale = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(train)
    n, spread = train.agg(F.count(F.lit(1)), F.stddev_pop(OUTCOME)).first()
    strength = alpha * (n - 1) / n * (spread or 1.0) / n
    linear = LinearRegression(featuresCol="scaled", labelCol=OUTCOME, elasticNetParam=0.0, regParam=strength,
                              standardization=False, solver="normal").fit(scale.transform(train))
    return PipelineModel(stages=[scale, linear])


class Forest(Transformer):
    """A random forest of several fits: the mean of all trees."""

    def __init__(self, fits: Sequence[RandomForestRegressionModel]):
        super().__init__()
        self.fits = list(fits)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, trees, rows = dataset.columns, [fit.getNumTrees for fit in self.fits], dataset
        for i, fit in enumerate(self.fits):
            rows = fit.copy({fit.predictionCol: f"_fit_{i}"}).transform(rows)
        total = sum((F.col(f"_fit_{i}") * n for i, n in enumerate(trees)), F.lit(0.0))
        return rows.select(*columns, (total / sum(trees)).alias("prediction"))

    @property
    def featureImportances(self) -> DenseVector:
        """As Spark defines it for a forest: importances of each tree, normed to 1, added and normed to 1."""
        total = sum(tree.featureImportances.toArray() for fit in self.fits for tree in fit.trees)
        return DenseVector(total / (total.sum() or 1.0))


def _forest(train: DataFrame, rows: int, trees: int, depth: int, leaf: int, seed: int) -> Forest:
    """``FIT_TREES`` trees at a time, side by side, each fit with a seed of its own; what a tree draws follows from the rows
    and the seed, not from how the rows lie in files."""
    spark, tasks = train.sparkSession, max(1, ceil(rows / FIT_ROWS))
    dealt = train.select("unit_id", "features", OUTCOME).repartition(tasks, "unit_id").sortWithinPartitions("unit_id").cache()

    @inheritable_thread_target(spark)
    def fit(first: int) -> RandomForestRegressionModel:
        return RandomForestRegressor(
            labelCol=OUTCOME, numTrees=min(FIT_TREES, trees - first), maxDepth=depth, minInstancesPerNode=leaf,
            seed=seed + 10_000 * first, featureSubsetStrategy="all").fit(dealt)

    dealt.count()  # one job fills the cache that all fits read
    with ThreadPool(min(ceil(trees / FIT_TREES), max(2, spark.sparkContext.defaultParallelism))) as pool:
        fits = pool.map(fit, range(0, trees, FIT_TREES), chunksize=1)
    dealt.unpersist()
    return Forest(fits)


def fit_models(split: DataFrame, which: Sequence[str] = (RIDGE, FOREST), trees: int = 300, depth: int = 12,
               leaf: int = 5, alpha: float = 1.0, seed: int = 42, numeric: Sequence[str] = LEAK_FREE,
               category: str = "region_name") -> Fitted:
    """Fit on the training rows and predict the test rows."""
    split = materialise(split.select("unit_id", category, OUTCOME, "is_test",
                                     *[F.col(c).cast("double") for c in numeric]), "split")
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    numeric = usable_columns(train, numeric)
    prepared = feature_pipeline(numeric, category).fit(train)
    vectors = prepared.transform(train).cache()
    models: dict[str, Transformer] = {}
    if RIDGE in which:
        models[RIDGE] = _ridge(vectors, alpha)
    if FOREST in which:
        models[FOREST] = _forest(vectors, vectors.count(), trees, depth, leaf, seed)
    vectors.unpersist()
    ready = prepared.transform(test)
    predictions = {BASELINE: test.withColumn("prediction", F.col("prior_rate"))}
    predictions |= {name: model.transform(ready) for name, model in models.items()}
    return Fitted(feature_names(prepared, numeric, category), models, predictions)


def compare_models(fitted: Fitted) -> DataFrame:
    """Metrics of every model and its gain over repeating the last cycle."""
    parts = [metrics_row(rows, name, OUTCOME, "prediction") for name, rows in fitted.predictions.items()]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    naive = parts[0].select("mae").scalar()
    return table.withColumn("gain_pct", half_up((1.0 - safe_ratio(F.col("mae"), naive)) * 100.0, 1))


def best_model(comparison: DataFrame) -> DataFrame:
    return comparison.where(F.col("model") != BASELINE).orderBy("mae", "model").limit(1)


def residuals(rows: DataFrame) -> DataFrame:
    return rows.select("unit_id", (F.col(OUTCOME) - F.col("prediction")).alias("residual"))


def residual_summary(fitted: Fitted) -> DataFrame:
    parts = [residuals(rows).agg(F.count(F.lit(1)).alias("rows"), half_up(F.avg("residual"), 4).alias("mean"),
                                 half_up(F.stddev_samp("residual"), 4).alias("std"))
             .select(F.lit(name).alias("model"), "*") for name, rows in fitted.predictions.items()]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def importance(fitted: Fitted, model: str, size: int = 10) -> DataFrame:
    """Impurity importance of a forest, or absolute standardised coefficients of a ridge."""
    fit = fitted.models[model]
    weights = (fit.stages[-1].coefficients if isinstance(fit, PipelineModel) else fit.featureImportances).toArray()
    spark = next(iter(fitted.predictions.values())).sparkSession
    rows = [(n, float(abs(w))) for n, w in zip(fitted.features, weights, strict=True)]
    return (spark.createDataFrame(rows, "feature string, weight double")
            .orderBy(F.col("weight").desc(), "feature").limit(size))


def cluster_vectors(base: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Standardised vector of the (already filled) measures in ``scaled``."""
    vectors = VectorAssembler(inputCols=list(measures), outputCol="features", handleInvalid="skip").transform(base)
    return StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(vectors).transform(vectors)


def cluster_scan(vectors: DataFrame, ks: Sequence[int] = (2, 3, 4, 5, 6),
                 seeds: Sequence[int] = tuple(range(42, 52))) -> tuple[DataFrame, dict[int, centroids.Clusters]]:
    """Silhouette and inertia per k, each the best of several seeds, and the clusters; every pass serves all k and seeds."""
    found = centroids.scan(vectors.select(vector_to_array("scaled").alias("x")), ks, seeds)
    rows = [(k, None if c.silhouette is None else round(c.silhouette, 3), float(round(c.inertia))) for k, c in found.items()]
    return vectors.sparkSession.createDataFrame(rows, "k int, silhouette double, inertia double"), found


def choose_k(scan: DataFrame, low: int = 3, high: int = 6) -> DataFrame:
    """Best silhouette within [low, high], beside the best one without that bound."""
    best_first = [F.col("silhouette").desc(), F.col("k").asc()]
    unbounded = scan.orderBy(*best_first).limit(1).select("k").scalar()
    return scan.where(F.col("k").between(low, high)).orderBy(*best_first).limit(1).withColumn("k_unbounded", unbounded)


def cluster_profiles(clustered: DataFrame, measures: Sequence[str], rules: Rules, name_by: str = "rate") -> DataFrame:
    """Size and means of each cluster, named in ascending order of ``name_by``."""
    stats = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("units"), F.avg(name_by).alias("_order"),
        *[half_up(F.avg(m), 2).alias(m) for m in measures])
    # k rows at most: the driver orders them and names them.
    order = [r[0] for r in stats.orderBy("_order", "cluster").select("cluster").collect()]
    names = clustered.sparkSession.createDataFrame(
        [(c, i, rules.cluster_names[i]) for i, c in enumerate(order)], "cluster int, place int, profile string")
    return stats.drop("_order").join(names, "cluster")


def priority_mart(priority: DataFrame, clustered: DataFrame, profiles: DataFrame) -> DataFrame:
    """The priority table with cluster and profile, as stored."""
    tagged = clustered.select("unit_id", "cluster").join(profiles.select("cluster", "profile"), "cluster", "left")
    return priority.join(tagged, "unit_id", "left").select(
        "unit_id", "unit_name", "parent_id", "parent_name", "region_name", "cluster", "profile", "rate", "gap_final",
        "change", "change_adjusted", "diff_parent", "priority", "priority_band", "series_alert")
