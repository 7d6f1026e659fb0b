"""Regression models: training, tuning, evaluation, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from itertools import product
from math import isnan
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripengine.functions.predicates import hash_bucket
from tripengine.operators import gram, growth
from tripengine.operators.clean import fresh_name, hash_split
from tripengine.operators.encode import assemble, encoding_stages
from tripengine.operators.treetables import truncations
from tripengine.session import materialise

SEED = 42

MODELS = {
    "linear_reg": LinearRegression,
    "decision_tree": DecisionTreeRegressor,
    "random_forest": RandomForestRegressor,
    "gradient_boosting": GBTRegressor,
}

# The grids the models are tuned over, and how.
GRIDS = {
    "linear_reg": {"regParam": [0.1, 0.01, 0.001], "elasticNetParam": [0.0, 0.5, 1.0]},
    "decision_tree": {"maxDepth": [5, 10, 20], "maxBins": [32, 64]},
    "random_forest": {"maxDepth": [5, 10], "numTrees": [10, 25]},
    "gradient_boosting": {"maxIter": [10, 25], "maxDepth": [3, 5]},
}
FOLDS = {"linear_reg": 3, "decision_tree": 2}
TRAIN_RATIO = 0.8

# Settings of which one fit at the largest value holds all smaller ones: a tree
# cut off at a depth, the first trees of a forest, the first iterations.
NESTED = {
    "decision_tree": ("maxDepth",),
    "random_forest": ("maxDepth", "numTrees"),
    "gradient_boosting": ("maxIter",),
}
#: Rows in a partition while a model is fitted; Spark holds some hundred bytes for each.
FIT_ROWS = 500_000
#: Rows beyond which trees are grown over blocks of binned rows; below, passes cost more than rows.
GROWN_ROWS = 2_000_000
# Models that are fitted at a time. Their jobs share the session's executors;
# with spark.scheduler.mode=FAIR each fit has a pool of its own.
AT_A_TIME = 4

LEADERBOARD = T.StructType([
    T.StructField("encoding", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("validation_r2", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
])


def regressor(name: str, features: str, label: str, **params):
    """An untrained model by its short name; tree models are seeded."""
    if name != "linear_reg":
        params.setdefault("seed", SEED)
    return MODELS[name](featuresCol=features, labelCol=label, **params)


def spread(df: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows, in partitions of about ``rows`` at most; a small table stays as it lies."""
    parts = -(-df.count() // rows)
    return df if parts < 2 else df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism))


def one_per_input(df: DataFrame, features: str, label: str, weight: str) -> DataFrame:
    """One row for each vector of features, with the mean label and the number of its rows."""
    every = F.when(F.count(label) == F.count("*"), F.avg(label))  # a missing label is still an error
    cells = df.groupBy(vector_to_array(features).alias(features)).agg(
        every.alias(label), F.count("*").cast("double").alias(weight))
    stored = materialise(cells, "inputs").withColumn(features, array_to_vector(features))
    return stored.withMetadata(features, df.schema[features].metadata)


def fit_rows(estimator, df: DataFrame):
    """The estimator's model, fitted on rows in partitions of bounded size.

    Trees ask a set of rows for its count and its sum of labels only. So those
    that draw no rows at random find the same splits and means where rows with
    equal features are one, with their mean label and their number as weight.

    Trees of a large table that draw rows, or whose rows can have many
    combinations of values, are grown over blocks of binned rows (``growth``).
    """
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    if isinstance(estimator, LinearRegression):
        return estimator.fit(df)
    draws = estimator.hasParam("subsamplingRate") and estimator.getSubsamplingRate() < 1
    draws = draws or estimator.hasParam("bootstrap") and estimator.getBootstrap()
    if growth.can_grow(estimator, df) and (rows := df.count()) > GROWN_ROWS:
        grown = growth.fit(estimator, df, 0 if draws else rows // 8)
        if grown is not None:
            return grown
    if draws:
        return estimator.fit(spread(df.select(features, label)))
    cells = one_per_input(df, features, label, weight := fresh_name("rows", [features, label]))
    return estimator.copy({estimator.weightCol: weight}).fit(spread(cells))


def regression_pipeline(
    model: str, encoding: str, categorical: Sequence[str], numeric: Sequence[str], label: str,
    **params,
) -> Pipeline:
    """Encoding, scaling and model as one pipeline."""
    stages, features = encoding_stages(encoding, categorical, numeric, label)
    return Pipeline(stages=[*stages, regressor(model, features, label, **params)])


def metrics(df: DataFrame, label: str, prediction: str = "prediction",
            by: Sequence[str] = ()) -> DataFrame:
    """R2, MAE and RMSE of predictions in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    squared = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        (1 - F.try_divide(squared, spread)).alias("r2"),
        F.mean(F.abs(y - p)).alias("mae"),
        F.sqrt(F.mean((y - p) * (y - p))).alias("rmse"),
    )


def r2_evaluator(label: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring; works the same on a stream."""
    return model.transform(df)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _grid(stage, params: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, values in params.items():
        builder = builder.addGrid(stage.getParam(name), list(values))
    return builder.build()


def cross_validate(
    pipeline: Pipeline, train: DataFrame, label: str, folds: int = 3,
    params: Mapping[str, Sequence] | None = None, parallelism: int = 4,
):
    """K-fold cross-validation by R2 over a grid for the last stage.

    A row's fold is a hash of its values, wherever it lies; equal rows share one.
    """
    grid = _grid(pipeline.getStages()[-1], params or {})
    dealt = train.withColumn("fold", hash_bucket(*train.columns, buckets=folds, salt="fold").cast("int"))
    return CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=r2_evaluator(label),
        numFolds=folds, foldCol="fold", parallelism=parallelism,
    ).fit(dealt)


class Validated(NamedTuple):
    bestModel: PipelineModel
    validationMetrics: list[float]


def validate_split(
    pipeline: Pipeline, train: DataFrame, label: str, params: Mapping[str, Sequence],
    ratio: float = TRAIN_RATIO, parallelism: int = 4,
):
    """One train/validation split by R2 over a grid for the last stage.

    Rows are split by a hash of their values, and the best parameters are
    fitted on all rows.
    """
    grid, evaluator = _grid(pipeline.getStages()[-1], params), r2_evaluator(label)
    fitted, held_out = hash_split(train, round(100 * ratio), *train.columns, salt="validation")
    fitted, held_out = _kept(fitted), _kept(held_out)
    with ThreadPool(min(parallelism, len(grid))) as pool:
        found = pool.map(
            lambda chosen: evaluator.evaluate(pipeline.fit(fitted, chosen).transform(held_out)), grid
        )
    fitted.unpersist()
    held_out.unpersist()
    return Validated(pipeline.fit(train, grid[max(range(len(grid)), key=found.__getitem__)]), found)


def best_params(model: PipelineModel, names: Sequence[str]) -> dict[str, str]:
    """Parameters of the model stage of a fitted pipeline."""
    last = model.stages[-1]
    return {name: str(last.getOrDefault(name)) for name in names}


def _kept(df: DataFrame) -> DataFrame:
    """Kept while several models read it; lost blocks are computed again."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _board_row(encoding, name, params, validation, predictions, label) -> tuple:
    m = metrics(predictions, label).first()
    return (encoding, name, params, validation, m["r2"], m["mae"], m["rmse"])


def concurrently(df: DataFrame, work: Callable, tasks: Iterable) -> list:
    """The results of ``work`` for each task, a few at a time, each in a scheduler pool of its own."""
    context, tasks = df.sparkSession.sparkContext, list(tasks)

    def pooled(numbered):
        i, task = numbered
        context.setLocalProperty("spark.scheduler.pool", f"fit-{i % AT_A_TIME}")
        return work(task)

    if len(tasks) < 2:
        return [work(task) for task in tasks]
    with ThreadPool(min(AT_A_TIME, len(tasks))) as pool:
        return pool.map(pooled, enumerate(tasks), chunksize=1)


class Encoded(NamedTuple):
    """An encoding fitted on training rows, and both parts as stored tables of features and label."""
    encoder: PipelineModel
    features: str
    train: DataFrame
    held_out: DataFrame


def encoded(train: DataFrame, held_out: DataFrame, categorical: Sequence[str], numeric: Sequence[str],
            label: str, encoding: str) -> Encoded:
    """Rows encoded once for all models that read them. The tables are written, so a lost
    executor costs a file's reading, not the whole chain before it."""
    stages, features = encoding_stages(encoding, categorical, numeric, label)
    encoder = Pipeline(stages=stages).fit(train)
    stored = [materialise(encoder.transform(df).select(features, label), "encoded") for df in (train, held_out)]
    return Encoded(encoder, features, *stored)


def grid_points(params: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of a grid's values."""
    return [dict(zip(params, values, strict=True)) for values in product(*params.values())]


def nested_scores(name: str, parts: Encoded, label: str, points: Sequence[Mapping]) -> list[float]:
    """R2 on the held-out rows of each grid point.

    Points that differ in nested settings only share one fit, at the largest
    of their values; the others are cut out of it. All are scored in one pass.
    """
    groups: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        outer = tuple(sorted((k, v) for k, v in point.items() if k not in NESTED[name]))
        groups.setdefault(outer, []).append(i)

    def of_group(group: tuple[tuple, list[int]]) -> list[tuple[int, float]]:
        outer, members = group
        largest = {k: max(points[i][k] for i in members) for k in NESTED[name] if k in points[members[0]]}
        model = fit_rows(regressor(name, parts.features, label, **dict(outer), **largest), parts.train)
        smaller = [i for i in members if any(points[i][k] != v for k, v in largest.items())]
        cuts = truncations(model, [(points[i].get("maxDepth") if "maxDepth" in largest else None,
                                    points[i].get("numTrees", points[i].get("maxIter"))) for i in smaller])
        cut, seen = dict(zip(smaller, cuts, strict=True)), parts.held_out
        for i in members:
            seen = cut.get(i, model).setPredictionCol(f"prediction_{i}").transform(seen)
        y = F.col(label)
        found = seen.agg(*[
            (1 - F.try_divide(F.sum((y - F.col(f"prediction_{i}")) ** 2), F.var_pop(y) * F.count(y))).alias(str(i))
            for i in members]).first()
        return [(i, float("nan") if found[str(i)] is None else found[str(i)]) for i in members]

    scores = dict(pair for pairs in concurrently(parts.train, of_group, groups.items()) for pair in pairs)
    return [scores[i] for i in range(len(points))]


def dealt(train: DataFrame, folds: int) -> DataFrame:
    """The rows with their fold: a hash of their values, wherever they lie; equal rows share one."""
    return train.withColumn("fold", hash_bucket(*train.columns, buckets=folds, salt="fold").cast("int"))


def validation_parts(train: DataFrame, folds: int | None) -> list[tuple[DataFrame, DataFrame]]:
    """Training and validation rows of each fold, or of one split by ``TRAIN_RATIO``."""
    if folds is None:
        return [hash_split(train, round(100 * TRAIN_RATIO), *train.columns, salt="validation")]
    rows = dealt(train, folds)
    return [tuple(rows.where(c).drop("fold") for c in (F.col("fold") != f, F.col("fold") == f)) for f in range(folds)]


def _mean(values: Sequence[float]) -> float:
    """The mean of the folds that can be scored."""
    there = [v for v in values if not isnan(v)]
    return sum(there) / len(there) if there else float("nan")


def linear_scores(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str,
                  encodings: Sequence[str], folds: int, points: Sequence[Mapping]) -> dict[str, list[float]]:
    """Mean R2 over folds of each encoding and grid point of a linear model.

    Out of one pass over the rows. With more categories than a table of
    products should hold, every fold and point is fitted by Spark instead.
    """
    try:
        columns = gram.describe_columns(train, categorical, numeric, label)
    except gram.TooManyColumns:
        return {e: _refitted_scores(train, categorical, numeric, label, e, folds, points) for e in encodings}
    found = gram.products(dealt(train, folds), columns, "fold", folds)
    return {e: [_mean(own) for own in gram.cross_validated(found, e, points).tolist()] for e in encodings}


def _refitted_scores(train, categorical, numeric, label, encoding, folds, points) -> list[float]:
    evaluator, scores = r2_evaluator(label), []
    for fitted, held_out in validation_parts(train, folds):
        parts = encoded(fitted, held_out, categorical, numeric, label, encoding)
        scores.append(concurrently(train, lambda point: evaluator.evaluate(
            regressor("linear_reg", parts.features, label, **point).fit(parts.train).transform(parts.held_out)),
            points))
    return [_mean(own) for own in zip(*scores, strict=True)]


def leaderboard(
    spark: SparkSession, train: DataFrame, test: DataFrame, categorical: Sequence[str],
    numeric: Sequence[str], label: str, encodings: Sequence[str], models: Sequence[str],
    folds: int | None = None,
) -> DataFrame:
    """Every encoding with every model, all metrics on the hold-out table.

    With ``folds`` each pair is cross-validated and ``validation_r2`` filled:
    linear models from sums of products per fold, trees by a fit for each fold.
    Each encoding is fitted once for all models, and fits run side by side.
    """
    train, test = materialise(train, "train"), materialise(test, "test")

    def encode_parts(pair: tuple) -> Encoded:
        encoding, (fitted, held_out) = pair
        return encoded(fitted, held_out, categorical, numeric, label, encoding)

    splits = [] if folds is None or set(models) == {"linear_reg"} else validation_parts(train, folds)
    linear = linear_scores(train, categorical, numeric, label, encodings, folds, [{}]) \
        if folds is not None and "linear_reg" in models else {}
    wanted = list(product(encodings, [(train, test), *splits]))
    stored = dict(zip([(e, i) for e in encodings for i in range(1 + len(splits))],
                      concurrently(train, encode_parts, wanted), strict=True))

    def row(pair: tuple[str, str]) -> tuple:
        encoding, name = pair
        whole = stored[encoding, 0]
        fitted = fit_rows(regressor(name, whole.features, label), whole.train)
        validation = None
        if folds is not None:
            validation = linear[encoding][0] if name == "linear_reg" else _mean(
                [nested_scores(name, stored[encoding, 1 + f], label, [{}])[0] for f in range(folds)])
        return _board_row(encoding, name, {}, validation, fitted.transform(whole.held_out), label)

    return spark.createDataFrame(concurrently(train, row, list(product(encodings, models))), LEADERBOARD)


def tune(
    spark: SparkSession, train: DataFrame, test: DataFrame, categorical: Sequence[str],
    numeric: Sequence[str], label: str, models: Sequence[str], encoding: str = "one_hot",
    grids: Mapping[str, Mapping[str, Sequence]] = GRIDS,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Tune models over their grids; a row per model and the best pipelines.

    Linear models read the rows once for all folds and points; trees are fitted
    once for all points that one fit holds (``NESTED``). The best point of each
    model is then fitted on all training rows. Of equal scores the first wins.
    """
    train, test = materialise(train, "train"), materialise(test, "test")
    whole = encoded(train, test, categorical, numeric, label, encoding)
    kinds = {FOLDS.get(name) for name in models if name != "linear_reg"}
    parts = {folds: [encoded(*pair, categorical, numeric, label, encoding) for pair in validation_parts(train, folds)]
             for folds in kinds}

    def tuned(name: str) -> tuple[tuple, PipelineModel]:
        points = grid_points(grids[name])
        if name == "linear_reg":
            scores = linear_scores(train, categorical, numeric, label, [encoding], FOLDS[name], points)[encoding]
        else:
            found = [nested_scores(name, own, label, points) for own in parts[FOLDS.get(name)]]
            scores = [_mean(own) for own in zip(*found, strict=True)]
        best = max(range(len(points)), key=lambda i: (not isnan(scores[i]), scores[i]))
        fitted = fit_rows(regressor(name, whole.features, label, **points[best]), whole.train)
        pipeline = PipelineModel([*whole.encoder.stages, fitted])
        params = best_params(pipeline, list(grids[name]))
        return _board_row(encoding, name, params, scores[best], fitted.transform(whole.held_out), label), pipeline

    results = dict(zip(models, concurrently(train, tuned, models), strict=True))
    return spark.createDataFrame([row for row, _ in results.values()], LEADERBOARD), \
        {name: pipeline for name, (_, pipeline) in results.items()}


def cluster_points(df: DataFrame, columns: Sequence[str], k: int = 10, seed: int = SEED) -> DataFrame:
    """k-means on coordinate columns; rows with a missing coordinate are left out."""
    points = assemble(columns).transform(
        df.dropna(subset=list(columns)).withColumns({c: F.col(c).cast("double") for c in columns})
    )
    # equal points are one with their number as weight: sums over a cluster stay the same
    counted = points.groupBy(*columns).agg(F.count("*").cast("double").alias("rows"))
    counted = spread(assemble(columns).transform(materialise(counted, "points")).select("features", "rows"))
    return KMeans(k=k, seed=seed, weightCol="rows").fit(counted).transform(points).drop("features")
