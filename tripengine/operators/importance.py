"""Feature importance by several methods, and their merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripengine.functions.tails import chi_square_tail
from tripengine.operators.encode import assemble
from tripengine.operators.joins import merge_scores
from tripengine.operators.models import SEED, fit_rows
from tripengine.operators.profile import mean_score
from tripengine.operators.treetables import is_forest, mean_attributions, swap_changes
from tripengine.session import materialise


def _scores(spark: SparkSession, names: Sequence[str], values, column: str) -> DataFrame:
    """Feature scores of one model as a table, scaled to sum 1."""
    total = float(sum(values))
    schema = T.StructType([
        T.StructField("feature", T.StringType()), T.StructField(column, T.DoubleType()),
    ])
    rows = [(n, float(v) / total if total else 0.0) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, schema)


def forest_importance(
    df: DataFrame, names: Sequence[str], label: str, features: str = "features",
    trees: int = 50, column: str = "rf_importance", **params,
):
    """Random-forest importances, and the fitted model."""
    model = fit_rows(RandomForestRegressor(
        featuresCol=features, labelCol=label, numTrees=trees, seed=SEED, **params
    ), df)
    scores = model.featureImportances.toArray()
    return _scores(df.sparkSession, names, scores, column), model


def boosting_importance(
    df: DataFrame, names: Sequence[str], label: str, features: str = "features",
    iterations: int = 50, column: str = "gbt_importance",
) -> DataFrame:
    model = fit_rows(GBTRegressor(
        featuresCol=features, labelCol=label, maxIter=iterations, seed=SEED
    ), df)
    return _scores(df.sparkSession, names, model.featureImportances.toArray(), column)


def lasso_importance(
    df: DataFrame, names: Sequence[str], label: str, features: str = "features",
    strength: float = 0.1, column: str = "lasso_importance",
) -> DataFrame:
    """Absolute coefficients of an L1-penalised linear model."""
    model = LinearRegression(
        featuresCol=features, labelCol=label, regParam=strength, elasticNetParam=1.0
    ).fit(df)
    return _scores(df.sparkSession, names, abs(model.coefficients.toArray()), column)


def ranked_elimination(
    df: DataFrame, names: Sequence[str], label: str, trees: int = 30, step: int | None = None,
    column: str = "rfe_score",
) -> DataFrame:
    """Forest importances, best first.

    Without ``step`` one forest ranks all features. With it the ``step``
    weakest features are dropped and the forest refitted until none is left;
    a feature's score is then its importance in the last fit that held it.
    """
    def fit(left: list[str]) -> dict[str, float]:
        frame = assemble(left, "rfe_features").transform(df.select(*left, label))
        _, model = forest_importance(frame, left, label, "rfe_features", trees)
        return dict(zip(left, model.featureImportances.toArray()))

    left, scores = list(names), {}
    while left:
        ranked = sorted(fit(left).items(), key=lambda item: item[1])
        dropped = ranked if step is None else ranked[:step]
        scores.update(dropped)
        left = [n for n in left if n not in scores]
    table = _scores(df.sparkSession, list(scores), list(scores.values()), column)
    return table.orderBy(F.desc(column), "feature")


def permutation_importance(
    df: DataFrame, model, names: Sequence[str], features: str = "features",
    rows_per_bucket: int = 1000, column: str = "permutation_importance",
) -> DataFrame:
    """Mean absolute change of the prediction when one feature is swapped.

    Equal rows are counted together, so none is frequent, and thrown into
    buckets of bounded size by a hash of their values, so that pairs do not
    depend on how rows lie in files. Each takes the feature's value from the
    next one of its bucket, the last from the first. Nothing is joined. What a
    swap changes in a forest is looked up in tables; other models predict anew.
    """
    buckets = max(1, df.count() // rows_per_bucket)
    counted = df.groupBy(vector_to_array(features).alias("own")).agg(F.count("*").alias("n"))
    thrown = counted.withColumns({
        "bucket": F.pmod(F.xxhash64("own", F.lit(SEED)), F.lit(buckets)),
        "place": F.xxhash64("own", F.lit(SEED + 1)),
    })
    walk = Window.partitionBy("bucket").orderBy("place", "own")
    whole = walk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    paired = thrown.withColumn(
        "other", F.coalesce(F.lead("own").over(walk), F.first("own").over(whole))
    )

    changes = swap_changes(paired, model, names) if is_forest(model) else \
        _predicted_changes(paired, model, names, features)
    mean = F.try_divide(F.sum("total"), F.sum("n"))
    found = dict(map(tuple, changes.groupBy("feature").agg(mean).collect()))  # a row per feature
    return _scores(df.sparkSession, names, [found[n] for n in names], column)


def _predicted_changes(paired: DataFrame, model, names: Sequence[str], features: str) -> DataFrame:
    """Absolute changes of the prediction by feature, for each pair of counted rows: feature, total, n."""
    plain = model.transform(paired.withColumn(features, array_to_vector("own")))
    paired = plain.select("own", "other", "n", F.col("prediction").alias("plain"))

    def swapped(i: int):
        vector = F.transform(
            "own", lambda v, j: F.when(j == i, F.get(F.col("other"), j)).otherwise(v)
        )
        return F.struct(F.lit(names[i]).alias("feature"), vector.alias("values"))

    variants = paired.select(
        "plain", "n", F.inline(F.array(*[swapped(i) for i in range(len(names))]))
    ).withColumn(features, array_to_vector("values"))
    change = F.col("n") * F.abs(F.col("prediction") - F.col("plain"))
    return model.transform(variants).select("feature", change.alias("total"), "n")


def attribution_importance(
    df: DataFrame, model, names: Sequence[str], features: str = "features", column: str = "attribution_importance",
) -> DataFrame:
    """Mean absolute Shapley value of every feature in a fitted forest's predictions."""
    found = dict(map(tuple, mean_attributions(df, model, names, features).collect()))  # a row per feature
    return _scores(df.sparkSession, names, [found[n] for n in names], column)


RANKINGS = [
    "rf_importance", "gbt_importance", "lasso_importance", "rfe_score",
    "permutation_importance",
]


def merged_importance(tables: dict[str, DataFrame]) -> DataFrame:
    """Score tables merged on the feature, with their mean, best first."""
    return mean_score(merge_scores(tables), list(tables))


def chi_square(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Chi-square test of independence of each categorical column and a label.

    Worked out from counts per pair of categories, so any number of categories
    will do. Rows that lack one of the columns are left out of all tests.
    """
    texts = df.select([F.col(c).cast("string").alias(c) for c in [*columns, label]]).dropna()
    cells = (
        texts.unpivot([label], list(columns), "feature", "category")
        .groupBy("feature", "category", label).agg(F.count("*").cast("double").alias("o"))
    )
    cells = materialise(cells, "cells")
    by_row = cells.groupBy("feature", "category").agg(F.sum("o").alias("r"))
    by_label = cells.groupBy("feature", label).agg(F.sum("o").alias("k"))
    # a sum over filled cells is enough: empty ones add nothing to o * o / (r * k)
    ratio = cells.join(by_row, ["feature", "category"]).join(by_label, ["feature", label]) \
        .groupBy("feature").agg(F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("k"))).alias("s"),
                                F.sum("o").alias("n"))
    sizes = by_row.groupBy("feature").agg(F.count("*").alias("rows")).join(
        by_label.groupBy("feature").agg(F.count("*").alias("labels")), "feature")
    found = ratio.join(sizes, "feature").select(
        "feature", (F.col("n") * (F.col("s") - 1)).alias("statistic"),
        ((F.col("rows") - 1) * (F.col("labels") - 1)).alias("degrees_of_freedom"))
    # a row per feature, so the tail of the distribution is worked out on the driver
    rows = [(r["feature"], r["statistic"], r["degrees_of_freedom"],
             chi_square_tail(r["statistic"], r["degrees_of_freedom"]) if r["degrees_of_freedom"] else 1.0)
            for r in found.collect()]
    return df.sparkSession.createDataFrame(
        rows, "feature string, statistic double, degrees_of_freedom bigint, p_value double")
