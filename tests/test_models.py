import random
from contextlib import nullcontext

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import rows
from tripengine import schemas
from tripengine.operators import encode, importance, models
from tripengine.operators.clean import hash_split
from tripengine.streaming.scoring import error_windows, score_arriving

CATEGORICAL, NUMERIC = ["zone", "bin"], ["minutes", "people"]


@pytest.fixture(scope="module")
def linear(spark):
    """A label that is linear in the minutes, with a step per zone and some noise."""
    rng = random.Random(7)
    data = []
    for i in range(800):
        zone, bin_ = rng.choice("ABC"), rng.choice(["Short", "Long"])
        minutes, people = rng.uniform(1, 60), float(rng.randint(1, 6))
        y = 3.0 + 2.0 * minutes + {"A": 0.0, "B": 10.0, "C": 20.0}[zone] + rng.gauss(0, 0.1)
        data.append((i, zone, bin_, minutes, people, y))
    return spark.createDataFrame(
        data, "id int, zone string, bin string, minutes double, people double, fare double"
    ).cache()


@pytest.fixture(scope="module")
def parts(linear):
    return hash_split(linear, 80, "id")


def test_label_among_features_is_refused():
    with pytest.raises(ValueError, match="label"):
        encode.assemble(["minutes", "fare"], label="fare")
    with pytest.raises(ValueError):
        encode.importance_inputs(["zone"], ["minutes", "minutes"], "fare")
    with pytest.raises(ValueError, match="unknown encoding"):
        encode.encoding_stages("hashing", CATEGORICAL, NUMERIC, "fare")


def test_ordinal_codes_by_frequency_then_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    fitted = encode.indexer(["k"]).fit(df)
    assert dict(map(tuple, fitted.transform(df).distinct().collect())) == {"c": 0, "a": 1, "b": 2}
    unseen = spark.createDataFrame([("Night",)], "k string")
    assert fitted.transform(unseen).first().k_index == 3


def test_target_means_in_a_pipeline(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 11.0)], "k string, y double")
    model = Pipeline(stages=[encode.indexer(["k"]), encode.target_mean(["k"], "y")]).fit(train)
    fresh = spark.createDataFrame([("a", 0.0), ("b", 0.0), ("z", 0.0)], "k string, y double")
    got = {r.k: r.k_target for r in model.transform(fresh).collect()}
    assert got == pytest.approx({"a": 2.0, "b": 11.0, "z": 5.0})


@pytest.mark.parametrize("encoding", encode.ENCODINGS)
def test_every_encoding_learns_the_line(parts, encoding):
    train, test = parts
    stages, features = encode.encoding_stages(encoding, CATEGORICAL, NUMERIC, "fare", components=5)
    model = Pipeline(stages=[*stages, models.regressor("linear_reg", features, "fare")]).fit(train)
    floor = {"one_hot_pca": 0.6, "ordinal": 0.9}.get(encoding, 0.99)
    assert models.metrics(model.transform(test), "fare").first().r2 > floor


@pytest.mark.parametrize("name", list(models.MODELS))
def test_models_fit_and_are_seed_stable(parts, name):
    train, test = parts
    pipeline = models.regression_pipeline(name, "one_hot", CATEGORICAL, NUMERIC, "fare")
    first, second = (models.metrics(pipeline.fit(train).transform(test), "fare").first()
                     for _ in range(2))
    assert first.r2 > 0.8 and tuple(first) == pytest.approx(tuple(second))


def test_metrics_equal_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5)], "y double, prediction double")
    got = models.metrics(df, "y").first()
    for name in ("r2", "mae", "rmse"):
        evaluator = RegressionEvaluator(labelCol="y", metricName=name)
        assert got[name] == pytest.approx(evaluator.evaluate(df))
    assert models.metrics(df.filter("false"), "y").first().r2 is None


def test_cross_validation_and_tuning(spark, parts):
    train, test = parts
    board = models.leaderboard(
        spark, train, test, CATEGORICAL, NUMERIC, "fare", ["ordinal"], ["linear_reg"], folds=2)
    row = board.first()
    assert row.validation_r2 > 0.9 and row.r2 > 0.9
    grids = {"linear_reg": {"regParam": [0.01, 100.0], "elasticNetParam": [0.0]},
             "random_forest": {"maxDepth": [1, 5], "numTrees": [4]}}
    board, best = models.tune(
        spark, train, test, CATEGORICAL, NUMERIC, "fare", list(grids), grids=grids)
    found = {r.model_name: r.hyperparameters for r in board.collect()}
    assert found["linear_reg"]["regParam"] == "0.01"
    assert found["random_forest"] == {"maxDepth": "5", "numTrees": "4"}
    assert set(best) == set(grids)


def test_folds_and_splits_do_not_depend_on_layout(parts):
    train = parts[0].select("zone", "minutes", "fare")
    pipeline = models.regression_pipeline("linear_reg", "ordinal", ["zone"], ["minutes"], "fare")
    grid = {"regParam": [0.01, 50.0]}
    for search in (models.cross_validate, models.validate_split):
        options = {"params": grid}
        one, other = (search(pipeline, df, "fare", **options) for df in (train, train.repartition(7)))
        scores = [r.avgMetrics if hasattr(r, "avgMetrics") else r.validationMetrics for r in (one, other)]
        assert scores[0] == pytest.approx(scores[1], rel=1e-9)


def test_saved_model_scores_an_unseen_label(spark, parts, tmp_path):
    train, test = parts
    model = models.regression_pipeline(
        "random_forest", "one_hot", CATEGORICAL, NUMERIC, "fare", numTrees=4).fit(train)
    path = str(tmp_path / "model")
    models.save_model(model, path)
    loaded = models.load_model(path)
    assert rows(loaded.transform(test).select("id", "prediction")) == rows(
        models.score(model, test).select("id", "prediction"))
    odd = spark.createDataFrame(
        [("Staten Island", "Night", 5.0, 1.0)], "zone string, bin string, minutes double, people double")
    assert models.score(loaded, odd).first().prediction is not None


def test_arriving_files_are_scored_once(spark, parts, tmp_path):
    train, test = parts
    model = models.regression_pipeline("linear_reg", "one_hot", CATEGORICAL, NUMERIC, "fare").fit(train)
    folders = [str(tmp_path / n) for n in ("in", "out", "progress")]
    test.repartition(3).write.parquet(folders[0])

    def run():
        query = score_arriving(spark, model, folders[0], test.schema, folders[1], folders[2],
                               output=["id", "prediction"])
        query.awaitTermination()
        return spark.read.parquet(folders[1])

    want = rows(model.transform(test).select("id", "prediction"))
    assert rows(run()) == want
    assert rows(run()) == want
    test.limit(5).write.mode("append").parquet(folders[0])
    assert run().count() == len(want) + 5


def test_errors_by_window_count_trips_once(spark, parts, tmp_path):
    train, _ = parts
    model = models.regression_pipeline("linear_reg", "one_hot", CATEGORICAL, NUMERIC, "fare").fit(train)
    timed = train.withColumn("at", F.timestamp_seconds(F.lit(86_400 * 100) + F.col("id") * 3600))
    last = timed.agg(F.max("at")).first()[0]
    half = timed.agg(F.timestamp_seconds(F.median(F.unix_seconds("at")).cast("long"))).first()[0]
    early, rest = timed.filter(F.col("at") <= half), timed.filter(F.col("at") > half)
    again = early.filter(F.col("at") > F.lit(half) - F.expr("INTERVAL 20 HOURS"))
    ancient = timed.limit(1).withColumns({"id": F.lit(-1), "at": F.timestamp_seconds(F.lit(0))})
    unknown = timed.limit(1).withColumns({"id": F.lit(-2), "at": F.lit(None).cast("timestamp")})
    folders = [str(tmp_path / n) for n in ("in", "out", "progress")]
    for arrived in (early.unionByName(unknown), rest.unionByName(again).unionByName(ancient)):
        arrived.write.mode("append").parquet(folders[0])
        error_windows(spark, model, folders[0], timed.schema, folders[1], folders[2], ["id"], "fare",
                      event_time="at", width="6 hours", delay="1 day").awaitTermination()
    got = rows(spark.read.parquet(folders[1]).select("window_start", "trips", F.round("error_sum", 6)))
    scored = model.transform(timed).groupBy(F.window("at", "6 hours").alias("w")).agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("fare") - F.col("prediction")), 6).alias("e"))
    closed = scored.filter(F.col("w.end") <= F.lit(last) - F.expr("INTERVAL 1 DAY"))
    assert got == rows(closed.select("w.start", "n", "e")) and len(got) > 10


def test_importances_find_the_minutes(linear):
    pipeline, names = encode.importance_inputs(CATEGORICAL, NUMERIC, "fare")
    df = pipeline.fit(linear).transform(linear).select("features", "fare", *names).cache()
    forest, model = importance.forest_importance(df, names, "fare", trees=5)
    tables = {
        "rf_importance": forest,
        "gbt_importance": importance.boosting_importance(df, names, "fare", iterations=3),
        "lasso_importance": importance.lasso_importance(df, names, "fare"),
        "rfe_score": importance.ranked_elimination(df, names, "fare", trees=3),
        "permutation_importance": importance.permutation_importance(df, model, names),
    }
    assert list(tables) == importance.RANKINGS
    for name, table in tables.items():
        scores = {r.feature: r[name] for r in table.collect()}
        assert set(scores) == set(names) and sum(scores.values()) == pytest.approx(1)
        if name != "lasso_importance":
            assert max(scores, key=scores.get) == "minutes"
    merged = importance.merged_importance(tables).collect()
    assert len(merged) == len(names) and merged[0].feature == "minutes"
    assert merged[0].average_importance == pytest.approx(
        np.mean([merged[0][c] for c in importance.RANKINGS]))


def test_trees_without_a_draw_fit_each_vector_once(spark, linear):
    """The same tree and boosting as on the rows, with nominal inputs kept as such."""
    stages = [encode.indexer(CATEGORICAL), encode.assemble([f"{c}_index" for c in CATEGORICAL] + ["people"])]
    df = Pipeline(stages=stages).fit(linear).transform(linear)
    df = df.union(df).select("features", "fare")
    cells = models.one_per_input(df, "features", "fare", "rows")
    assert cells.count() < df.count() / 2 and cells.agg(F.sum("rows")).first()[0] == df.count()
    assert cells.schema["features"].metadata == df.schema["features"].metadata != {}
    for name in ("decision_tree", "gradient_boosting"):
        own, plain = models.regressor(name, "features", "fare"), models.regressor(name, "features", "fare")
        seen = plain.fit(df).setPredictionCol("p1").transform(df)
        both = models.fit_rows(own, df).setPredictionCol("p2").transform(seen)
        assert both.agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0] < 1e-6


def test_clusters_are_fitted_on_distinct_points(spark, monkeypatch):
    df = spark.range(900).selectExpr("id", "CAST(id % 3 AS DOUBLE) * 10 AS x", "CAST(1 AS DOUBLE) AS y")
    seen, spread = [], models.spread
    monkeypatch.setattr(models, "spread", lambda df, *a: seen.append(df.collect()) or spread(df, *a))
    found = models.cluster_points(df, ["x", "y"], k=3)
    assert [r.rows for r in seen[0]] == [300.0] * 3
    assert found.groupBy("prediction").agg(F.count_distinct("x").alias("n"), F.count("*").alias("c")).where(
        "n = 1 AND c = 300").count() == 3


def test_rows_to_fit_lie_in_bounded_partitions(spark):
    df = spark.range(1000).repartition(1)
    held = models.spread(df, 100).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held <= 200 and models.spread(df, 1000) is df
    assert models.spread(df, 100).distinct().count() == 1000


def test_true_elimination_drops_step_by_step(linear):
    ranked = importance.ranked_elimination(linear, NUMERIC, "fare", trees=3, step=1)
    assert [r.feature for r in ranked.collect()][0] == "minutes"


def test_merged_importance_eliminates_and_attributes(spark, linear, monkeypatch):
    """Features are dropped one by one, each fit on those left, and Shapley values are merged, too."""
    from tripengine.plans import queries_models as q

    pipeline, names = encode.importance_inputs(CATEGORICAL, NUMERIC, "fare")
    df = pipeline.fit(linear).transform(linear).select("features", "fare", *names)
    fitted, made = [], importance.forest_importance

    def forest(df, names, label, features="features", trees=50, **params):
        fitted.append((list(names), trees))
        return made(df, names, label, features, 3, **params)

    monkeypatch.setattr(importance, "forest_importance", forest)
    monkeypatch.setattr(q, "importance_frame", lambda *a: nullcontext((df, names)))
    monkeypatch.setattr(q, "LABEL", "fare")
    found = q.imp_06(spark, None).collect()
    left = [set(n) for n, trees in fitted if trees == 30]
    assert [len(n) for n in left] == [4, 3, 2, 1] and all(b < a for a, b in zip(left, left[1:]))
    assert left[-1] == {"minutes"} and {r.feature for r in found} == set(names)
    scores = {r.feature: r.attribution_importance for r in found}
    assert sum(scores.values()) == pytest.approx(1) and max(scores, key=scores.get) == "minutes"
    columns = [*importance.RANKINGS, "attribution_importance"]
    assert found[0].average_importance == pytest.approx(np.mean([found[0][c] for c in columns]), abs=1e-4)


def test_permutation_uses_the_whole_frame_in_small_buckets(linear):
    pipeline, names = encode.importance_inputs([], ["minutes", "people"], "fare")
    df = pipeline.fit(linear).transform(linear)
    line = models.regressor("linear_reg", "features", "fare").fit(df)
    got = importance.permutation_importance(df, line, names, rows_per_bucket=50)
    scores = {r.feature: r.permutation_importance for r in got.collect()}
    assert scores["minutes"] > 0.95


@pytest.mark.parametrize("name", ["decision_tree", "random_forest", "gradient_boosting"])
def test_swaps_looked_up_are_the_swaps_predicted(linear, monkeypatch, name):
    pipeline, names = encode.importance_inputs(CATEGORICAL, NUMERIC, "fare")
    df = pipeline.fit(linear).transform(linear)
    model = models.regressor(name, "features", "fare").fit(df)

    def scores():
        got = importance.permutation_importance(df, model, names, rows_per_bucket=50).collect()
        return [r.permutation_importance for r in got]

    tabled = scores()
    monkeypatch.setattr(importance, "is_forest", lambda model: False)
    assert tabled == pytest.approx(scores()) and sum(v > 0 for v in tabled) > 1


def test_chi_square_matches_the_formula(spark):
    counts = {("a", "x"): 20, ("a", "y"): 30, ("b", "x"): 30, ("b", "y"): 20}
    data = [k for k, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame(data, "k string, label string")
    row = importance.chi_square(df, ["k"], "label").first()
    assert row.statistic == pytest.approx(4.0) and row.degrees_of_freedom == 1
    assert row.p_value == pytest.approx(0.0455, abs=1e-4)


def test_principal_components_keep_the_variance(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(200, 3)) @ np.diag([3.0, 2.0, 1.0])
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    vectors = encode.assemble(["a", "b", "c"]).transform(df)
    model = encode.principal(3, "features").fit(vectors)
    assert sum(model.explainedVariance.toArray()) == pytest.approx(1)
    out = model.transform(vectors).select(vector_to_array("pcaFeatures")).collect()
    got = np.var(np.array([r[0] for r in out]), axis=0, ddof=1)
    assert sorted(got) == pytest.approx(sorted(np.linalg.eigvalsh(np.cov(data.T))))


def test_clusters_of_separate_places(spark):
    data = [(c * 10.0 + d / 100, c * 5.0) for c in range(3) for d in range(20)] + [(None, 1.0)]
    df = spark.createDataFrame(data, "lat double, lon double")
    out = models.cluster_points(df, ["lat", "lon"], k=3)
    assert out.count() == 60
    assert out.groupBy("lon").agg(F.count_distinct("prediction").alias("n")).agg(
        F.max("n")).first()[0] == 1


def test_scoring_row_has_the_model_inputs():
    assert set(schemas.SCORING_ROW.names) == set(schemas.CATEGORICAL + schemas.NUMERIC)
    assert set(schemas.MODEL_COLUMNS) - {schemas.LABEL} == set(schemas.SCORING_ROW.names)


POINTS = {
    "decision_tree": {"maxDepth": [1, 3, 6], "maxBins": [8, 32]},
    "gradient_boosting": {"maxIter": [1, 3, 5], "maxDepth": [2]},
}


@pytest.mark.parametrize("name", list(POINTS))
def test_nested_scores_are_those_of_separate_fits(parts, name, monkeypatch):
    held = models.encoded(*parts, CATEGORICAL, NUMERIC, "fare", "ordinal")
    points, fits, made = models.grid_points(POINTS[name]), [], models.regressor
    want = [models.r2_evaluator("fare").evaluate(
        made(name, held.features, "fare", **p).fit(held.train).transform(held.held_out)) for p in points]
    monkeypatch.setattr(models, "regressor", lambda *a, **k: fits.append(k) or made(*a, **k))
    assert models.nested_scores(name, held, "fare", points) == pytest.approx(want, abs=1e-9)
    assert len(fits) == len(POINTS[name].get("maxBins", [0]))


def test_forest_is_fitted_once_and_deeper_is_better(parts, monkeypatch):
    held = models.encoded(*parts, CATEGORICAL, NUMERIC, "fare", "one_hot")
    fits, made = [], models.regressor
    monkeypatch.setattr(models, "regressor", lambda *a, **k: fits.append(k) or made(*a, **k))
    points = models.grid_points({"maxDepth": [1, 6], "numTrees": [3, 9]})
    scores = models.nested_scores("random_forest", held, "fare", points)
    assert fits == [{"maxDepth": 6, "numTrees": 9}]
    assert max(scores[:2]) < min(scores[2:])


def test_folded_board_and_search_agree_with_generic_folds(spark, parts):
    train, test = parts
    train = train.select("zone", "bin", "minutes", "people", "fare")
    board = models.leaderboard(spark, train, test, CATEGORICAL, NUMERIC, "fare", ["ordinal", "target_mean"],
                               ["linear_reg", "decision_tree"], folds=3)
    for r in board.collect():
        pipeline = models.regression_pipeline(r.model_name, r.encoding, CATEGORICAL, NUMERIC, "fare")
        assert r.validation_r2 == pytest.approx(models.cross_validate(pipeline, train, "fare", 3).avgMetrics[0], abs=1e-5)


def test_many_categories_are_refitted_instead(spark, parts, monkeypatch):
    train = parts[0].select("zone", "bin", "minutes", "people", "fare")
    grid = models.grid_points({"regParam": [0.01, 50.0]})
    short = models.linear_scores(train, CATEGORICAL, NUMERIC, "fare", ["one_hot"], 2, grid)["one_hot"]
    monkeypatch.setattr(models.gram, "describe_columns",
                        lambda *a: (_ for _ in ()).throw(models.gram.TooManyColumns("many")))
    assert models.linear_scores(train, CATEGORICAL, NUMERIC, "fare", ["one_hot"], 2, grid)["one_hot"] == \
        pytest.approx(short, abs=1e-5)
