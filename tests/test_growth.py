import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tripengine.operators import encode, growth, models

CATEGORICAL, NUMERIC = ["k", "m"], ["x", "z"]


@pytest.fixture(scope="module")
def raw(spark):
    """Few values a column, so that bins are the values themselves."""
    df = spark.range(3000).selectExpr(
        "id", "CONCAT('k', CAST(id * id AS INT) % 7) AS k", "ELT(1 + id % 5 % 3, 'u', 'v', 'w') AS m",
        "CAST(id * 31 % 23 AS DOUBLE) AS x", "CAST(id * 7 % 13 AS DOUBLE) AS z")
    return df.withColumn("y", F.expr("x * z / 5 + IF(m = 'u', x, -z) + ASCII(SUBSTR(k, 2)) + rand(2)")).cache()


@pytest.fixture(scope="module")
def encoded(raw):
    def made(encoding):
        if encoding == "nominal":
            pipeline, _ = encode.importance_inputs(CATEGORICAL, NUMERIC, "y")
            return pipeline.fit(raw).transform(raw).select("features", "y")
        stages, features = encode.encoding_stages(encoding, CATEGORICAL, NUMERIC, "y")
        return Pipeline(stages=stages).fit(raw).transform(raw).select(F.col(features).alias("features"), "y")

    return {e: made(e).repartition(3).cache() for e in ("one_hot", "ordinal", "target_mean", "nominal")}


KINDS = {"decision_tree": {"maxDepth": 6}, "gradient_boosting": {"maxIter": 4, "maxDepth": 3},
         "random_forest": {"bootstrap": False, "featureSubsetStrategy": "all", "numTrees": 2}}


@pytest.mark.parametrize("encoding", ["one_hot", "ordinal", "target_mean", "nominal"])
@pytest.mark.parametrize("name", list(KINDS))
def test_grown_trees_are_those_of_spark(encoded, name, encoding):
    df, own = encoded[encoding], models.regressor(name, "features", "y", **KINDS[name])
    assert growth.can_grow(own, df)
    want, got = own.fit(df), growth.fit(own, df)
    seen = got.setPredictionCol("p2").transform(want.setPredictionCol("p1").transform(df))
    assert seen.agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0] < 1e-6
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-6)
    assert got.extractParamMap().keys() == want.extractParamMap().keys() and type(got) is type(want)


def test_large_tables_are_grown_in_blocks(encoded, monkeypatch):
    """Neither grouped nor handed to Spark's own trees, which read every feature of every row."""
    df, calls = encoded["one_hot"], []
    monkeypatch.setattr(models, "GROWN_ROWS", 1000)
    monkeypatch.setattr(models, "one_per_input", None)
    made = growth.fit
    monkeypatch.setattr(growth, "fit", lambda *a: calls.append(1) or made(*a))
    stored, blocks = [], growth.blocks
    monkeypatch.setattr(growth, "blocks", lambda *a: stored.append(1) or blocks(*a))
    for name in ("decision_tree", "random_forest", "gradient_boosting"):
        params = {"maxIter": 2} if name == "gradient_boosting" else {}
        fitted = models.fit_rows(models.regressor(name, "features", "y", **params), df)
        assert models.metrics(fitted.transform(df), "y").first().r2 > 0.6
    assert len(calls) == 3 and len(stored) <= 1  # the blocks are made once for all models of a table


def test_a_forest_draws_rows_and_features(encoded):
    df = encoded["ordinal"]
    forest = growth.fit(models.regressor("random_forest", "features", "y", numTrees=12), df)
    again = growth.fit(models.regressor("random_forest", "features", "y", numTrees=12), df)
    one, other = ([t.toDebugString.split("\n", 1)[1] for t in f.trees] for f in (forest, again))
    assert forest.getNumTrees == 12 and len(set(one)) > 6 and one == other
    assert models.metrics(forest.transform(df), "y").first().r2 > 0.8


def test_sums_meet_in_tasks_or_on_the_driver(encoded, monkeypatch):
    df, own = encoded["nominal"], models.regressor("random_forest", "features", "y", numTrees=3)
    here = growth.fit(own, df)
    monkeypatch.setattr(growth, "DRIVER_BYTES", 0)
    there = growth.fit(own, df)
    seen = there.setPredictionCol("p2").transform(here.setPredictionCol("p1").transform(df))
    assert seen.agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0] < 1e-9


def test_quantiles_part_many_values(spark):
    df = encode.assemble(["x", "c"]).transform(spark.range(5000).selectExpr(
        "CAST(id AS DOUBLE) AS x", "1D AS c", "CAST(IF(id < 2500, 0, 10) AS DOUBLE) AS y"))
    tree = growth.fit(models.regressor("decision_tree", "features", "y", maxDepth=3), df)
    assert models.metrics(tree.transform(df), "y").first().r2 > 0.95
    assert tree.featureImportances.toArray().tolist() == [1.0, 0.0]


def test_a_missing_label_is_left_to_spark(spark, encoded):
    df = encoded["ordinal"].withColumn("y", F.when(F.col("y") > 60, F.col("y")))
    assert growth.fit(models.regressor("decision_tree", "features", "y"), df) is None


def test_few_distinct_inputs_are_still_grouped(encoded, monkeypatch):
    df = encoded["ordinal"].select("features", "y")
    assert growth.fit(models.regressor("decision_tree", "features", "y"), df, 10_000) is None
    assert growth.fit(models.regressor("decision_tree", "features", "y"), df, 100) is not None
    monkeypatch.setattr(growth, "fit", None)
    models.fit_rows(models.regressor("decision_tree", "features", "y"), df)  # a small table stays with Spark's trees


def test_grown_boosting_is_cut_to_its_first_iterations(encoded, monkeypatch):
    df = encoded["ordinal"]
    parts, points = models.Encoded(None, "features", df, df), models.grid_points({"maxIter": [1, 3], "maxDepth": [2]})
    want = models.nested_scores("gradient_boosting", parts, "y", points)
    monkeypatch.setattr(models, "GROWN_ROWS", 1000)
    assert models.nested_scores("gradient_boosting", parts, "y", points) == pytest.approx(want, abs=1e-6)


def test_rows_are_drawn_as_often_as_by_poisson():
    share = [(growth.POISSON == k).mean() for k in range(4)]
    assert share == pytest.approx([0.36788, 0.36788, 0.18394, 0.06131], abs=1e-4)
    assert growth.POISSON.mean() == pytest.approx(1, abs=1e-3)
