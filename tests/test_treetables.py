import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tripengine.operators import treetables as tt

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).selectExpr(
        "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 3 AS DOUBLE) AS b", "rand(1) AS c", "CAST(id % 5 AS DOUBLE) AS d")
    df = df.withColumn("y", F.expr("a * b + 3 * c * c + IF(d > 2, a, -b) + rand(2)"))
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).cache()


def fits(kind, df, features="features", **params):
    cls = {"tree": DecisionTreeRegressor, "forest": RandomForestRegressor, "boosting": GBTRegressor}[kind]
    extra = {"forest": {"numTrees": 4, "seed": 3}, "boosting": {"maxIter": 4, "seed": 3}}.get(kind, {})
    return cls(featuresCol=features, labelCol="y", **{**extra, **params}).fit(df)


def known(nodes, x, given, at=0):
    """A tree's expected prediction where only the features in ``given`` are known."""
    node = nodes[at]
    if node.left < 0:
        return node.prediction
    if node.feature in given:
        v = x[node.feature]
        left = v <= node.bounds[0] if node.categories < 0 else v in node.bounds
        return known(nodes, x, given, node.left if left else node.right)
    return sum(nodes[c].weight / node.weight * known(nodes, x, given, c) for c in (node.left, node.right))


def brute(forest, x):
    """Shapley values over all subsets of the features."""
    k = len(x)

    def value(s):
        return sum(w * known(t, x, s) for t, w in zip(forest.trees, forest.weights, strict=True))

    return [sum(math.factorial(n) * math.factorial(k - n - 1) / math.factorial(k) * (value({*s, i}) - value(set(s)))
                for n in range(k) for s in itertools.combinations([j for j in range(k) if j != i], n))
            for i in range(k)]


@pytest.mark.parametrize("kind", ["tree", "forest", "boosting"])
def test_attributions_against_all_subsets(rows, kind):
    model = fits(kind, rows, maxDepth=4)
    forest = tt.forest_of(model)
    got = tt.attributions(model.transform(rows), model).select("a", "b", "c", "d", "prediction", "contributions")
    got = got.limit(25).collect()
    base = tt.expected_value(forest)
    for r in got:
        assert np.allclose(r.contributions, brute(forest, r[:4]))
        assert math.isclose(sum(r.contributions), r.prediction - base, abs_tol=1e-9)


def test_categorical_splits(rows):
    indexed = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=8).fit(rows).transform(rows)
    model = fits("forest", indexed, "indexed", maxDepth=4)
    forest = tt.forest_of(model)
    assert any(n.categories > 0 for t in forest.trees for n in t)
    got = tt.attributions(model.transform(indexed).withColumn("x", vector_to_array("indexed")), model, "indexed")
    for r in got.limit(15).collect():
        assert np.allclose(r.contributions, brute(forest, r.x))


def test_deep_trees_sum_up(rows):
    model = fits("tree", rows, maxDepth=12)
    base = tt.expected_value(tt.forest_of(model))
    gap = F.abs(F.aggregate("contributions", F.lit(0.0), lambda s, x: s + x) + base - F.col("prediction"))
    assert tt.attributions(model.transform(rows), model).agg(F.max(gap)).first()[0] < 1e-9


def test_contributions_are_looked_up_in_few_small_tables(rows):
    forest = tt.forest_of(fits("forest", rows, maxDepth=5))
    of, paths = tt.Attribution(forest, 4), tt.leaf_paths(forest)
    assert not of.long and len(of.tables) < len(paths) / 4
    assert all(sums.shape[1] <= tt.TABLE_CELLS for _, sums in of.tables)
    x = np.random.default_rng(4).uniform(-1, 8, (60, 4))
    x[:4, 0] = x[0, :] = [-np.inf, np.inf, 0.0, 3.0]
    tabled = of.of(x)
    cells, tt.TABLE_CELLS = tt.TABLE_CELLS, 1  # every path by itself, row by row
    try:
        alone = tt.Attribution(forest, 4)
    finally:
        tt.TABLE_CELLS = cells
    assert not alone.tables and np.allclose(tabled, alone.of(x))


def test_mean_attributions_count_equal_rows(rows):
    model = fits("forest", rows, maxDepth=3)
    each = tt.attributions(rows, model)
    want = each.agg(*[F.avg(F.abs(F.get("contributions", F.lit(i)))).alias(n) for i, n in enumerate(NAMES)]).first()
    got = tt.mean_attributions(rows.union(rows), model, NAMES).collect()
    assert {r.feature: round(r.mean_attribution, 9) for r in got} == {n: round(want[n], 9) for n in NAMES}
    assert [r.mean_attribution for r in got] == sorted((r.mean_attribution for r in got), reverse=True)
    nothing = tt.mean_attributions(rows.limit(0), model, NAMES).collect()
    assert [r.mean_attribution for r in nothing] in ([], [None] * 4)


def test_a_single_leaf_has_no_contributions(rows):
    model = fits("tree", rows.withColumn("y", F.lit(2.0)))
    assert tt.attributions(rows, model).agg(F.max(F.array_max("contributions"))).first()[0] == 0
    assert tt.expected_value(tt.forest_of(model)) == 2.0


def both(df, first, second):
    """The largest difference between two models' predictions."""
    seen = first.setPredictionCol("p1").transform(df)
    return second.setPredictionCol("p2").transform(seen).agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0]


@pytest.mark.parametrize("depth", [0, 1, 3, 6])
def test_cut_tree_is_the_shallow_tree(rows, depth):
    deep = fits("tree", rows, maxDepth=6)
    cut = tt.truncated(deep, depth)
    assert cut.depth <= depth and cut.getOrDefault("maxDepth") == depth
    assert both(rows, cut, fits("tree", rows, maxDepth=depth)) < 1e-9


def test_first_iterations_are_the_short_boosting(rows):
    long = fits("boosting", rows, maxIter=6, maxDepth=3)
    cut = tt.truncated(long, trees=2)
    assert cut.getNumTrees == 2
    assert both(rows, cut, fits("boosting", rows, maxIter=2, maxDepth=3)) < 1e-9


def test_cut_forest(rows):
    forest = fits("forest", rows, maxDepth=5)
    cut = tt.truncated(forest, depth=2, trees=3)
    assert cut.getNumTrees == 3 and max(t.depth for t in cut.trees) <= 2
    own = [t for t in tt.forest_of(forest).trees[:3]]
    assert [t[0].prediction for t in own] == [t[0].prediction for t in tt.forest_of(cut).trees]
    assert both(rows, tt.truncated(forest), fits("forest", rows, maxDepth=5)) < 1e-9
