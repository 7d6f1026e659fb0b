import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripengine.functions.bins import width_bucket_floor
from tripengine.operators import aggregate, profile, quantiles


@pytest.fixture(scope="module")
def mixed(spark):
    """Groups of very different sizes, heavy ties, nulls and a null group."""
    rng = random.Random(1)
    data = [("hot", round(rng.expovariate(0.05), 1)) for _ in range(6000)]
    data += [("flat", 7.0)] * 500 + [("one", 3.5)] + [("pair", 1.0), ("pair", 2.0)]
    data += [(None, float(i)) for i in range(101)] + [("hot", None), ("empty", None)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, v double").repartition(5)


def by_group(df):
    return {r.g: tuple(r)[1:] for r in df.collect()}


def pandas_groups(df):
    pdf = df.toPandas().dropna(subset=["v"])
    pdf["g"] = pdf["g"].where(pdf["g"].notna(), "(null)")
    return pdf.groupby("g")["v"]


@pytest.mark.parametrize("buckets", [4, 4096])
def test_exact_quantiles_equal_interpolation(mixed, monkeypatch, buckets):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    wanted = {"p0": 0.0, "q1": 0.25, "m": 0.5, "p90": 0.9, "p100": 1.0}
    got = by_group(quantiles.exact_quantiles(mixed, "v", wanted, ["g"]))
    groups = pandas_groups(mixed)
    assert set(got) == {"hot", "flat", "one", "pair", None}
    for g, values in got.items():
        want = groups.get_group(g or "(null)").quantile(list(wanted.values()))
        assert values == pytest.approx(tuple(want))


def test_exact_quantiles_without_interpolation_are_values(mixed):
    got = by_group(quantiles.exact_quantiles(mixed, "v", {"m": 0.5}, ["g"], interpolate=False))
    for g, values in got.items():
        ordered = np.sort(pandas_groups(mixed).get_group(g or "(null)"))
        assert values[0] == ordered[int(np.ceil(0.5 * len(ordered))) - 1]


def test_exact_quantiles_overall_and_of_nothing(spark, mixed):
    got = quantiles.exact_quantiles(mixed, "v", {"m": 0.5}).first()[0]
    assert got == pytest.approx(mixed.toPandas()["v"].median())
    empty = spark.createDataFrame([], "v double")
    assert quantiles.exact_quantiles(empty, "v", {"m": 0.5}).first()[0] is None


def test_sketch_is_within_its_rank_error(mixed):
    ordered = np.sort(mixed.toPandas()["v"].dropna())
    got = quantiles.sketch_quantiles(mixed, "v", {"m": 0.5}, rel_err=0.05).first()[0]
    low, high = np.searchsorted(ordered, [got, got], "left")[0], np.searchsorted(ordered, got, "right")
    assert low - 0.05 * len(ordered) <= 0.5 * len(ordered) <= high + 0.05 * len(ordered)


def test_bounds_do_not_move_with_the_partitioning(mixed):
    a = quantiles.iqr_bounds(mixed, "v").first()
    b = quantiles.iqr_bounds(mixed.repartition(7), "v").first()
    assert a == b


def test_cap_lowers_only_the_upper_side_and_keeps_null(spark):
    df = spark.createDataFrame([(v,) for v in [-100.0, 1.0, 2.0, 3.0, 4.0, 100.0, None]], "v double")
    bounds = quantiles.iqr_bounds(df, "v")
    top = bounds.first().upper
    got = [r[0] for r in quantiles.cap_upper(df, "v", bounds).collect()]
    assert got == [-100.0, 1.0, 2.0, 3.0, 4.0, top, None]
    assert rows(quantiles.outliers(df, "v", bounds)) == [(-100.0,), (100.0,)]


def test_box_numbers_by_group(mixed):
    got = {r.g: r for r in quantiles.box_numbers(mixed, "v", ["g"]).collect()}
    values = pandas_groups(mixed).get_group("hot")
    q1, q3 = values.quantile(0.25), values.quantile(0.75)
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    hot = got["hot"]
    assert (hot.whisker_low, hot.whisker_high) == (inside.min(), inside.max())
    assert hot.outliers == len(values) - len(inside) and hot["count"] == len(values)
    assert None in got and got["flat"].outliers == 0


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "k string")
    assert [tuple(r) for r in aggregate.value_counts(df, "k").collect()] == [
        ("c", 2), (None, 1), ("a", 1), ("b", 1)]
    assert [r.k for r in aggregate.counts_in_order(df, "k").collect()] == [None, "a", "b", "c"]
    assert [r.k for r in aggregate.top_k(df, 2, "k").collect()] == ["c", None]


def test_value_counts_of_all_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, None)], "a int, b string")
    got = set(map(tuple, aggregate.value_counts_all(df).collect()))
    assert got == {("a", "1", 2), ("b", "x", 1), ("b", None, 1)}


def test_shares_sum_to_100_and_survive_an_empty_table(spark, mixed):
    total = aggregate.share(mixed, "g").agg(F.sum("percentage")).first()[0]
    assert total == pytest.approx(100)
    empty = mixed.filter("false")
    assert aggregate.share(empty, "g").collect() == []
    assert aggregate.null_percentage(empty, "v").first().percentage is None
    assert aggregate.share_in_set(empty, ["g"], ["x"]).first()[0] is None


def test_share_in_set_and_null_percentage(spark):
    df = spark.createDataFrame([(57, 1), (1, 1), (None, 264), (2, 2)], "p int, d int")
    got = aggregate.share_in_set(df, ["p", "d"], [57, 264]).first()
    assert tuple(got) == (25.0, 25.0)
    assert tuple(aggregate.null_percentage(df, "p").first()) == (4, 1, 25.0)


def test_histogram_partitions_the_rows(mixed):
    found = aggregate.histogram(mixed, "v", 10)
    values = mixed.toPandas()["v"].dropna()
    want, edges = np.histogram(values, bins=10)
    got = {r.bin: (r["count"], r.bin_start, r.bin_end) for r in found.collect()}
    assert {b: c for b, (c, _, _) in got.items()} == dict(enumerate(want))
    assert got[0][1] == pytest.approx(edges[0]) and got[0][2] == pytest.approx(edges[1])


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    found = {r.bin: r["count"] for r in aggregate.histogram(df, "v", 5).collect()}
    assert found == {0: 2, 1: 0, 2: 0, 3: 0, 4: 0}
    assert aggregate.histogram(df.filter("v > 5"), "v", 5).collect() == []


def test_exact_quantiles_cut_large_buckets_again(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 4)
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 7D ELSE pow(id % 977, 2) END AS v", "id % 2 AS g")
    pdf = df.toPandas()
    for by in ([], ["g"]):
        got = quantiles.exact_quantiles(df, "v", {"q": 0.37, "m": 0.5}, by, hit_rows=20).toPandas()
        for _, row in got.iterrows():
            mine = pdf if not by else pdf[pdf["g"] == row["g"]]
            assert (row["q"], row["m"]) == pytest.approx((mine["v"].quantile(0.37), mine["v"].median()))


def test_distributions_have_densities_that_integrate_to_one(mixed):
    sampled = mixed.filter("v < 30")
    found = aggregate.compare_distributions(mixed, sampled, "v", 20)
    areas = found.groupBy("source").agg(
        F.sum(F.col("density") * (F.col("bin_end") - F.col("bin_start"))).alias("area"),
        F.sum("share").alias("share"))
    assert all(r.area == pytest.approx(1) and r.share == pytest.approx(1) for r in areas.collect())


def test_pivot_fills_only_when_asked(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "r int, c string")
    assert rows(aggregate.pivot_counts(df, "r", "c", ["a", "b"], missing=0), "r") == [
        (1, 2, 0), (2, 0, 1)]
    assert rows(aggregate.pivot_counts(df, "r", "c"), "r") == [(1, 2, None), (2, None, 1)]


def test_bucket_mean_with_null_bucket(spark):
    df = spark.createDataFrame([(-3.2, 1.0), (-1.0, 3.0), (7.0, 5.0), (None, 9.0)], "t double, v double")
    got = aggregate.bucket_mean(df, width_bucket_floor("t", 5), "t5", "v", "m")
    assert [tuple(r) for r in got.collect()] == [(None, 9.0), (-5, 2.0), (5, 5.0)]


def test_duplicates_nulls_and_shape(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (1, None), (2, None)], "a int, b string")
    assert profile.duplicate_rows(df).first()[0] == 2
    assert profile.duplicate_rows(df.filter("false")).first()[0] == 0
    assert tuple(profile.null_counts(df).first()) == (0, 3)
    assert tuple(profile.shape(df).first()) == (5, 2)
    assert tuple(profile.distinct_counts(df, "a", "b").first()) == (2, 1)


def test_describe_matches_pandas(mixed):
    got = {r.column: r for r in profile.describe(mixed).collect()}
    want = mixed.toPandas()["v"].describe()
    v = got["v"]
    assert (v["count"], v["mean"], v["stddev"], v["min"], v["max"]) == pytest.approx(
        (want["count"], want["mean"], want["std"], want["min"], want["max"]))
    assert got["g"].min_text == "empty" and got["g"].mean is None
    with pytest.raises(ValueError, match="neither"):
        profile.describe(mixed.withColumn("d", F.current_date()), "d")


def test_moments_match_population_formulas(spark):
    values = [1.0, 2.0, 2.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    x = np.array(values) - np.mean(values)
    got = profile.moments(df, "v").first()
    assert got.skewness == pytest.approx((x**3).mean() / (x**2).mean() ** 1.5)
    assert got.kurtosis == pytest.approx((x**4).mean() / (x**2).mean() ** 2 - 3)


def test_correlations_variances_and_means(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4], "b": [2.0, 1, 4, 3], "k": list("xxyy"),
                        "y": [1.0, 2, 3, 5]})
    df = spark.createDataFrame(pdf)
    got = {r.feature: r.correlation for r in profile.correlations_with(df, ["a", "b"], "y").collect()}
    assert got == pytest.approx({c: pdf[c].corr(pdf["y"]) for c in "ab"})
    matrix = {(r.feature_a, r.feature_b): r.corr
              for r in profile.correlation_matrix(df, ["a", "b", "y"]).collect()}
    assert len(matrix) == 9 and matrix["a", "b"] == matrix["b", "a"]
    assert matrix["a", "y"] == pytest.approx(pdf["a"].corr(pdf["y"]))
    assert [r.feature for r in profile.select_by_variance(df, ["a", "y"], 2.0).collect()] == ["y"]
    means = rows(profile.category_target_means(df, ["k"], "y"))
    assert means == [("k", "x", 1.5), ("k", "y", 4.0)]
    scores = profile.correlation_scores(df, ["a"], ["k"], "y")
    assert {r.feature for r in scores.collect()} == {
        "a", "Mean y for k = x", "Mean y for k = y"}


def test_anova_matches_the_textbook(spark):
    groups = {"a": [6.0, 8, 4, 5, 3, 4], "b": [8.0, 12, 9, 11, 6, 8], "c": [13.0, 9, 11, 8, 7, 12]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, y double")
    row = profile.anova(df, ["k"], "y").first()
    assert (row.df_between, row.df_within) == (2, 15) and row.f_statistic == pytest.approx(9.3, abs=0.05)
    assert row.p_value == pytest.approx((1 + 2 * row.f_statistic / 15) ** -7.5)


def test_normalise(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "feature string, s double")
    assert rows(aggregate.normalise(df, "s")) == [("a", 0.25), ("b", 0.75)]
    zero = df.withColumn("s", F.lit(0.0))
    assert [r.s for r in aggregate.normalise(zero, "s").collect()] == [None, None]
