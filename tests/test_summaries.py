import pytest
from pyspark.sql import functions as F

from tripengine.operators import summaries
from tripengine.operators.profile import describe, moments


@pytest.fixture(scope="module")
def months(spark):
    return spark.range(30_000).selectExpr(
        "id % 7 AS month", "CASE WHEN id % 11 > 0 THEN pmod(hash(id), 100000) / 7.0 + 1e5 * (id % 7) END AS v",
        "CAST(3 AS INT) AS same", "CASE WHEN id % 7 = 2 THEN NULL ELSE id % 5 END AS w",
        "CASE WHEN id % 13 > 0 THEN concat('k', id % 9) END AS k")


def stored(df, folder, parts=(range(7),)):
    for own in parts:
        summaries.store_parts(df.where(F.col("month").isin(*own)), folder, "month", ["v", "same", "w"], ["k"])
    return folder


def test_merged_equals_the_full_pass(spark, months, tmp_path):
    folder = stored(months, str(tmp_path), ([0, 1, 2], [3], [4, 5, 6]))
    got = {r.column: r for r in summaries.merged_numbers(spark, folder).collect()}
    shape = {r.column: r for r in moments(months, "v", "w").collect()}
    for r in describe(months, "v", "w", "same").collect():
        own = got[r.column]
        assert (own.rows, own["values"], own.min, own.max) == (30_000, r["count"], r.min, r.max)
        assert own.mean == pytest.approx(r.mean, rel=1e-12)
        assert own.stddev == pytest.approx(r.stddev, rel=1e-9, abs=1e-12)
        if r.column in shape:
            assert own.skewness == pytest.approx(shape[r.column].skewness, abs=1e-8)
            assert own.kurtosis == pytest.approx(shape[r.column].kurtosis, abs=1e-8)
    assert got["same"].skewness is None and got["same"].kurtosis is None
    want = {(r.k, r["count"]) for r in months.groupBy("k").count().collect()}
    assert {(r.value, r["count"]) for r in summaries.merged_codes(spark, folder).collect()} == want


def test_sketched_figures_are_near(spark, months, tmp_path):
    folder = stored(months, str(tmp_path), ([0, 1, 2, 3], [4, 5, 6]))
    own = summaries.merged_numbers(spark, folder, [0.1, 0.5, 0.9]).where("column = 'v'").first()
    for q, at in zip((0.1, 0.5, 0.9), own.quantiles, strict=True):
        share = months.where("v IS NOT NULL").agg(F.avg((F.col("v") <= at).cast("double"))).first()[0]
        assert abs(share - q) < 0.02
    assert own.distinct == pytest.approx(months.select("v").distinct().count() - 1, rel=0.05)


def test_a_new_part_reads_and_replaces_only_itself(spark, months, tmp_path):
    folder = stored(months, str(tmp_path))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    stored(months.withColumn("v", F.lit(1.0)), folder, ([3],))
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert {p for p in before if "month=3" not in str(p)} <= set(after)
    assert all(after[p] == t for p, t in before.items() if "month=3" not in str(p))
    own = {r.column: r for r in summaries.merged_numbers(spark, folder).collect()}["v"]
    assert own.rows == 30_000 and own.min == 1.0
    plan = summaries.merged_numbers(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and plan.count("Scan parquet") == 1


def test_columns_without_values(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, None)], "month int, v double")
    summaries.store_parts(df, str(tmp_path), "month", ["v"])
    [r] = summaries.merged_numbers(spark, str(tmp_path)).collect()
    assert (r.rows, r["values"], r.mean, r.stddev, r.quantiles, r.distinct) == (2, 0, None, None, None, 0)
