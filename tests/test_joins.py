import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripengine.operators import joins

HOLIDAY = ("countryOrRegion string, holidayName string, normalizeHolidayName string, "
           "countryRegionCode string, date timestamp")


def holidays(spark):
    day = "2023-12-25 00:00:00"
    return spark.createDataFrame(
        [("United States", "Christmas (Observed)", "Christmas", "US", day),
         ("United States", "Christmas", "Christmas", "US", day),
         ("Canada", "Boxing Day", "Boxing Day", "CA", "2023-12-26 00:00:00")],
        HOLIDAY.replace("date timestamp", "date string"),
    ).withColumn("date", F.to_timestamp("date"))


def test_role_join_keeps_rows_and_drops_the_right_key(spark):
    fact = spark.createDataFrame([(1, 2), (1, 9), (None, 1)], "PU int, DO int")
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "LocationID int, Borough string")
    out = joins.join_role(fact, dim, "LocationID", "PU", {"Borough": "pickup_borough"})
    out = joins.join_role(out, dim, "LocationID", "DO", {"Borough": "dropoff_borough"})
    assert sorted(out.columns) == ["DO", "PU", "dropoff_borough", "pickup_borough"]
    got = out.select("PU", "DO", "pickup_borough", "dropoff_borough")
    assert set(rows(got)) == {(1, 2, "A", "B"), (1, 9, "A", None), (None, 1, None, "A")}


def test_two_holidays_on_a_date_do_not_repeat_trips(spark):
    fact = spark.sql("""SELECT 1 id, date'2023-12-25' pickup_date UNION ALL
                        SELECT 2, date'2023-12-26' UNION ALL SELECT 3, date'2023-12-25'""")
    out = joins.flag_calendar(fact, holidays(spark))
    got = rows(out.select("id", "holidayName", "normalizeHolidayName", "is_holiday"), "id")
    assert got == [(1, "Christmas", "Christmas", 1), (2, "No Holiday", "No Holiday", 0),
                   (3, "Christmas", "Christmas", 1)]


def test_a_missing_weather_day_is_null(spark):
    fact = spark.sql("SELECT date'2023-01-01' pickup_date UNION ALL SELECT date'2023-01-02'")
    daily = spark.sql("SELECT date'2023-01-01' weather_date, 9.1D temp")
    out = joins.join_daily(fact, daily)
    assert out.columns == ["pickup_date", "temp"]
    assert [r.temp for r in out.orderBy("pickup_date").collect()] == [9.1, None]


def test_repeated_keys_do_not_repeat_trips(spark):
    fact = spark.sql("SELECT 1 id, 7 PU, date'2023-01-01' pickup_date")
    dim = spark.createDataFrame([(7, "B", None), (7, "A", "z"), (7, None, "a")],
                                "LocationID int, Borough string, Zone string")
    out = joins.join_role(fact, dim, "LocationID", "PU", {"Borough": "b", "Zone": "z"})
    assert rows(out.select("id", "b", "z")) == [(1, "A", "z")]
    daily = spark.sql("SELECT date'2023-01-01' weather_date, 9.1D temp UNION ALL "
                      "SELECT date'2023-01-01', 8.0D UNION ALL SELECT date'2023-01-01', NULL")
    assert [r.temp for r in joins.join_daily(fact, daily).collect()] == [8.0]


def test_unmatched_keys(spark):
    fact = spark.createDataFrame([(1,), (264,), (264,)], "PULocationID int")
    dim = spark.createDataFrame([(1,)], "LocationID int")
    assert rows(joins.unmatched_keys(fact, dim, "PULocationID", "LocationID")) == [(264,)]


def test_merged_scores_equal_a_chain_of_outer_joins(spark):
    a = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "feature string, a double")
    b = spark.createDataFrame([("y", 0.2), ("z", 0.8)], "feature string, b double")
    chain = a.join(b, "feature", "outer").fillna(0)
    assert rows(joins.merge_scores({"a": a, "b": b})) == rows(chain)


def test_a_repeated_feature_is_an_error(spark):
    a = spark.createDataFrame([("x", 0.5), ("x", 0.5)], "feature string, a double")
    with pytest.raises(Exception, match="repeated feature in a"):
        joins.merge_scores({"a": a}).collect()


def test_merged_counts_keep_one_key(spark):
    p = spark.createDataFrame([("A", 1), (None, 4)], "pickup string, p int")
    d = spark.createDataFrame([("A", 2), ("B", 3), (None, 5)], "dropoff string, d int")
    out = joins.merge_counts(p, d, "pickup", "dropoff", "borough")
    assert set(rows(out)) == {("A", 1, 2), ("B", 0, 3), (None, 4, 5)}


def test_target_means_come_from_the_training_part(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "k string, y double")
    test = spark.createDataFrame([("a", 99.0), ("c", 99.0)], "k string, y double")
    _, coded = joins.encode_with_means(train, [test], ["k"], "y")
    assert rows(coded.select("k", "k_target_mean"), "k") == [("a", 2.0), ("c", None)]


def test_a_hot_key_joins_like_any_other(spark):
    # a third of the rows share one key; with broadcasting off the join shuffles
    fact = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("k"))
    dim = spark.range(40).select(F.col("id").cast("int").alias("key"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.join_role(fact, dim, "key", "k", {"v": "value"})
        counts = {r.k: (r.n, r.v) for r in out.groupBy("k").agg(
            F.count("*").alias("n"), F.max("value").alias("v")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(n for n, _ in counts.values()) == 9000
    assert counts[0][0] >= 3000 and counts[0][1] == 0 and counts[45][1] is None


def test_adaptive_execution_splits_the_hot_key(spark):
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in tight}
    fact = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).cast("int").alias("k"),
        F.col("id"))
    dim = spark.range(500).select(F.col("id").cast("int").alias("key"), F.col("id").alias("v"))
    try:
        for name, value in tight.items():
            spark.conf.set(name, value)
        out = joins.join_role(fact, dim, "key", "k", {"v": "value"}).groupBy("k").agg(
            F.count("*").alias("n"))
        assert out.agg(F.sum("n")).collect()[0][0] == 60_000
        done = joins.join_role(fact, dim, "key", "k", {"v": "value"})
        done.write.format("noop").mode("overwrite").save()
        rows_ = done.collect()
        assert len(rows_) == 60_000
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
