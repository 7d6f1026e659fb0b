import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripengine.functions import bins, calendar, geo, labels, predicates, tails


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def test_duration_is_negative_when_swapped(spark):
    df = spark.sql("SELECT timestamp'2023-01-01 10:00:00' a, timestamp'2023-01-01 10:20:30' b")
    assert df.select(calendar.duration_minutes("a", "b"),
                     calendar.duration_minutes("b", "a")).first() == (20.5, -20.5)


def test_calendar_parts_of_a_sunday_in_the_last_iso_week(spark):
    df = spark.sql("SELECT timestamp'2023-01-01 23:59:59' ts")
    row = calendar.calendar_parts(df, "ts", "p").first()
    assert (row.p_hour, row.p_day_of_week, row.p_month, row.p_week_of_year) == (23, 1, 1, 52)


def test_date_and_time_text(spark):
    df = spark.sql("SELECT timestamp'2023-03-05 04:05:06' ts")
    assert df.select(calendar.date_text("ts"), calendar.time_text("ts")).first() == (
        "2023-03-05", "04:05:06")


def test_year_filter_is_half_open_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("""SELECT timestamp'2022-12-31 23:59:59' ts UNION ALL
                 SELECT timestamp'2023-01-01 00:00:00' UNION ALL
                 SELECT timestamp'2023-12-31 23:59:59' UNION ALL
                 SELECT timestamp'2024-01-01 00:00:00'""").write.parquet(path)
    df = spark.read.parquet(path).filter(calendar.in_year("ts", 2023))
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_two_digits(spark):
    df = column(spark, ["01.parq", "12.parq", "none", None], "string")
    assert [r[0] for r in df.select(calendar.two_digits("c")).collect()] == [1, 12, None, None]


@pytest.mark.parametrize("make,kind,cases", [
    (bins.distance_bin, "double",
     {-1.0: "Short", 2.0: "Short", 2.1: "Medium", 5.0: "Medium", 5.1: "Long"}),
    (bins.temperature_bin, "double",
     {-3.2: "Cold", 10.0: "Cold", 10.1: "Cool", 20.0: "Cool", 30.0: "Warm", 30.1: "Hot"}),
    (bins.time_of_day_bin, "int",
     {0: "Late Night", 5: "Late Night", 6: "Morning", 11: "Morning", 12: "Afternoon",
      17: "Afternoon", 18: "Evening", 23: "Evening"}),
])
def test_bin_edges(spark, make, kind, cases):
    df = column(spark, list(cases), kind)
    assert dict(map(tuple, df.select("c", make("c")).collect())) == cases


def test_null_goes_to_the_last_bin_unless_named(spark):
    df = column(spark, [None], "double")
    assert df.select(bins.temperature_bin("c")).first()[0] == "Hot"
    assert df.select(bins.distance_bin("c")).first()[0] == "Long"
    assert df.select(bins.time_of_day_bin("c")).first()[0] == "Evening"
    assert df.select(bins.season(F.col("c"))).first()[0] == "Fall"
    assert df.select(bins.temperature_bin("c", "Unknown")).first()[0] == "Unknown"


def test_seasons(spark):
    df = column(spark, list(range(1, 13)), "int")
    got = [r[0] for r in df.select(bins.season(F.col("c"))).collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def test_near_airport_counts_null_as_no(spark):
    df = spark.createDataFrame(
        [("Airports", None), (None, "Airports"), (None, None), ("Boro Zone", "EWR")],
        "a string, b string")
    assert [r[0] for r in df.select(bins.near_airport("a", "b")).collect()] == [1, 1, 0, 0]


def test_cut_bins_are_left_closed_and_keep_null(spark):
    df = column(spark, [1.9, 2.0, 20.0, None], "double")
    got = df.select(bins.cut_bin("c", bins.DISTANCE_CUTS, bins.DISTANCE_LABELS)).collect()
    assert [r[0] for r in got] == ["0-2 miles", "2-5 miles", "20+ miles", None]
    with pytest.raises(ValueError):
        bins.cut_bin("c", [1, 2], ["a", "b"])


def test_category_ladder_puts_one_and_null_lowest(spark):
    df = column(spark, [1.0, 1.1, 5.0, 10.0, 20.0, 20.1, None], "double")
    got = [r[0].split(" (")[0] for r in df.select(bins.distance_category("c")).collect()]
    assert got == ["Very Low", "Low", "Average", "High", "High", "Very High", "Very Low"]
    assert df.select(bins.distance_category("c", "km")).first()[0] == "Very Low (<1 km)"


def test_buckets_of_null_keys_and_other_salts(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    one, other = (r[0] for r in df.select(predicates.hash_bucket("x", "y", buckets=1 << 30)).collect())
    assert one != other
    ids = spark.range(4000).withColumn("first", predicates.hash_bucket("id"))
    part = ids.filter("first < 50").withColumn("again", predicates.hash_bucket("id", salt="s"))
    assert part.filter("again >= 50").count() > 700


def test_tails_of_distributions():
    assert tails.chi_square_tail(4.0, 1) == pytest.approx(0.0455003, abs=1e-6)
    assert tails.chi_square_tail(96, 96) == pytest.approx(
        sum(math.exp(i * math.log(48) - 48 - math.lgamma(i + 1)) for i in range(48)), rel=1e-9)
    assert tails.chi_square_tail(0.0, 5) == 1 and tails.chi_square_tail(5000, 3) == pytest.approx(0, abs=1e-12)
    assert tails.f_tail(9.3, 2, 15) == pytest.approx((1 + 2 * 9.3 / 15) ** -7.5, rel=1e-9)
    assert tails.f_tail(1.0, 7, 7) == pytest.approx(0.5) and tails.f_tail(0.0, 2, 3) == 1


def test_width_buckets_floor_below_zero(spark):
    df = column(spark, [-3.2, 0.0, 4.9, 5.0], "double")
    assert [r[0] for r in df.select(bins.width_bucket_floor("c", 5)).collect()] == [-5, 0, 0, 5]


def test_labels_for_codes_and_unknown_codes(spark):
    df = column(spark, ["1", "6", "9", "x", None], "string")
    got = [r[0] for r in df.select(labels.code_label(F.col("c"))).collect()]
    assert got == ["Credit Card", "Voided Trip", None, None, None]


def test_form_codes_agree_with_training_codes(spark):
    # 2023-01-01 is a Sunday
    df = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2023-01-07')) d")
    pairs = df.select(F.dayofweek("d"), labels.form_code(
        F.date_format("d", "EEEE"), labels.FORM_WEEKDAY)).collect()
    assert all(a == b for a, b in pairs)
    other = column(spark, ["Barter", None, "Night", "Morning"], "string")
    assert [r[0] for r in other.select(labels.form_code(F.col("c"), labels.FORM_PAYMENT))
            .collect()] == [0, 0, 0, 0]
    assert [r[0] for r in other.select(labels.form_term(F.col("c"))).collect()] == [
        "Barter", None, "Late Night", "Morning"]


def distance(spark, *point):
    df = spark.createDataFrame([point], "a double, b double, c double, d double")
    return df.select(geo.haversine_km("a", "b", "c", "d")).first()[0]


def test_haversine(spark):
    there, back = distance(spark, 40.7, -74.0, 40.8, -73.9), distance(
        spark, 40.8, -73.9, 40.7, -74.0)
    assert there == pytest.approx(back) and there == pytest.approx(13.94, abs=0.02)
    assert distance(spark, 40.7, -74.0, 40.7, -74.0) == 0.0
    # antipodes: half the circumference; a missing coordinate: 0, not half the globe
    assert distance(spark, 0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * 6371.0)
    assert distance(spark, 40.7, -74.0, None, -73.9) == 0.0


def test_distance_needs_no_python_worker(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "a double, b double, c double, d double")
    plan = df.select(geo.haversine_km("a", "b", "c", "d"))._jdf.queryExecution()
    assert "Python" not in plan.executedPlan().toString()


def test_box(spark):
    df = spark.createDataFrame(
        [(-74.0, 40.7), (-74.03, 40.63), (-74.04, 40.7), (-73.7, 40.7), (None, 40.7)],
        "lon double, lat double")
    assert df.filter(geo.inside_box([("lon", "lat")])).count() == 2


def test_row_tests_drop_nulls(spark):
    df = column(spark, [None, 0, 1, 6, 7], "int")
    assert df.filter(predicates.positive("c")).count() == 3
    assert df.filter(predicates.above_up_to("c", 0, 6)).count() == 2
    assert df.filter(predicates.in_none(["c"], [1, 6])).count() == 2
    assert df.filter(predicates.any_null(["c"])).count() == 1


def test_hash_buckets_depend_on_the_key_alone(spark):
    df = spark.range(20_000).select(F.col("id"), predicates.hash_bucket("id").alias("b"))
    first = dict(map(tuple, df.collect()))
    assert first == dict(map(tuple, df.repartition(7).collect()))
    share = sum(b < 10 for b in first.values()) / len(first)
    assert 0.08 < share < 0.12 and set(first.values()) == set(range(100))


def test_helper_rows(spark):
    assert rows(column(spark, [2, 1], "int")) == [(1,), (2,)]
