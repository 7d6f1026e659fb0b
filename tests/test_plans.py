import ast
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tripengine import schemas
from tripengine.operators.profile import null_counts
from tripengine.plans import cleaned
from tripengine.plans import tripview as tv
from tripengine.plans.queries_columns import cleaned_trips, stored_features

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables")


def raw(spark, *trips):
    names = schemas.TRIP_RAW.names
    df = spark.createDataFrame(
        [(a, b, pu, do, n, d, "1", fare, 0.0, 1.0, fare + 1.0) for a, b, pu, do, n, d, fare in trips],
        ", ".join(f"{c} {t}" for c, t in zip(names, [
            "string", "string", "int", "int", "int", "double", "string", "double", "double",
            "double", "double"])))
    return df.withColumns({c: F.to_timestamp(c) for c in names[:2]})


DAY = ("2023-01-01 08:00:00", "2023-01-01 08:30:00")


def test_cleaning_drops_copies_nulls_and_other_years(spark):
    trips = raw(
        spark,
        (*DAY, 1, 2, 1, 3.0, 1234.57), (*DAY, 1, 2, 1, 3.0, 1234.57),
        (*DAY, 1, 2, None, 3.0, 10.0),
        ("2022-12-31 23:50:00", "2023-01-01 00:10:00", 1, 2, 1, 3.0, 10.0),
    )
    out = cleaned.clean(trips, 2023)
    assert out.count() == 1 and len(out.columns) == 24
    row = out.first()
    assert row.fare_amount == 1234.57 and row.trip_duration == 30.0
    assert (row.pickup_date, row.pickup_time, row.pickup_day_of_week) == ("2023-01-01", "08:00:00", 1)


def dims(spark):
    zones = spark.createDataFrame(
        [(1, "EWR", "Newark", "Airports"), (2, "Queens", "Astoria", "Boro Zone")], schemas.ZONE)
    places = spark.createDataFrame([(1, 40.69, -74.0)], schemas.CENTROID)
    day = "2023-01-01 00:00:00"
    holidays = spark.createDataFrame(
        [("United States", n, "New Year", None, "US", None) for n in ("New Year", "New Year (Observed)")],
        schemas.HOLIDAY).withColumn("date", F.to_timestamp(F.lit(day)))
    weather = spark.sql("SELECT date'2023-01-01' weather_date, 9.1D temp")
    return zones, places, holidays, weather


def test_enriching_keeps_the_row_count_and_yields_39_columns(spark):
    trips = cleaned.clean(raw(
        spark, (*DAY, 1, 2, 1, 3.0, 10.0), (*DAY, 1, 1, 2, 3.0, 10.0), (*DAY, 1, 264, 2, 3.0, 10.0),
        (*DAY, 9, 1, 2, 3.0, 11.0)))
    out = cleaned.enrich(trips, *dims(spark))
    assert out.count() == 3 and len(out.columns) == 39
    by = {(r.PULocationID, r.DOLocationID): r for r in out.collect()}
    assert by[1, 2].distance_km == 0 and by[1, 2].dropoff_latitude is None
    assert by[1, 1].distance_km == 0 and by[9, 1].pickup_borough is None
    assert by[1, 2].holidayName == "New Year" and by[1, 2].is_holiday == 1
    assert by[1, 2].temp == 9.1 and by[1, 2].pickup_service_zone == "Airports"


@needs_tables
def test_trip_view_joins_only_what_is_asked_for(spark):
    plan = tv.trips(spark, SF, "fare_amount")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    df = tv.trips(spark, SF, "fare_amount", "PULocationID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "p_size" not in plan and "s_nationkey" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


@needs_tables
def test_trip_view_keeps_every_line(spark):
    lines = tv.read(spark, SF, "lineitem").count()
    trips = tv.trips(spark, SF, *tv.TRIP_COLUMNS)
    assert trips.count() == lines
    assert null_counts(trips).first() == (0,) * len(tv.TRIP_COLUMNS)


@needs_tables
def test_finished_tables(spark):
    assert len(cleaned_trips(spark, SF).columns) == 39
    features = stored_features(spark, SF)
    assert features.columns == schemas.FEATURE_COLUMNS
    model = cleaned.model_table(features)
    assert model.columns == schemas.MODEL_COLUMNS
    assert dict(model.dtypes)["payment_type"] == "int"
    domains = {
        "distance_bin": {"Short", "Medium", "Long"},
        "temp_bin": {"Cold", "Cool", "Warm", "Hot"},
        "time_of_day_bin": {"Late Night", "Morning", "Afternoon", "Evening"},
        "season": {"Winter", "Spring", "Summer", "Fall"},
    }
    found = features.agg(*[F.collect_set(c).alias(c) for c in domains]).first()
    assert all(set(found[c]) <= d for c, d in domains.items())


@needs_tables
def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["pickup_borough", "trips", "average_fare", "total_fare", "median_fare"]
    assert df.count() == 5


def test_every_oracle_has_a_query():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and contract.FLAGSHIP in oracles
    assert len(oracles) > 100


@needs_tables
@pytest.mark.parametrize(("name", "unread"), [
    ("agg_18_count_by_borough", {"orders", "customer"}),
    *((name, {"supplier"}) for name in (
        "fares_by_pickup_borough", "agg_17_count_of_ids_by_borough", "agg_20_mean_and_median_by_key",
        "agg_21_median_by_two_keys", "join_08_counts_per_zone", "top_01_pickup_zones")),
])
def test_queries_read_only_the_tables_they_need(spark, monkeypatch, name, unread):
    read, plain = set(), tv.read

    def noted(session, folder, table):
        read.add(table)
        return plain(session, folder, table)

    monkeypatch.setattr(tv, "read", noted)
    contract.queries()[name](spark, SF)
    assert "lineitem" in read and not read & unread


@needs_tables
def test_a_literal_lookup_does_not_shuffle_the_trips(spark):
    df = contract.queries()["src_08_literal_lookup"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Join LeftOuter")
    assert "Aggregate" in above and "Aggregate" in below


def test_the_stored_stage_of_the_features_has_what_they_read_and_no_more(spark):
    from tripengine.plans.cleaned import FEATURE_SOURCES
    from tripengine.plans.queries_columns import stored_features

    stage = spark.read.parquet(stored_features(spark, SF).inputFiles()[0].rpartition("/")[0])
    assert stage.columns == FEATURE_SOURCES


def sources():
    """The library without the text operators, which have tests of their own."""
    found = sorted((ROOT / "tripengine").rglob("*.py"))
    return [p for p in found if "llm" not in p.relative_to(ROOT).parts]


def test_the_package_has_no_hints_and_no_python_row_functions():
    banned = {"broadcast", "crossJoin", "localCheckpoint", "udf", "pandas_udf", "toPandas", "coalesce_"}
    for path in sources():
        for node in ast.walk(ast.parse(path.read_text())):
            name = getattr(node, "attr", getattr(node, "id", None))
            assert name not in banned, f"{path}: {name}"


def test_no_unused_imports():
    for path in sources():
        tree, used, bound = ast.parse(path.read_text()), set(), set()
        for node in ast.walk(tree):
            if isinstance(node, (ast.Import, ast.ImportFrom)):
                bound |= {(a.asname or a.name).split(".")[0] for a in node.names}
            elif isinstance(node, ast.Name):
                used.add(node.id)
        assert bound - used - {"annotations"} == set(), path
