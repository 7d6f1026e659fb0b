import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripengine import schemas
from tripengine.operators.clean import conform
from tripengine.sources import files, zones

TRIP = ("2023-01-05 08:00:00", "2023-01-05 08:10:00", 1, 2, 1.0, 3.5, "1", 12.5, 0.0, 1.0, 13.5)


def month_file(spark, path, passenger_type, trip=TRIP):
    raw = spark.createDataFrame([trip], ", ".join(
        f"{n} {t}" for n, t in zip(schemas.TRIP_RAW.names, [
            "string", "string", "int", "int", "double", "double", "string", "double",
            "double", "double", "double"])))
    raw.withColumns({
        "tpep_pickup_datetime": F.to_timestamp("tpep_pickup_datetime"),
        "tpep_dropoff_datetime": F.to_timestamp("tpep_dropoff_datetime"),
        "passenger_count": F.col("passenger_count").cast(passenger_type),
        "vendor_note": F.lit("not read"),
    }).write.parquet(path)


def test_months_with_drifting_types_are_united(spark, tmp_path):
    paths = files.monthly_paths(str(tmp_path), "trips_2023_{:02d}.parquet", [1, 2])
    month_file(spark, paths[0], "int")
    month_file(spark, paths[1], "double")
    trips = files.read_monthly(spark, paths)
    assert trips.schema.names == [*schemas.TRIP_RAW.names, "month"]
    assert dict(trips.dtypes)["passenger_count"] == "int"
    assert [r.month for r in trips.orderBy("month").collect()] == ["01", "02"]
    assert "vendor_note" not in trips._jdf.queryExecution().executedPlan().toString()


def test_zone_lookup_reads_the_marker_as_null(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n264,N/A,N/A,N/A\n")
    assert rows(files.read_zone_lookup(spark, str(path)), "LocationID") == [
        (1, "EWR", "Newark Airport", "EWR"), (264, None, None, None)]


def test_weather_document(spark, tmp_path):
    path = tmp_path / "weather.json"
    path.write_text(json.dumps({"address": "x", "days": [
        {"datetime": "2023-01-01", "temp": 9.1, "humidity": 3}, {"datetime": "2023-01-02", "temp": None},
    ]}, indent=1))
    got = files.read_weather(spark, str(path))
    assert got.dtypes == [("weather_date", "date"), ("temp", "double")]
    assert [(str(r[0]), r[1]) for r in got.collect()] == [("2023-01-01", 9.1), ("2023-01-02", None)]


def test_holidays_include_the_whole_last_day(spark):
    df = spark.createDataFrame(
        [("A", "2022-12-31 00:00:00"), ("B", "2023-01-01 00:00:00"), ("C", "2023-12-31 13:00:00"),
         ("D", "2024-01-01 00:00:00")], "holidayName string, date string",
    ).withColumns({"date": F.to_timestamp("date"), "isPaidTimeOff": F.lit(None).cast("boolean")})
    got = files.read_holidays(df, "2023-01-01", "2023-12-31")
    assert got.columns == ["holidayName", "date"]
    assert [r[0] for r in rows(got, "holidayName")] == ["B", "C"]


def test_stage_round_trip_and_schema_change(spark, tmp_path):
    path = str(tmp_path / "stage")
    files.write_stage(spark.range(3), path, "parquet")
    assert files.read_stage(spark, path, "parquet").count() == 3
    other = spark.createDataFrame([("x", 1)], "name string, n int")
    files.write_stage(other, path, "parquet", replace_schema=True)
    assert rows(files.read_stage(spark, path, "parquet")) == [("x", 1)]
    files.write_stage(other, path, partition_by=["name"])
    assert files.read_stage(spark, path).count() == 1
    assert files.table_format(spark) == "parquet"


def test_literal_tables_have_declared_schemas(spark):
    schema = schemas.table(code=schemas.INT, label=schemas.TEXT)
    assert files.lookup_table(spark, {1: "a"}, schema).schema == schema
    assert files.result_table(spark, [(1, "a")], schema).schema == schema
    form = (1, 1, 20.37, 2, 8, 10, "Manhattan", "Brooklyn", 0, "Medium", "Morning", 0)
    one = files.result_table(spark, [form], schemas.SCORING_ROW)
    assert conform(one, schemas.SCORING_ROW).first() == form


def vertices(spark, data):
    return spark.createDataFrame(
        data, "LocationID int, ring int, seq int, x double, y double")


RECTANGLE = [(1, 0, 0, 0.0, 0.0), (1, 0, 1, 2.0, 0.0), (1, 0, 2, 2.0, 4.0), (1, 0, 3, 0.0, 4.0)]


@pytest.mark.parametrize("chunk", [1, 2, 3, 10_000])
def test_rectangle_centroid_whatever_the_chunk(spark, chunk):
    got = zones.polygon_centroids(vertices(spark, RECTANGLE), chunk=chunk).first()
    assert (got.longitude, got.latitude) == pytest.approx((1.0, 2.0))


@pytest.mark.parametrize("chunk", [2, 10_000])
def test_closed_rings_and_holes(spark, chunk):
    closed = [*RECTANGLE, (1, 0, 4, 0.0, 0.0)]
    # a hole in the upper half, wound the other way round
    hole = [(1, 1, 0, 0.5, 2.5), (1, 1, 1, 0.5, 3.5), (1, 1, 2, 1.5, 3.5), (1, 1, 3, 1.5, 2.5)]
    rings = vertices(spark, closed + hole).withColumn("hole", F.col("ring") == 1)
    got = zones.polygon_centroids(rings, chunk=chunk).first()
    assert got.longitude == pytest.approx(1.0)
    assert got.latitude == pytest.approx((8 * 2.0 - 1 * 3.0) / 7)


@pytest.mark.parametrize("turn", [1, -1])
def test_centroids_do_not_depend_on_winding(spark, turn):
    square = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    hole = [(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)][::turn]
    two = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
    far = [(10, 0), (12, 0), (12, 2), (10, 2), (10, 0)][::turn]

    def ring(points):
        return "(" + ", ".join(f"{x} {y}" for x, y in points) + ")"

    table = spark.createDataFrame(
        [(1, f"POLYGON ({ring(square)}, {ring(hole)})"),
         (2, f"MULTIPOLYGON (({ring(two)}),({ring(far)}))"),
         (3, f"MULTIPOLYGON (({ring(square)},{ring(hole)}), ({ring(far)}))")],
        "LocationID int, geometry string")
    got = {r.LocationID: (r.longitude, r.latitude)
           for r in zones.polygon_centroids(zones.ring_vertices(table)).collect()}
    assert got[1] == pytest.approx((35 / 6, 35 / 6)) and got[2] == pytest.approx((6, 1))
    assert got[3] == pytest.approx(((75 * 35 / 6 + 4 * 11) / 79, (75 * 35 / 6 + 4) / 79))


def test_a_line_has_no_centroid(spark):
    flat = [(2, 0, 0, 0.0, 0.0), (2, 0, 1, 1.0, 1.0)]
    got = zones.polygon_centroids(vertices(spark, flat)).first()
    assert got.latitude is None and got.longitude is None


def test_vertices_from_geometry_text(spark):
    table = spark.createDataFrame(
        [("Z", 1, "POLYGON ((0 0, 2 0, 2 4, 0 4, 0 0))"),
         ("M", 2, "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((4 0, 6 0, 6 2, 4 2, 4 0)))"),
         ("N", 3, None)],
        "zone string, LocationID int, geometry string")
    points = zones.ring_vertices(table)
    assert points.filter("LocationID = 2").select("ring").distinct().count() == 2
    centroids = zones.polygon_centroids(points)
    got = zones.zone_attributes(table.join(centroids, "LocationID", "left"))
    assert got.columns == ["zone", "LocationID", "latitude", "longitude"]
    assert {r.zone: (r.longitude, r.latitude) for r in got.collect()} == {
        "Z": (1.0, 2.0), "M": (3.0, 1.0), "N": (None, None)}
