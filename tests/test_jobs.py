import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripengine import schemas
from tripengine.operators.models import load_model
from tripengine.plans import cleaned, jobs
from tripengine.session import shared_folder
from tripengine.sources.files import monthly_paths, result_table

def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


BOROUGHS = ["Manhattan", "Brooklyn", "Queens"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Two months of trips with drifting types, and the small tables beside them."""
    folder = tmp_path_factory.mktemp("inputs")
    rng = random.Random(5)
    paths = monthly_paths(str(folder), "trips_2023_{:02d}.parquet", [1, 2])
    for month, path in zip((1, 2), paths):
        trips = []
        for _ in range(300):
            day, hour, minutes = rng.randint(1, 27), rng.randint(0, 22), rng.randint(3, 50)
            miles = round(minutes / 6, 2)
            fare = round(3 + 2.5 * miles, 2)
            start = f"2023-{month:02d}-{day:02d} {hour:02d}:00:00"
            end = f"2023-{month:02d}-{day:02d} {hour:02d}:{minutes:02d}:00"
            trips.append((start, end, rng.randint(1, 3), rng.randint(1, 3), rng.randint(1, 6),
                          miles, "1", fare, 0.0, 1.0, fare + 1.0))
        trips.append(trips[0])  # a copy
        trips.append((*trips[1][:2], 264, *trips[1][3:]))  # no such zone
        trips.append((*trips[1][:4], None, *trips[1][5:]))  # incomplete
        trips.append(("2022-12-31 23:59:00", *trips[1][1:]))  # another year
        kinds = ["string", "string", "int", "int", "int", "double", "string", *["double"] * 4]
        df = spark.createDataFrame(
            trips, ", ".join(f"{n} {k}" for n, k in zip(schemas.TRIP_RAW.names, kinds)))
        df.withColumns({
            **{c: F.to_timestamp(c) for c in schemas.TRIP_RAW.names[:2]},
            "passenger_count": F.col("passenger_count").cast("int" if month == 1 else "double"),
        }).write.parquet(path)

    lookup = folder / "zones.csv"
    lookup.write_text("LocationID,Borough,Zone,service_zone\n" + "".join(
        f"{i},{b},{b} Center,{'Airports' if i == 3 else 'Boro Zone'}\n"
        for i, b in enumerate(BOROUGHS, 1)) + "4,Bronx,N/A,Boro Zone\n264,N/A,N/A,N/A\n")
    shapes = str(folder / "shapes")
    spark.createDataFrame([
        (i, f"POLYGON (({x} {y}, {x + .02} {y}, {x + .02} {y + .02}, {x} {y + .02}, {x} {y}))")
        for i, (x, y) in enumerate([(-74.0, 40.70), (-73.95, 40.65), (-73.85, 40.75)], 1)
    ], "LocationID int, geometry string").write.parquet(shapes)
    days = str(folder / "holidays")
    spark.createDataFrame(
        [("United States", "New Year's Day", "New Year's Day", None, "US", None)], schemas.HOLIDAY
    ).withColumn("date", F.to_timestamp(F.lit("2023-01-01"))).write.parquet(days)
    weather = folder / "weather.json"
    weather.write_text(json.dumps({"days": [
        {"datetime": f"2023-{m:02d}-{d:02d}", "temp": m * 5.0 + d % 7} for m in (1, 2)
        for d in range(1, 28)]}))
    return jobs.Inputs(paths, str(lookup), shapes, days, str(weather), 2023)


def test_from_files_to_a_scored_row(spark, inputs, tmp_path):
    before = {p.name.partition("-")[0] for p in Path(shared_folder(spark)).iterdir()}
    cleaned_path, table_path, model_path = (str(tmp_path / n) for n in ("c", "t", "m"))
    cleaned = jobs.cleaned_job(spark, inputs, cleaned_path)
    # 600 trips, at most a few of them drawn twice; copies and bad rows are gone
    assert 595 <= cleaned.count() <= 600 and len(cleaned.columns) == 39
    assert set(r[0] for r in cleaned.select("pickup_borough").distinct().collect()) == set(BOROUGHS)
    assert cleaned.filter("temp IS NULL OR pickup_latitude IS NULL").count() == 0
    assert cleaned.filter("is_holiday = 1").count() == cleaned.filter(
        "pickup_date = date'2023-01-01'").count() > 0
    assert [r.Zone for r in jobs.incomplete_zones(spark, inputs.zone_lookup).collect()] == [None]

    explored = jobs.explored_job(spark, cleaned_path, str(tmp_path / "e"))
    assert len(explored.columns) == 40
    top = explored.agg(F.max("fare_amount"), F.min("fare_amount")).first()
    assert top[0] <= cleaned.agg(F.max("fare_amount")).first()[0] and top[1] > 0
    assert explored.select("payment_type_label").distinct().collect() == [("Credit Card",)]

    table = jobs.model_table_job(spark, cleaned_path, table_path)
    assert table.columns == schemas.MODEL_COLUMNS
    _, held_out = jobs.training_job(spark, table_path, model_path, numTrees=5, maxDepth=5)
    assert held_out.count() > 0

    grids = {"linear_reg": {"regParam": [0.01, 10.0]}, "decision_tree": {"maxDepth": [2, 5]}}
    best_path, board_path = str(tmp_path / "best"), str(tmp_path / "board")
    best, board = jobs.tuning_job(spark, table_path, best_path, board_path, list(grids), grids=grids)
    found = {r.model_name: r for r in board.collect()}
    assert set(found) == set(grids) and found["linear_reg"].hyperparameters == {"regParam": "0.01"}
    assert rows_of(jobs.scoring_job(load_model(best_path), table.limit(5))) == rows_of(
        jobs.scoring_job(best, table.limit(5)))
    # what the jobs wrote on the way is gone: dimensions, daily series, centroids
    left = {p.name.partition("-")[0] for p in Path(shared_folder(spark)).iterdir()}
    assert not left & {"dimension", "daily", "centroids", "rounded"} - before

    form = (1, 1, 20.37, 2, 8, 10, "Manhattan", "Brooklyn", 0, "Medium", "Morning", 0)
    rows = result_table(spark, [form, (*form[:6], "Nowhere", *form[7:10], "Night", 0)],
                        schemas.SCORING_ROW)
    out = jobs.scoring_job(load_model(model_path), rows).collect()
    assert len(out) == 2 and all(r.predicted_total > 0 for r in out)
    # about 3 + 2.5 * 20 / 6 + 1
    assert out[0].predicted_total == pytest.approx(12.5, abs=3)


def test_rounding_before_copies_are_dropped_leaves_the_same_rows(spark, inputs):
    """Source columns rounded first: the rows of the wide distinct, without a second one."""
    raw = jobs.read_monthly(spark, inputs.trip_paths)
    near = raw.withColumn("fare_amount", F.col("fare_amount") + 0.0004)  # equal once rounded
    both = raw.unionByName(near)

    def rounded(df):
        return cleaned.round_half_even(df, {c: d for c, d in cleaned.DECIMALS.items() if c in df.columns})

    early = rounded(cleaned.clean(both, 2023, cleaned.DECIMALS))
    late = rounded(cleaned.clean(both, 2023)).dropDuplicates()
    assert rows_of(early.select(late.columns)) == rows_of(late)
    assert early.count() < cleaned.clean(both, 2023).count()


def test_form_labels_become_training_codes(spark):
    form = spark.createDataFrame(
        [(1, "Card", 20, "Sunday", 8, 10, "Manhattan", "Brooklyn", "No", "Medium", "Night", "Yes"),
         (2, "Barter", 5, "Someday", 9, 1, "Queens", "Queens", "Yes", "Short", "Morning", "No")],
        schemas.SCORING_ROW.names)
    rows = jobs.form_rows(form)
    assert rows.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.SCORING_ROW]
    first, second = rows.orderBy("passenger_count").collect()
    assert (first.payment_type, first.pickup_day_of_week, first.is_holiday, first.near_airport,
            first.time_of_day_bin, first.trip_duration) == (1, 1, 0, 1, "Late Night", 20.0)
    assert (second.payment_type, second.pickup_day_of_week, second.time_of_day_bin) == (
        0, 0, "Morning")
