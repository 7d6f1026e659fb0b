"""From raw trips to the cleaned, the feature and the model table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine import schemas
from tripengine.functions.bins import (
    distance_bin,
    near_airport,
    season,
    temperature_bin,
    time_of_day_bin,
)
from tripengine.functions.calendar import (
    calendar_parts,
    date_text,
    duration_minutes,
    in_year,
    time_text,
    two_digits,
)
from tripengine.functions.geo import (
    WIDE_LATITUDE,
    WIDE_LONGITUDE,
    haversine_km,
    inside_box,
)
from tripengine.functions.labels import code_label
from tripengine.functions.predicates import above_up_to, in_none, positive
from tripengine.operators.clean import round_half_even
from tripengine.operators.joins import flag_calendar, join_daily, join_role, one_per_key
from tripengine.operators.quantiles import cap_upper, iqr_bounds
from tripengine.session import materialise

# Zone ids without a place on the map.
UNMAPPED_ZONES = [57, 105, 264, 265]


def ingest(raw: DataFrame) -> DataFrame:
    """Duration and pickup parts beside the source columns."""
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return calendar_parts(
        raw.withColumn("trip_duration", duration_minutes(start, end)),
        start, "pickup", ["day_of_week", "hour"],
    )


def clean(
    trips: DataFrame, year: int | None = None, decimals: Mapping[str, int] | None = None
) -> DataFrame:
    """Distinct complete trips with duration and calendar parts, of one year if given.

    Copies are dropped before columns are derived, so that the shuffle this
    takes moves the source columns alone. With ``decimals`` source columns are
    rounded first: all other columns of the cleaned table follow from a row's
    source columns, so it then holds no two rows that rounding makes equal.
    """
    names = {"tpep_pickup_datetime": "pickup_datetime",
             "tpep_dropoff_datetime": "dropoff_datetime"}
    df = trips
    if year is not None:
        for ts in names:
            df = df.filter(in_year(ts, year))
    df = df.dropna()
    if decimals is not None:
        df = round_half_even(df, {c: d for c, d in decimals.items() if c in df.columns})
    df = ingest(df.dropDuplicates()).withColumnsRenamed(names)
    if "month" in df.columns:
        df = df.withColumn("Month_Num", two_digits("month")).drop("month")
    else:
        df = df.withColumn("Month_Num", F.month("pickup_datetime"))
    df = calendar_parts(df, "pickup_datetime", "pickup", ["month"])
    df = calendar_parts(df, "dropoff_datetime", "dropoff")
    return df.withColumns({
        "pickup_date": date_text("pickup_datetime"),
        "pickup_time": time_text("pickup_datetime"),
        "dropoff_date": date_text("dropoff_datetime"),
        "dropoff_time": time_text("dropoff_datetime"),
    })


def enrich(
    trips: DataFrame, zones: DataFrame, centroids: DataFrame, holidays: DataFrame,
    weather: DataFrame, excluded_zones: Sequence[int] = UNMAPPED_ZONES,
) -> DataFrame:
    """Coordinates, distance, zones, holidays and weather: the cleaned table."""
    df = trips.filter(in_none(["PULocationID", "DOLocationID"], excluded_zones))
    # written and unique before they are joined, so their size is known and no trip repeats
    zones, centroids = (
        materialise(one_per_key(dim, "LocationID"), "dimension") for dim in (zones, centroids)
    )
    for role, key in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        df = join_role(df, centroids, "LocationID", key, {
            "latitude": f"{role}_latitude", "longitude": f"{role}_longitude"}, unique=True)
        df = join_role(df, zones, "LocationID", key, {
            "Borough": f"{role}_borough", "Zone": f"{role}_zone",
            "service_zone": f"{role}_service_zone"}, unique=True)
    df = df.withColumns({
        "distance_km": haversine_km(
            "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"),
        "pickup_date": F.to_date("pickup_datetime"),
    })
    return join_daily(flag_calendar(df, holidays), weather)


CAPPED = ["trip_distance", "trip_duration"]


def positive_and_capped(
    df: DataFrame, columns: Sequence[str] = CAPPED, rel_err: float | None = None
) -> DataFrame:
    """Per column in turn: keep positive rows, lower the upper outliers."""
    for column in columns:
        df = df.filter(positive(column))
        df = cap_upper(df, column, iqr_bounds(df, column, rel_err=rel_err))
    return df


# Decimals kept per column before the distributions are looked at.
DECIMALS = {
    "trip_distance": 2,
    "fare_amount": 2,
    "tolls_amount": 2,
    "improvement_surcharge": 2,
    "total_amount": 2,
    "trip_duration": 2,
    "distance_km": 2,
    "pickup_latitude": 5,
    "pickup_longitude": 5,
    "dropoff_latitude": 5,
    "dropoff_longitude": 5,
    "temp": 1,
}


def explored_table(cleaned: DataFrame, rel_err: float | None = None) -> DataFrame:
    """Rounded distinct trips without implausible amounts, counts and distances.

    Fares, totals and distances are positive and capped at their upper bound,
    one to six passengers ride, and the payment code has its label: 40 columns.
    """
    # written once, as the bounds below each read it
    return plausible(materialise(round_half_even(cleaned, DECIMALS).dropDuplicates(), "rounded"), rel_err)


def plausible(df: DataFrame, rel_err: float | None = None) -> DataFrame:
    """What ``explored_table`` does with rows that are rounded and distinct already."""
    df = positive_and_capped(df, ["fare_amount", "total_amount"], rel_err)
    df = df.filter(above_up_to("passenger_count", 0, 6)).withColumn(
        "payment_type_label", code_label(F.col("payment_type"))
    )
    return positive_and_capped(df, ["trip_distance"], rel_err)


def bin_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "distance_bin": distance_bin(),
        "temp_bin": temperature_bin(),
        "time_of_day_bin": time_of_day_bin(),
        "season": season(F.month("pickup_datetime")),
        "near_airport": near_airport("pickup_service_zone", "dropoff_service_zone"),
    })


#: Columns of the cleaned table that the feature table is made from.
FEATURE_SOURCES = [
    "DOLocationID", "PULocationID", "passenger_count", "payment_type", "total_amount",
    "trip_distance", "trip_duration", "pickup_datetime", "pickup_day_of_week", "pickup_hour",
    "pickup_month", "pickup_borough", "dropoff_borough", "pickup_service_zone",
    "dropoff_service_zone", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
    "dropoff_latitude", "temp", "distance_km", "is_holiday",
]


def feature_table(
    cleaned: DataFrame, rel_err: float | None = None, longitude=WIDE_LONGITUDE,
    latitude=WIDE_LATITUDE,
) -> DataFrame:
    """Filtered, capped and binned trips: 19 columns."""
    pairs = [("pickup_longitude", "pickup_latitude"), ("dropoff_longitude", "dropoff_latitude")]
    df = positive_and_capped(cleaned, rel_err=rel_err)
    df = df.filter(inside_box(pairs, longitude, latitude))
    return bin_features(df).select(schemas.FEATURE_COLUMNS)


def model_table(features: DataFrame) -> DataFrame:
    """The 13 columns models are trained on, payment code as a number."""
    return features.select(schemas.MODEL_COLUMNS).withColumn(
        "payment_type", F.col("payment_type").try_cast("int")
    )
