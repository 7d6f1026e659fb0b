"""Queries on scalar functions, bins and the finished tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripengine import schemas
from tripengine.functions.bins import (
    distance_bin,
    near_airport,
    season,
    temperature_bin,
    time_of_day_bin,
    width_bucket_floor,
)
from tripengine.functions.calendar import (
    calendar_parts,
    date_text,
    duration_minutes,
    time_text,
    two_digits,
)
from tripengine.functions.labels import FORM_PAYMENT, FORM_WEEKDAY, code_label, form_code
from tripengine.operators.clean import round_half_even
from tripengine.operators.joins import join_groups
from tripengine.operators.quantiles import exact_quantiles
from tripengine.plans import tripview as tv
from tripengine.plans.cleaned import (
    DECIMALS,
    FEATURE_SOURCES,
    clean,
    enrich,
    feature_table,
    model_table,
    plausible,
)
from tripengine.plans.queries_joins import (
    DISTANCE_SQL,
    KEYS,
    ZONED_SQL,
    zoned_trips,
)
from tripengine.plans.registry import query
from tripengine.plans.tripview import with_tables
from tripengine.session import materialise, scratch
from tripengine.sources.files import read_stage, write_stage


@query("scl_01_duration_minutes", with_tables("""
SELECT order_key, line_number, round(trip_duration, 6) AS trip_duration FROM trips""", "trips"))
def scl_01(spark, sf):
    df = tv.trips(spark, sf, *KEYS, "pickup_datetime", "dropoff_datetime")
    return df.select(
        *KEYS, F.round(duration_minutes("pickup_datetime", "dropoff_datetime"), 6)
        .alias("trip_duration")
    )


@query("scl_02_calendar_parts", with_tables("""
SELECT order_key, line_number,
       CAST(hour(dropoff_datetime) AS INTEGER) AS dropoff_hour,
       CAST(dayofweek(dropoff_datetime) + 1 AS INTEGER) AS dropoff_day_of_week,
       CAST(month(dropoff_datetime) AS INTEGER) AS dropoff_month,
       CAST(weekofyear(dropoff_datetime) AS INTEGER) AS dropoff_week_of_year
FROM trips""", "trips"))
def scl_02(spark, sf):
    df = tv.trips(spark, sf, *KEYS, "dropoff_datetime")
    return calendar_parts(df, "dropoff_datetime", "dropoff").drop("dropoff_datetime")


@query("scl_03_date_and_time_text", with_tables("""
SELECT order_key, line_number, strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date,
       strftime(pickup_datetime, '%H:%M:%S') AS pickup_time
FROM trips""", "trips"))
def scl_03(spark, sf):
    return tv.trips(spark, sf, *KEYS, "pickup_datetime").select(
        *KEYS,
        date_text("pickup_datetime").alias("pickup_date"),
        time_text("pickup_datetime").alias("pickup_time"),
    )


@query("scl_04_date_and_year", with_tables("""
SELECT CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS day,
       CAST(year(pickup_datetime) AS INTEGER) AS year, count(*) AS n
FROM trips GROUP BY ALL""", "trips"))
def scl_04(spark, sf):
    day = F.to_date(date_text("pickup_datetime"))
    return tv.trips(spark, sf, "pickup_datetime").groupBy(
        day.cast("string").alias("day"), F.year(day).alias("year")
    ).agg(F.count("*").alias("n"))


@query("scl_05_digits_from_text", r"""
SELECT TRY_CAST(nullif(regexp_extract(p_brand, '(\d{2})', 1), '') AS INTEGER) AS digits,
       count(*) AS n
FROM part GROUP BY 1""")
def scl_05(spark, sf):
    return tv.read(spark, sf, "part").groupBy(two_digits("p_brand").alias("digits")).agg(
        F.count("*").alias("n")
    )


@query("scl_06_code_labels", """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
         WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided Trip' END AS label
FROM lineitem""")
def scl_06(spark, sf):
    return tv.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", code_label(F.col("l_linenumber")).alias("label")
    )


@query("scl_08_null_flag", """
SELECT doc_id, CASE WHEN quality IS NULL THEN 1 ELSE 0 END AS is_unlabelled
FROM documents LEFT JOIN labels USING (doc_id)""")
def scl_08(spark, sf):
    documents = tv.read(spark, sf, "documents").select("doc_id")
    return documents.join(tv.read(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", F.col("quality").isNull().cast("int").alias("is_unlabelled")
    )


@query("scl_09_floor_and_abs", """
SELECT c_custkey, CAST(floor(c_acctbal / 500) * 500 AS DOUBLE) AS balance_range,
       round(abs(c_acctbal - 5000), 4) AS distance
FROM customer""")
def scl_09(spark, sf):
    return tv.read(spark, sf, "customer").select(
        "c_custkey",
        width_bucket_floor("c_acctbal", 500).cast("double").alias("balance_range"),
        F.round(F.abs(F.col("c_acctbal") - 5000), 4).alias("distance"),
    )


@query("scl_10_form_codes", """
SELECT o_orderkey, CASE strftime(o_orderdate, '%A') WHEN 'Sunday' THEN 1 WHEN 'Monday' THEN 2
         WHEN 'Tuesday' THEN 3 WHEN 'Wednesday' THEN 4 WHEN 'Thursday' THEN 5
         WHEN 'Friday' THEN 6 WHEN 'Saturday' THEN 7 ELSE 0 END AS pickup_day_of_week,
       CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS payment_type
FROM orders""")
def scl_10(spark, sf):
    weekday = F.date_format("o_orderdate", "EEEE")
    label = F.when(F.col("o_orderstatus") == "O", "Card").when(
        F.col("o_orderstatus") == "F", "Cash").otherwise("Barter")
    return tv.read(spark, sf, "orders").select(
        "o_orderkey",
        form_code(weekday, FORM_WEEKDAY).alias("pickup_day_of_week"),
        form_code(label, FORM_PAYMENT).alias("payment_type"),
    )


# bins ---------------------------------------------------------------------


@query("bin_01_distance", with_tables("""
SELECT order_key, line_number, CASE WHEN trip_distance <= 2 THEN 'Short'
  WHEN trip_distance <= 5 THEN 'Medium' ELSE 'Long' END AS distance_bin FROM trips""", "trips"))
def bin_01(spark, sf):
    return tv.trips(spark, sf, *KEYS, "trip_distance").select(
        *KEYS, distance_bin().alias("distance_bin")
    )


@query("bin_02_temperature", with_tables("""
SELECT event_id, CASE WHEN temp <= 10 THEN 'Cold' WHEN temp <= 20 THEN 'Cool'
  WHEN temp <= 30 THEN 'Warm' ELSE 'Hot' END AS temp_bin FROM event_rows""", "event_rows"))
def bin_02(spark, sf):
    return tv.events(spark, sf).select("event_id", temperature_bin().alias("temp_bin"))


@query("bin_03_time_of_day", with_tables("""
SELECT event_id, CASE WHEN hour(pickup_datetime) < 6 THEN 'Late Night'
  WHEN hour(pickup_datetime) < 12 THEN 'Morning'
  WHEN hour(pickup_datetime) < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day_bin
FROM event_rows""", "event_rows"))
def bin_03(spark, sf):
    return tv.events(spark, sf).withColumn("pickup_hour", F.hour("pickup_datetime")).select(
        "event_id", time_of_day_bin().alias("time_of_day_bin")
    )


@query("bin_04_season", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
  WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
  WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM orders""")
def bin_04(spark, sf):
    return tv.read(spark, sf, "orders").select(
        "o_orderkey", season(F.month("o_orderdate")).alias("season")
    )


@query("bin_05_near_airport", with_tables(f"""
WITH {ZONED_SQL}
SELECT order_key, line_number,
       CASE WHEN pickup_service_zone = 'Airports' OR dropoff_service_zone = 'Airports'
            THEN 1 ELSE 0 END AS near_airport
FROM zoned""", "trips", "zones"))
def bin_05(spark, sf):
    return zoned_trips(spark, sf, *KEYS).select(
        *KEYS, near_airport("pickup_service_zone", "dropoff_service_zone").alias("near_airport")
    )


# finished tables ----------------------------------------------------------

COMPLETE_SQL = " AND ".join(
    f"t.{c.replace('tpep_', '')} IS NOT NULL" for c in schemas.TRIP_RAW.names)

CLEANED_SQL = f"""
us_days AS (
  SELECT CAST(date AS DATE) AS day, min(holidayName) AS holidayName,
         arg_min(normalizeHolidayName, holidayName) AS normalizeHolidayName
  FROM holidays WHERE countryRegionCode = 'US' GROUP BY 1),
located AS (
  SELECT DISTINCT t.* EXCLUDE (order_key, line_number),
         pc.latitude AS pickup_latitude, pc.longitude AS pickup_longitude,
         dc.latitude AS dropoff_latitude, dc.longitude AS dropoff_longitude,
         pz.Borough AS pickup_borough, pz.Zone AS pickup_zone,
         pz.service_zone AS pickup_service_zone, dz.Borough AS dropoff_borough,
         dz.Zone AS dropoff_zone, dz.service_zone AS dropoff_service_zone
  FROM trips t
  LEFT JOIN centroids pc ON pc.LocationID = PULocationID
  LEFT JOIN centroids dc ON dc.LocationID = DOLocationID
  LEFT JOIN zones pz ON pz.LocationID = PULocationID
  LEFT JOIN zones dz ON dz.LocationID = DOLocationID
  WHERE {COMPLETE_SQL}),
cleaned AS (
  SELECT l.*,
         CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
         CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
         CAST(month(pickup_datetime) AS INTEGER) AS Month_Num,
         CAST(hour(dropoff_datetime) AS INTEGER) AS dropoff_hour,
         CAST(dayofweek(dropoff_datetime) + 1 AS INTEGER) AS dropoff_day_of_week,
         CAST(month(dropoff_datetime) AS INTEGER) AS dropoff_month,
         CAST(weekofyear(dropoff_datetime) AS INTEGER) AS dropoff_week_of_year,
         strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date,
         strftime(pickup_datetime, '%H:%M:%S') AS pickup_time,
         strftime(dropoff_datetime, '%Y-%m-%d') AS dropoff_date,
         strftime(dropoff_datetime, '%H:%M:%S') AS dropoff_time,
         CASE WHEN pickup_latitude IS NULL OR dropoff_latitude IS NULL THEN 0
              ELSE {DISTANCE_SQL} END AS distance_km,
         coalesce(holidayName, 'No Holiday') AS holidayName,
         coalesce(normalizeHolidayName, 'No Holiday') AS normalizeHolidayName,
         CASE WHEN holidayName IS NULL THEN 0 ELSE 1 END AS is_holiday,
         temp
  FROM located l
  LEFT JOIN us_days ON day = CAST(pickup_datetime AS DATE)
  LEFT JOIN weather ON weather_date = CAST(pickup_datetime AS DATE))"""
CLEANED_TABLES = ("trips", "zones", "centroids", "holidays", "weather")

ROUNDED = [
    "tolls_amount", "total_amount", "trip_duration", "pickup_latitude", "pickup_longitude",
    "dropoff_latitude", "dropoff_longitude", "distance_km", "temp",
]


def cleaned_trips(spark, sf, decimals=None):
    """The 39-column table, from raw trips to weather."""
    return enrich(
        clean(tv.raw_trips(spark, sf), decimals=decimals),
        tv.zones(spark, sf), tv.centroids(spark, sf),
        materialise(tv.holidays(spark, sf), "holidays"),
        materialise(tv.weather(spark, sf), "weather"),
    )


_CLEANED_OUT = ", ".join(f"round({c}, 6) AS {c}" for c in ROUNDED)


@query("cleaned_trips", with_tables(f"""
WITH {CLEANED_SQL}
SELECT * EXCLUDE ({", ".join(ROUNDED)}, pickup_datetime, dropoff_datetime), {_CLEANED_OUT},
       strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
       strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime
FROM cleaned""", *CLEANED_TABLES))
def cleaned(spark, sf):
    texts = ["pickup_datetime", "dropoff_datetime"]
    return cleaned_trips(spark, sf).withColumns({
        **{c: F.round(c, 6) for c in ROUNDED},
        **{c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in texts},
        "pickup_date": F.col("pickup_date").cast("string"),
    })


def _half_even_sql(column, digits):
    """Half-even rounding in decimal digits, as a number is printed."""
    scaled = f"(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38, 16)) * {10 ** digits})"
    up = (f"{scaled} - floor({scaled}) > 0.5 OR "
          f"({scaled} - floor({scaled}) = 0.5 AND floor({scaled}) % 2 <> 0)")
    return f"CAST(floor({scaled}) + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE) / {10 ** digits}"


def _capped_sql(name, source, column, also=""):
    """Positive values of a column, lowered to the upper quartile bound."""
    return f"""
{name}_q AS (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3
  FROM {source} WHERE {column} > 0 {also}),
{name} AS (SELECT * EXCLUDE (q1, q3) REPLACE (least({column}, q3 + 1.5 * (q3 - q1)) AS {column})
  FROM {source}, {name}_q WHERE {column} > 0 {also})"""


EXPLORED_SQL = CLEANED_SQL + f""",
rounded AS (SELECT DISTINCT * REPLACE (
  {", ".join(f"{_half_even_sql(c, d)} AS {c}" for c, d in DECIMALS.items())}) FROM cleaned),
{_capped_sql("e1", "rounded", "fare_amount")},
{_capped_sql("e2", "e1", "total_amount")},
{_capped_sql("e3", "e2", "trip_distance", "AND passenger_count > 0 AND passenger_count <= 6")}"""


@query("explored_trips", with_tables(f"""
WITH {EXPLORED_SQL}
SELECT * EXCLUDE (pickup_datetime, dropoff_datetime)
         REPLACE (round(total_amount, 6) AS total_amount, round(fare_amount, 6) AS fare_amount),
       CASE payment_type WHEN '1' THEN 'Credit Card' WHEN '2' THEN 'Cash'
         WHEN '3' THEN 'No Charge' WHEN '4' THEN 'Dispute' WHEN '5' THEN 'Unknown' END
         AS payment_type_label
FROM e3""", *CLEANED_TABLES))
def explored(spark, sf):
    # source columns are rounded before copies are dropped: one narrow shuffle, not a second of 40 columns
    path, derived = scratch(spark, "cleaned"), {c: d for c, d in DECIMALS.items() if c not in schemas.TRIP_RAW.names}
    write_stage(round_half_even(cleaned_trips(spark, sf, DECIMALS), derived), path, "parquet")
    return plausible(read_stage(spark, path, "parquet")).withColumns({
        **{c: F.round(c, 6) for c in ("total_amount", "fare_amount")},
        "pickup_date": F.col("pickup_date").cast("string"),
    }).drop("pickup_datetime", "dropoff_datetime")


FEATURES_SQL = CLEANED_SQL + """,
d1 AS (SELECT *, quantile_cont(trip_distance, 0.75) OVER () AS q3,
              quantile_cont(trip_distance, 0.25) OVER () AS q1
       FROM cleaned WHERE trip_distance > 0),
d2 AS (SELECT * REPLACE (least(trip_distance, q3 + 1.5 * (q3 - q1)) AS trip_distance)
       FROM d1),
d3 AS (SELECT * EXCLUDE (q1, q3), quantile_cont(trip_duration, 0.75) OVER () AS q3,
              quantile_cont(trip_duration, 0.25) OVER () AS q1
       FROM d2 WHERE trip_duration > 0),
d4 AS (SELECT * REPLACE (least(trip_duration, q3 + 1.5 * (q3 - q1)) AS trip_duration)
       FROM d3),
features AS (
  SELECT DOLocationID, PULocationID, passenger_count, payment_type, total_amount,
         trip_duration, pickup_day_of_week, pickup_hour, pickup_month, pickup_borough,
         dropoff_borough, temp, distance_km, is_holiday,
         CASE WHEN trip_distance <= 2 THEN 'Short' WHEN trip_distance <= 5 THEN 'Medium'
              ELSE 'Long' END AS distance_bin,
         CASE WHEN temp <= 10 THEN 'Cold' WHEN temp <= 20 THEN 'Cool'
              WHEN temp <= 30 THEN 'Warm' ELSE 'Hot' END AS temp_bin,
         CASE WHEN pickup_hour < 6 THEN 'Late Night' WHEN pickup_hour < 12 THEN 'Morning'
              WHEN pickup_hour < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day_bin,
         CASE WHEN pickup_month IN (12, 1, 2) THEN 'Winter'
              WHEN pickup_month IN (3, 4, 5) THEN 'Spring'
              WHEN pickup_month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
         CASE WHEN pickup_service_zone = 'Airports' OR dropoff_service_zone = 'Airports'
              THEN 1 ELSE 0 END AS near_airport
  FROM d4
  WHERE pickup_longitude BETWEEN -74.1 AND -73.8 AND dropoff_longitude BETWEEN -74.1 AND -73.8
    AND pickup_latitude BETWEEN 40.5 AND 40.9 AND dropoff_latitude BETWEEN 40.5 AND 40.9)"""


def stored_features(spark, sf):
    """The feature table over a stored cleaned table; texts nobody reads are not made."""
    path = scratch(spark, "cleaned")
    write_stage(cleaned_trips(spark, sf).select(FEATURE_SOURCES), path, "parquet")
    return feature_table(read_stage(spark, path, "parquet"))


_FEATURES_ROUNDED = ["total_amount", "trip_duration", "temp", "distance_km"]


@query("feature_table", with_tables(f"""
WITH {FEATURES_SQL}
SELECT * REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in _FEATURES_ROUNDED)})
FROM features""", *CLEANED_TABLES))
def features(spark, sf):
    return stored_features(spark, sf).withColumns(
        {c: F.round(c, 6) for c in _FEATURES_ROUNDED}
    )


@query("model_table", with_tables(f"""
WITH {FEATURES_SQL}
SELECT {", ".join(c for c in schemas.MODEL_COLUMNS
                  if c not in ("total_amount", "trip_duration", "payment_type"))},
       CAST(payment_type AS INTEGER) AS payment_type, round(total_amount, 6) AS total_amount,
       round(trip_duration, 6) AS trip_duration
FROM features""", *CLEANED_TABLES))
def model_rows(spark, sf):
    return model_table(stored_features(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("total_amount", "trip_duration")}
    )


@query("fares_by_pickup_borough", with_tables(f"""
WITH {ZONED_SQL}
SELECT pickup_borough, count(*) AS trips, round(avg(fare_amount), 4) AS average_fare,
       round(median(fare_amount), 4) AS median_fare, round(sum(fare_amount), 2) AS total_fare
FROM zoned WHERE trip_duration > 0 GROUP BY 1""", "trips", "zones"))
def fares_by_borough(spark, sf):
    """Trips of positive duration: mean, median and total fare by pickup borough."""
    df = materialise(
        zoned_trips(spark, sf, "fare_amount", "trip_duration", roles=["pickup"])
        .filter(F.col("trip_duration") > 0)
        .select("pickup_borough", "fare_amount")
    )
    sums = df.groupBy("pickup_borough").agg(
        F.count("*").alias("trips"),
        F.round(F.avg("fare_amount"), 4).alias("average_fare"),
        F.round(F.sum("fare_amount"), 2).alias("total_fare"),
    )
    medians = exact_quantiles(df, "fare_amount", {"median_fare": 0.5}, ["pickup_borough"])
    return join_groups(
        sums, medians.withColumn("median_fare", F.round("median_fare", 4)), ["pickup_borough"]
    )
