"""Queries on dimension joins, key checks and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripengine.functions.geo import haversine_km
from tripengine.operators.clean import hash_split
from tripengine.operators.joins import (
    encode_with_means,
    flag_calendar,
    join_daily,
    join_role,
    merge_counts,
    merge_scores,
    one_per_key,
    unmatched_keys,
)
from tripengine.operators.profile import correlations_with, mean_score, variances
from tripengine.plans import tripview as tv
from tripengine.plans.queries_tables import LOCATED_SQL, located_trips
from tripengine.plans.registry import query
from tripengine.plans.tripview import with_tables
from tripengine.session import materialise

KEYS = ["order_key", "line_number"]


@query("join_01_centroids_both_roles", with_tables(f"""
WITH {LOCATED_SQL}
SELECT order_key, line_number, PULocationID, DOLocationID,
       round(pickup_latitude, 6) AS pickup_latitude,
       round(pickup_longitude, 6) AS pickup_longitude,
       round(dropoff_latitude, 6) AS dropoff_latitude,
       round(dropoff_longitude, 6) AS dropoff_longitude
FROM located""", "trips", "centroids"))
def join_01(spark, sf):
    df = located_trips(spark, sf, *KEYS, "PULocationID", "DOLocationID")
    ends = [f"{r}_{c}" for r in ("pickup", "dropoff") for c in ("latitude", "longitude")]
    return df.withColumns({c: F.round(c, 6) for c in ends})


ZONED_SQL = """
zoned AS (
  SELECT t.*, p.Borough AS pickup_borough, p.Zone AS pickup_zone,
         p.service_zone AS pickup_service_zone, d.Borough AS dropoff_borough,
         d.Zone AS dropoff_zone, d.service_zone AS dropoff_service_zone
  FROM trips t LEFT JOIN zones p ON p.LocationID = PULocationID
  LEFT JOIN zones d ON d.LocationID = DOLocationID)"""


ENDS = {"pickup": "PULocationID", "dropoff": "DOLocationID"}
ZONE_NAMES = {"Borough": "borough", "Zone": "zone", "service_zone": "service_zone"}


def stored_zones(spark, sf):
    """The zones, written before they are joined and one row per id."""
    return materialise(one_per_key(tv.zones(spark, sf), "LocationID"), "zones")


def zoned(df, dim, *roles, names=ZONE_NAMES):
    """Columns of a unique zone table for the named ends."""
    for role in roles:
        mine = {c: f"{role}_{n}" for c, n in names.items()}
        df = join_role(df, dim, "LocationID", ENDS[role], mine, unique=True)
    return df


def zoned_trips(spark, sf, *columns, roles=tuple(ENDS)):
    """Trips with borough, zone and service zone of the named ends, read for those only."""
    wanted = list(dict.fromkeys([*columns, *[ENDS[r] for r in roles]]))
    return zoned(tv.trips(spark, sf, *wanted), stored_zones(spark, sf), *roles)


def counts_by_borough(spark, sf, role, count, key="borough"):
    """Trips per borough of one end: counted by zone id, the few counts joined to zones."""
    by_id = tv.trips(spark, sf, ENDS[role]).groupBy(ENDS[role]).agg(F.count("*").alias("n"))
    named = zoned(by_id, stored_zones(spark, sf), role, names={"Borough": "borough"})
    return named.groupBy(F.col(f"{role}_borough").alias(key)).agg(F.sum("n").alias(count))


@query("join_02_zones_both_roles", with_tables(f"""
WITH {ZONED_SQL}
SELECT order_key, line_number, pickup_borough, pickup_zone, pickup_service_zone,
       dropoff_borough, dropoff_zone, dropoff_service_zone
FROM zoned""", "trips", "zones"))
def join_02(spark, sf):
    return zoned_trips(spark, sf, *KEYS).drop("PULocationID", "DOLocationID")


FLAGGED_SQL = """
us_days AS (
  SELECT CAST(date AS DATE) AS day, min(holidayName) AS holidayName,
         arg_min(normalizeHolidayName, holidayName) AS normalizeHolidayName
  FROM holidays WHERE countryRegionCode = 'US' GROUP BY 1),
flagged AS (
  SELECT t.*, coalesce(holidayName, 'No Holiday') AS holidayName,
         coalesce(normalizeHolidayName, 'No Holiday') AS normalizeHolidayName,
         CASE WHEN holidayName IS NULL THEN 0 ELSE 1 END AS is_holiday
  FROM trips t LEFT JOIN us_days ON day = CAST(pickup_datetime AS DATE))"""


@query("join_03_holiday_flag", with_tables(f"""
WITH {FLAGGED_SQL}
SELECT order_key, line_number, holidayName, normalizeHolidayName, is_holiday
FROM flagged""", "trips", "holidays"))
def join_03(spark, sf):
    trips = tv.trips(spark, sf, *KEYS, "pickup_datetime").withColumn(
        "pickup_date", F.to_date("pickup_datetime")
    )
    return flag_calendar(trips, materialise(tv.holidays(spark, sf), "holidays")).select(
        *KEYS, "holidayName", "normalizeHolidayName", "is_holiday"
    )


@query("join_04_daily_weather", with_tables("""
SELECT order_key, line_number, round(temp, 6) AS temp
FROM trips LEFT JOIN weather ON weather_date = CAST(dropoff_datetime AS DATE)""",
    "trips", "weather"))
def join_04(spark, sf):
    trips = tv.trips(spark, sf, *KEYS, "dropoff_datetime").withColumn(
        "dropoff_date", F.to_date("dropoff_datetime")
    )
    return join_daily(trips, materialise(tv.weather(spark, sf), "weather"), "dropoff_date").select(
        *KEYS, F.round("temp", 6).alias("temp")
    )


@query("join_05_unmatched_keys", with_tables("""
SELECT DISTINCT 'pickup' AS role, PULocationID AS LocationID FROM trips
WHERE NOT EXISTS (SELECT 1 FROM centroids c WHERE c.LocationID = PULocationID)
UNION ALL
SELECT DISTINCT 'dropoff', DOLocationID FROM trips
WHERE NOT EXISTS (SELECT 1 FROM centroids c WHERE c.LocationID = DOLocationID)""", "trips", "centroids"))
def join_05(spark, sf):
    places = tv.centroids(spark, sf)
    found = []
    for role, key in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        keys = unmatched_keys(tv.trips(spark, sf, key), places, key, "LocationID")
        found.append(keys.select(F.lit(role).alias("role"), "LocationID"))
    return found[0].unionByName(found[1])


SCORED = ["passenger_count", "fare_amount", "tolls_amount", "improvement_surcharge"]


def score_tables(spark, sf):
    """Two score lists that cover different features."""
    trips = tv.trips(spark, sf, *SCORED, "total_amount")
    corr = correlations_with(trips, SCORED[:3], "total_amount").select(
        "feature", F.abs("correlation").alias("corr_score")
    )
    spread = variances(trips, SCORED[1:]).select(
        "feature", F.col("variance").alias("variance_score")
    )
    return {"corr_score": corr, "variance_score": spread}


SCORES_SQL = """
corr_scores AS (
  SELECT 'passenger_count' AS feature, abs(corr(passenger_count, total_amount)) AS corr_score
  FROM trips
  UNION ALL SELECT 'fare_amount', abs(corr(fare_amount, total_amount)) FROM trips
  UNION ALL SELECT 'tolls_amount', abs(corr(tolls_amount, total_amount)) FROM trips),
variance_scores AS (
  SELECT 'fare_amount' AS feature, var_samp(fare_amount) AS variance_score FROM trips
  UNION ALL SELECT 'tolls_amount', var_samp(tolls_amount) FROM trips
  UNION ALL SELECT 'improvement_surcharge', var_samp(improvement_surcharge) FROM trips),
merged AS (
  SELECT coalesce(c.feature, v.feature) AS feature, coalesce(corr_score, 0) AS corr_score,
         coalesce(variance_score, 0) AS variance_score
  FROM corr_scores c FULL OUTER JOIN variance_scores v ON c.feature = v.feature)"""


@query("join_06_merge_scores", with_tables(f"""
WITH {SCORES_SQL}
SELECT feature, round(corr_score, 6) AS corr_score, round(variance_score, 3) AS variance_score
FROM merged""", "trips"))
def join_06(spark, sf):
    return merge_scores(score_tables(spark, sf)).select(
        "feature", F.round("corr_score", 6).alias("corr_score"),
        F.round("variance_score", 3).alias("variance_score"),
    )


@query("agg_34_mean_of_scores", with_tables(f"""
WITH {SCORES_SQL}
SELECT feature, round((corr_score + variance_score) / 2, 3) AS average_importance
FROM merged""", "trips"))
def agg_34(spark, sf):
    tables = score_tables(spark, sf)
    return mean_score(merge_scores(tables), list(tables)).select(
        "feature", F.round("average_importance", 3).alias("average_importance")
    )


@query("join_07_merge_counts", with_tables(f"""
WITH {ZONED_SQL},
p AS (SELECT pickup_borough AS b, count(*) AS n FROM zoned GROUP BY 1),
d AS (SELECT dropoff_borough AS b, count(*) AS n FROM zoned GROUP BY 1)
SELECT coalesce(p.b, d.b) AS borough, coalesce(p.n, 0) AS pickup_count,
       coalesce(d.n, 0) AS dropoff_count
FROM p FULL OUTER JOIN d ON p.b IS NOT DISTINCT FROM d.b""", "trips", "zones"))
def join_07(spark, sf):
    pickups = counts_by_borough(spark, sf, "pickup", "pickup_count")
    dropoffs = counts_by_borough(spark, sf, "dropoff", "dropoff_count")
    return merge_counts(pickups, dropoffs, "borough", "borough", "borough")


@query("join_08_counts_per_zone", with_tables(f"""
WITH {ZONED_SQL},
p AS (SELECT pickup_borough AS b, count(*) AS pickup_count FROM zoned GROUP BY 1)
SELECT LocationID, Zone, Borough, pickup_count FROM zones LEFT JOIN p ON b = Borough""",
    "trips", "zones"))
def join_08(spark, sf):
    counts = counts_by_borough(spark, sf, "pickup", "pickup_count", "Borough")
    return tv.zones(spark, sf).join(counts, "Borough", "left").select(
        "LocationID", "Zone", "Borough", "pickup_count"
    )


PART_SQL = """
keyed AS (
  SELECT *, CAST('0x' || substr(md5(order_key || '|' || line_number), 1, 8) AS BIGINT) % 100 AS h
  FROM trips)"""


@query("join_09_target_means_on_both_parts", with_tables(f"""
WITH {PART_SQL},
means AS (SELECT payment_type AS k, avg(total_amount) AS m FROM keyed WHERE h < 80 GROUP BY 1),
zmeans AS (SELECT DOLocationID AS k, avg(total_amount) AS m FROM keyed WHERE h < 80 GROUP BY 1)
SELECT CASE WHEN h < 80 THEN 'train' ELSE 'test' END AS part, order_key, line_number,
       round(means.m, 4) AS payment_type_target_mean, round(zmeans.m, 4) AS DOLocationID_target_mean
FROM keyed LEFT JOIN means ON means.k = payment_type
LEFT JOIN zmeans ON zmeans.k = DOLocationID""", "trips"))
def join_09(spark, sf):
    trips = materialise(
        tv.trips(spark, sf, *KEYS, "payment_type", "DOLocationID", "total_amount"), "trips"
    )
    train, test = hash_split(trips, 80, *KEYS)
    coded = encode_with_means(train, [test], ["payment_type", "DOLocationID"], "total_amount")
    means = ["payment_type_target_mean", "DOLocationID_target_mean"]
    rows = [
        df.select(F.lit(name).alias("part"), *KEYS, *[F.round(c, 4).alias(c) for c in means])
        for name, df in zip(["train", "test"], coded)
    ]
    return rows[0].unionByName(rows[1])


DISTANCE_SQL = """2 * 6371.0 * asin(sqrt(least(1.0,
  sin(radians(dropoff_latitude - pickup_latitude) / 2) ** 2
  + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
    * sin(radians(dropoff_longitude - pickup_longitude) / 2) ** 2)))"""

_DISTANCE_ORACLE = with_tables(f"""
WITH {LOCATED_SQL}
SELECT order_key, line_number,
       round(CASE WHEN pickup_latitude IS NULL OR dropoff_latitude IS NULL THEN 0
                  ELSE {DISTANCE_SQL} END, 5) AS distance_km
FROM located""", "trips", "centroids")


@query("scl_07_haversine", _DISTANCE_ORACLE)
@query("udf_01_distance_without_python", _DISTANCE_ORACLE)
def scl_07(spark, sf):
    return located_trips(spark, sf, *KEYS, "PULocationID", "DOLocationID").select(
        *KEYS,
        F.round(haversine_km(
            "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"
        ), 5).alias("distance_km"),
    )
