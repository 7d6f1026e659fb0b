"""Queries on counts, profiles, grouped means, quantiles, pivots, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripengine.functions.bins import (
    DISTANCE_CUTS,
    DISTANCE_LABELS,
    FARE_CUTS,
    FARE_LABELS,
    cut_bin,
    distance_bin,
    distance_category,
    width_bucket_floor,
)
from tripengine.functions.calendar import date_text, time_text
from tripengine.functions.labels import code_label
from tripengine.operators.aggregate import (
    bucket_mean,
    compare_distributions,
    counts_in_order,
    histogram,
    normalise,
    null_percentage,
    pivot_counts,
    share,
    share_in_set,
    top_k,
    value_counts,
    value_counts_all,
)
from tripengine.operators.clean import hash_sample
from tripengine.operators.joins import join_groups
from tripengine.operators.profile import (
    anova,
    category_target_means,
    correlation_matrix,
    correlations_with,
    describe,
    distinct_counts,
    duplicate_rows,
    moments,
    null_counts,
    select_by_variance,
)
from tripengine.operators import summaries
from tripengine.operators.quantiles import (
    box_numbers,
    cap_upper,
    exact_quantiles,
    iqr_bounds,
    sketch_quantiles,
)
from tripengine.plans import tripview as tv
from tripengine.plans.queries_joins import (
    ZONED_SQL,
    counts_by_borough,
    stored_zones,
    zoned,
    zoned_trips,
)
from tripengine.plans.queries_tables import BOUNDS_SQL, BUCKET_SQL
from tripengine.plans.registry import query
from tripengine.plans.tripview import with_tables
from tripengine.session import materialise, scratch


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# counts and profiles ------------------------------------------------------


@query("agg_01_row_count", "SELECT count(*) AS n FROM lineitem")
def agg_01(spark, sf):
    return tv.read(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@query("agg_02_duplicate_rows", """
SELECT (SELECT CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM documents GROUP BY text))
  AS duplicates""")
def agg_02(spark, sf):
    return duplicate_rows(tv.read(spark, sf, "documents").select("text"))


@query("agg_02_duplicate_keys", """
SELECT CAST(sum(c - 1) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def agg_02_keys(spark, sf):
    return duplicate_rows(tv.read(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("agg_03_distinct_rows", "SELECT DISTINCT lang, text FROM documents")
def agg_03(spark, sf):
    return tv.read(spark, sf, "documents").select("lang", "text").dropDuplicates()


@query("agg_04_null_counts", with_tables(f"""
WITH {ZONED_SQL}
SELECT count(*) - count(order_key) AS order_key, count(*) - count(payment_type) AS payment_type,
       count(*) - count(pickup_service_zone) AS pickup_service_zone,
       count(*) - count(dropoff_service_zone) AS dropoff_service_zone
FROM zoned""", "trips", "zones"))
def agg_04(spark, sf):
    df = zoned_trips(spark, sf, "order_key", "payment_type")
    return null_counts(
        df.select("order_key", "payment_type", "pickup_service_zone", "dropoff_service_zone")
    )


@query("agg_05_null_percentage", """
SELECT count(*) AS rows, count(*) - count(quality) AS nulls,
       round((count(*) - count(quality)) * 100.0 / count(*), 6) AS percentage
FROM documents LEFT JOIN labels USING (doc_id)""")
def agg_05(spark, sf):
    documents = tv.read(spark, sf, "documents").select("doc_id")
    joined = documents.join(tv.read(spark, sf, "labels"), "doc_id", "left")
    return rounded(null_percentage(joined, "quality"), 6, "percentage")


@query("agg_06_value_counts", """
SELECT l_quantity, count(*) AS count FROM lineitem GROUP BY 1""")
def agg_06(spark, sf):
    return value_counts(tv.read(spark, sf, "lineitem"), "l_quantity")


_ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]


@query("agg_07_value_counts_all_columns", "\nUNION ALL\n".join(
    f'SELECT \'{c}\' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count '
    "FROM orders GROUP BY 2" for c in _ORDER_COLUMNS))
def agg_07(spark, sf):
    return value_counts_all(tv.read(spark, sf, "orders"))


def _describe_sql(columns, source, text=()):
    parts = []
    for c in columns:
        if c in text:
            stats = (f"NULL AS mean, NULL AS stddev, NULL AS min, NULL AS max, "
                     f"min({c}) AS min_text, max({c}) AS max_text")
        else:
            stats = (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
                     f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
                     "NULL AS min_text, NULL AS max_text")
        parts.append(f"SELECT '{c}' AS \"column\", count({c}) AS count, {stats} FROM {source}")
    return "\nUNION ALL\n".join(parts)


@query("agg_08_describe", _describe_sql(
    ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"], "lineitem",
    ["l_returnflag"]))
def agg_08(spark, sf):
    found = describe(
        tv.read(spark, sf, "lineitem"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    )
    return rounded(found, 4, "mean", "stddev")


@query("agg_09_chosen_statistics", with_tables("""
SELECT count(temp) AS count, round(avg(temp), 6) AS mean, round(stddev_samp(temp), 6) AS stddev,
       CAST(min(temp) AS DOUBLE) AS min, CAST(max(temp) AS DOUBLE) AS max
FROM event_rows""", "event_rows"))
def agg_09(spark, sf):
    found = describe(tv.events(spark, sf), "temp")
    return rounded(found, 6, "mean", "stddev").select("count", "mean", "stddev", "min", "max")


def _moments_sql(column, source):
    central = f"avg({{}}) FROM {source}, (SELECT avg({column}) AS mu FROM {source})"
    power = f"({column} - mu)"
    return (
        f"SELECT '{column}' AS \"column\", round(m3 / m2 ** 1.5, 6) AS skewness, "
        f"round(m4 / m2 ** 2 - 3, 6) AS kurtosis FROM ("
        f"SELECT avg({power} ** 2) AS m2, avg({power} ** 3) AS m3, "
        + central.format(f"{power} ** 4").replace(" FROM", " AS m4 FROM", 1) + ")"
    )


@query("agg_10_moments",
       _moments_sql("l_extendedprice", "lineitem") + "\nUNION ALL\n"
       + _moments_sql("l_quantity", "lineitem"))
def agg_10(spark, sf):
    found = moments(tv.read(spark, sf, "lineitem"), "l_extendedprice", "l_quantity")
    return rounded(found, 6, "skewness", "kurtosis")


# stored summaries ---------------------------------------------------------

_SUMMED = ("l_extendedprice", "l_quantity", "l_discount")
_COUNTED = ("l_returnflag", "l_linestatus")


def _monthly_summaries(spark, sf, numbers=(), codes=()):
    """Summaries by month of shipping, stored in two arrivals; the folder."""
    lines = tv.read(spark, sf, "lineitem").withColumn(
        "month", F.coalesce(F.date_format("l_shipdate", "yyyyMM"), F.lit("none")))
    folder = scratch(spark, "summaries")
    early = F.col("month") < "199512"
    for arrived in (early, ~early):
        summaries.store_parts(lines.filter(arrived), folder, "month", numbers, codes)
    return folder


def _summary_sql(column):
    return f"""
SELECT '{column}' AS "column", count(*) AS rows, count({column}) AS values, round(avg({column}), 6) AS mean,
       round(stddev_samp({column}), 6) AS stddev,
       round(avg(pow({column} - mu, 3)) / pow(var_pop({column}), 1.5), 6) AS skewness,
       round(avg(pow({column} - mu, 4)) / pow(var_pop({column}), 2) - 3, 6) AS kurtosis,
       min({column}) AS min, max({column}) AS max
FROM lineitem, (SELECT avg({column}) AS mu FROM lineitem)"""


@query("agg_08_stored_summaries", "\nUNION ALL\n".join(map(_summary_sql, _SUMMED)))
def agg_08_stored(spark, sf):
    """All rows described from summaries of their months."""
    found = summaries.merged_numbers(spark, _monthly_summaries(spark, sf, numbers=_SUMMED))
    return rounded(found, 6, "mean", "stddev", "skewness", "kurtosis").drop("quantiles", "distinct")


@query("agg_07_stored_value_counts", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS count FROM lineitem GROUP BY 2""" for c in _COUNTED))
def agg_07_stored(spark, sf):
    """Value counts of all rows from those of their months."""
    return summaries.merged_codes(spark, _monthly_summaries(spark, sf, codes=_COUNTED))


# quantiles ----------------------------------------------------------------


@query("agg_11_quartile_bounds", f"""
WITH {BOUNDS_SQL}
SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, round(upper, 6) AS upper
FROM bounds""")
def agg_11(spark, sf):
    return rounded(
        iqr_bounds(tv.read(spark, sf, "events"), "value"), 6, "q1", "q3", "lower", "upper"
    )


@query("agg_12_cap_at_upper_bound", f"""
WITH {BOUNDS_SQL}
SELECT event_id, round(CASE WHEN value > upper THEN upper ELSE value END, 6) AS value
FROM events, bounds""")
def agg_12(spark, sf):
    rows = tv.read(spark, sf, "events").select("event_id", "value")
    return rounded(cap_upper(rows, "value", iqr_bounds(rows, "value")), 6, "value")


# counts by calendar and category ------------------------------------------


def _calendar_trips(spark, sf):
    ts = "pickup_datetime"
    return tv.trips(spark, sf, ts).select(
        date_text(ts).alias("pickup_date"),
        time_text(ts).alias("pickup_time"),
        F.month(ts).alias("pickup_month"),
        F.hour(ts).alias("pickup_hour"),
        F.dayofweek(ts).alias("pickup_day_of_week"),
    )


CALENDAR_SQL = """
calendar AS (
  SELECT *, strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date,
         strftime(pickup_datetime, '%H:%M:%S') AS pickup_time,
         CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
         CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week
  FROM trips)"""


def _by_calendar(name, key):
    @query(name, with_tables(f"""
WITH {CALENDAR_SQL}
SELECT {key}, count(*) AS count FROM calendar GROUP BY 1""", "trips"))
    def run(spark, sf):
        return counts_in_order(_calendar_trips(spark, sf), key)


_by_calendar("agg_13_counts_by_date", "pickup_date")
_by_calendar("agg_13_counts_by_month", "pickup_month")
_by_calendar("agg_13_counts_by_hour", "pickup_hour")
_by_calendar("agg_13_counts_by_weekday", "pickup_day_of_week")


@query("agg_14_peak_times", with_tables(f"""
WITH {CALENDAR_SQL}
SELECT pickup_time, count(*) AS count FROM calendar GROUP BY 1""", "trips"))
def agg_14(spark, sf):
    return value_counts(_calendar_trips(spark, sf), "pickup_time")


@query("agg_15_counts_by_category", with_tables("""
SELECT payment_type, count(*) AS count FROM trips GROUP BY 1""", "trips"))
def agg_15(spark, sf):
    return counts_in_order(tv.trips(spark, sf, "payment_type"), "payment_type")


@query("agg_16_counts_by_two_keys", with_tables(f"""
WITH {CALENDAR_SQL}
SELECT pickup_hour, pickup_day_of_week, count(*) AS count FROM calendar GROUP BY 1, 2""",
    "trips"))
def agg_16(spark, sf):
    return counts_in_order(_calendar_trips(spark, sf), "pickup_hour", "pickup_day_of_week")


@query("agg_17_count_of_ids_by_borough", with_tables(f"""
WITH {ZONED_SQL}
SELECT pickup_service_zone, pickup_borough, count(PULocationID) AS pickup_count
FROM zoned GROUP BY 1, 2""", "trips", "zones"))
def agg_17(spark, sf):
    by_id = tv.trips(spark, sf, "PULocationID").groupBy("PULocationID").agg(
        F.count("PULocationID").alias("n")
    )
    named = zoned(by_id, stored_zones(spark, sf), "pickup")
    return named.groupBy("pickup_service_zone", "pickup_borough").agg(
        F.sum("n").alias("pickup_count")
    )


@query("agg_18_count_by_borough", with_tables(f"""
WITH {ZONED_SQL}
SELECT dropoff_borough, count(*) AS dropoff_count FROM zoned GROUP BY 1""", "trips", "zones"))
def agg_18(spark, sf):
    return counts_by_borough(
        spark, sf, "dropoff", "dropoff_count", "dropoff_borough"
    ).orderBy("dropoff_borough")


def _mean_by(name, key):
    @query(name, with_tables(f"""
WITH {CALENDAR_SQL}
SELECT {key}, round(avg(fare_amount), 4) AS average_fare FROM calendar GROUP BY 1""", "trips"))
    def run(spark, sf):
        ts = "pickup_datetime"
        df = tv.trips(spark, sf, ts, "payment_type", "fare_amount").withColumns({
            "pickup_hour": F.hour(ts), "pickup_month": F.month(ts),
            "pickup_day_of_week": F.dayofweek(ts),
        })
        return df.groupBy(key).agg(
            F.round(F.avg("fare_amount"), 4).alias("average_fare")
        ).orderBy(key)


_mean_by("agg_19_mean_by_hour", "pickup_hour")
_mean_by("agg_19_mean_by_weekday", "pickup_day_of_week")
_mean_by("agg_19_mean_by_month", "pickup_month")
_mean_by("agg_19_mean_by_payment", "payment_type")


@query("agg_20_mean_and_median_by_key", with_tables(f"""
WITH {ZONED_SQL}
SELECT pickup_borough, round(avg(fare_amount), 4) AS avg_fare,
       quantile_disc(fare_amount, 0.5) AS median_fare
FROM zoned GROUP BY 1""", "trips", "zones"))
def agg_20(spark, sf):
    df = materialise(
        zoned_trips(spark, sf, "fare_amount", roles=["pickup"])
        .select("pickup_borough", "fare_amount")
    )
    means = df.groupBy("pickup_borough").agg(F.round(F.avg("fare_amount"), 4).alias("avg_fare"))
    medians = exact_quantiles(
        df, "fare_amount", {"median_fare": 0.5}, ["pickup_borough"], interpolate=False
    )
    return join_groups(means, medians, ["pickup_borough"])


@query("agg_20_mean_and_sketched_median_by_key")
def agg_20_sketch(spark, sf):
    df = zoned_trips(spark, sf, "fare_amount", roles=["pickup"])
    return df.groupBy("pickup_borough").agg(
        F.round(F.avg("fare_amount"), 4).alias("avg_fare"),
        F.percentile_approx("fare_amount", 0.5).alias("median_fare"),
    )


@query("agg_21_median_by_two_keys", with_tables(f"""
WITH {ZONED_SQL}
SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, pickup_borough,
       quantile_disc(fare_amount, 0.5) AS median_fare
FROM zoned GROUP BY 1, 2""", "trips", "zones"))
def agg_21(spark, sf):
    df = materialise(zoned_trips(spark, sf, "pickup_datetime", "fare_amount", roles=["pickup"]).select(
        F.hour("pickup_datetime").alias("pickup_hour"), "pickup_borough", "fare_amount"
    ))
    return exact_quantiles(
        df, "fare_amount", {"median_fare": 0.5}, ["pickup_hour", "pickup_borough"],
        interpolate=False,
    )


@query("agg_21_sketched_median_by_two_keys")
def agg_21_sketch(spark, sf):
    df = zoned_trips(spark, sf, "pickup_datetime", "fare_amount", roles=["pickup"]).withColumn(
        "pickup_hour", F.hour("pickup_datetime")
    )
    return sketch_quantiles(
        df, "fare_amount", {"median_fare": 0.5}, ["pickup_hour", "pickup_borough"]
    )


@query("agg_22_mean_median_sum_by_key", with_tables("""
SELECT payment_type, round(avg(fare_amount), 4) AS average_fare,
       round(median(fare_amount), 4) AS median_fare, round(sum(fare_amount), 2) AS total_fare
FROM trips GROUP BY 1""", "trips"))
def agg_22(spark, sf):
    df = materialise(tv.trips(spark, sf, "payment_type", "fare_amount"))
    sums = df.groupBy("payment_type").agg(
        F.round(F.avg("fare_amount"), 4).alias("average_fare"),
        F.round(F.sum("fare_amount"), 2).alias("total_fare"),
    )
    medians = exact_quantiles(df, "fare_amount", {"median_fare": 0.5}, ["payment_type"])
    return join_groups(sums, rounded(medians, 4, "median_fare"), ["payment_type"])


# shares -------------------------------------------------------------------


@query("agg_23_share_of_total", with_tables("""
SELECT CASE WHEN trip_distance <= 2 THEN 'Short' WHEN trip_distance <= 5 THEN 'Medium'
            ELSE 'Long' END AS distance_bin,
       count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM trips GROUP BY 1""", "trips"))
def agg_23(spark, sf):
    df = tv.trips(spark, sf, "trip_distance").withColumn("distance_bin", distance_bin())
    return rounded(share(df, "distance_bin"), 6, "percentage")


@query("agg_23_share_of_labels", with_tables("""
SELECT payment_type_label, count(*) AS count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM (SELECT CASE payment_type WHEN '1' THEN 'Credit Card' WHEN '2' THEN 'Cash'
  WHEN '3' THEN 'No Charge' WHEN '4' THEN 'Dispute' WHEN '5' THEN 'Unknown' END
  AS payment_type_label FROM trips) GROUP BY 1""", "trips"))
def agg_23_labels(spark, sf):
    df = tv.trips(spark, sf, "payment_type").withColumn(
        "payment_type_label", code_label(F.col("payment_type"))
    )
    return rounded(share(df, "payment_type_label"), 6, "percentage")


@query("agg_24_share_in_id_set", with_tables("""
SELECT round(count(*) FILTER (WHERE PULocationID IN (3, 7, 11)) * 100.0 / count(*), 6)
         AS PULocationID_percentage,
       round(count(*) FILTER (WHERE DOLocationID IN (3, 7, 11)) * 100.0 / count(*), 6)
         AS DOLocationID_percentage
FROM trips""", "trips"))
def agg_24(spark, sf):
    keys = ["PULocationID", "DOLocationID"]
    found = share_in_set(tv.trips(spark, sf, *keys), keys, [3, 7, 11])
    return rounded(found, 6, *found.columns)


@query("agg_25_mean_by_bucket", with_tables("""
SELECT floor(temp / 5.0) * 5 AS temp_range, round(avg(value), 6) AS avg_value
FROM event_rows GROUP BY 1""", "event_rows"))
def agg_25(spark, sf):
    found = bucket_mean(
        tv.events(spark, sf), width_bucket_floor("temp", 5), "temp_range", "value", "avg_value"
    )
    return rounded(found, 6, "avg_value").withColumn("temp_range", F.col("temp_range").cast("double"))


@query("agg_26_frequency_bins", with_tables("""
SELECT CASE WHEN trip_distance < 2 THEN '0-2 miles' WHEN trip_distance < 5 THEN '2-5 miles'
            WHEN trip_distance < 10 THEN '5-10 miles' WHEN trip_distance < 20 THEN '10-20 miles'
            WHEN trip_distance >= 20 THEN '20+ miles' END AS trip_distance_bin,
       count(*) AS count
FROM trips GROUP BY 1""", "trips"))
def agg_26(spark, sf):
    df = tv.trips(spark, sf, "trip_distance").withColumn(
        "trip_distance_bin", cut_bin("trip_distance", DISTANCE_CUTS, DISTANCE_LABELS)
    )
    return value_counts(df, "trip_distance_bin")


@query("agg_26_fare_frequency_bins", """
SELECT CASE WHEN l_extendedprice < 10 THEN '$0-10' WHEN l_extendedprice < 20 THEN '$10-20'
            WHEN l_extendedprice < 50 THEN '$20-50' WHEN l_extendedprice < 100 THEN '$50-100'
            WHEN l_extendedprice >= 100 THEN '$100+' END AS fare_bin,
       count(*) AS count
FROM lineitem GROUP BY 1""")
def agg_26_fares(spark, sf):
    df = tv.trips(spark, sf, "fare_amount").withColumn(
        "fare_bin", cut_bin("fare_amount", FARE_CUTS, FARE_LABELS)
    )
    return value_counts(df, "fare_bin")


@query("agg_27_category_ladder", with_tables("""
SELECT CASE WHEN trip_distance > 20 THEN 'Very High (>20 miles)'
            WHEN trip_distance >= 10 THEN 'High (10-20 miles)'
            WHEN trip_distance >= 5 THEN 'Average (5-10 miles)'
            WHEN trip_distance > 1 THEN 'Low (1-5 miles)'
            ELSE 'Very Low (<1 miles)' END AS distance_category, count(*) AS count
FROM trips GROUP BY 1""", "trips"))
def agg_27(spark, sf):
    df = tv.trips(spark, sf, "trip_distance").withColumn(
        "distance_category", distance_category()
    )
    return df.groupBy("distance_category").count()


@query("agg_28_distinct_counts", """
SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey,
       count(DISTINCT l_returnflag) AS l_returnflag
FROM lineitem""")
def agg_28(spark, sf):
    return distinct_counts(
        tv.read(spark, sf, "lineitem"), "l_partkey", "l_suppkey", "l_returnflag"
    )


@query("agg_28_distinct_sorted", "SELECT DISTINCT event_type FROM events")
def agg_28_sorted(spark, sf):
    return tv.read(spark, sf, "events").select("event_type").distinct().orderBy("event_type")


# feature statistics -------------------------------------------------------

MEASURES = ["fare_amount", "tolls_amount", "total_amount", "trip_duration", "passenger_count"]


@query("agg_29_select_by_variance", with_tables("""
SELECT feature, round(variance, 2) AS variance FROM (
  SELECT 'fare_amount' AS feature, var_samp(fare_amount) AS variance FROM trips
  UNION ALL SELECT 'improvement_surcharge', var_samp(improvement_surcharge) FROM trips
  UNION ALL SELECT 'passenger_count', var_samp(passenger_count) FROM trips)
WHERE variance > 0.05""", "trips"))
def agg_29(spark, sf):
    names = ["fare_amount", "improvement_surcharge", "passenger_count"]
    return rounded(
        select_by_variance(tv.trips(spark, sf, *names), names, 0.05), 2, "variance"
    )


@query("agg_30_correlation_with_target", with_tables(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, total_amount), 6) AS correlation FROM trips"
    for c in MEASURES if c != "total_amount"), "trips"))
def agg_30(spark, sf):
    names = [c for c in MEASURES if c != "total_amount"]
    return rounded(
        correlations_with(tv.trips(spark, sf, *MEASURES), names, "total_amount"),
        6, "correlation",
    )


@query("agg_31_correlation_matrix", with_tables(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM trips"
    for a in MEASURES for b in MEASURES), "trips"))
def agg_31(spark, sf):
    return rounded(correlation_matrix(tv.trips(spark, sf, *MEASURES), MEASURES), 6, "corr")


_CATEGORIES = ["payment_type", "PULocationID", "DOLocationID", "passenger_count"]


@query("agg_32_mean_target_per_category", with_tables(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS category, "
    f"round(avg(total_amount), 4) AS mean_target FROM trips GROUP BY 2"
    for c in _CATEGORIES), "trips"))
def agg_32(spark, sf):
    found = category_target_means(
        tv.trips(spark, sf, *_CATEGORIES, "total_amount"), _CATEGORIES, "total_amount"
    )
    return rounded(found, 4, "mean_target")


@query("agg_33_normalised_scores", with_tables("""
WITH s AS (
  SELECT 'fare_amount' AS feature, abs(corr(fare_amount, total_amount)) AS score FROM trips
  UNION ALL SELECT 'tolls_amount', abs(corr(tolls_amount, total_amount)) FROM trips
  UNION ALL SELECT 'passenger_count', abs(corr(passenger_count, total_amount)) FROM trips)
SELECT feature, round(score / sum(score) OVER (), 6) AS score FROM s""", "trips"))
def agg_33(spark, sf):
    names = ["fare_amount", "tolls_amount", "passenger_count"]
    scores = correlations_with(
        tv.trips(spark, sf, *names, "total_amount"), names, "total_amount"
    ).select("feature", F.abs("correlation").alias("score"))
    return rounded(normalise(scores, "score"), 6, "score")


def _anova_sql(columns):
    return "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, k - 1 AS df_between, CAST(total AS BIGINT) - k AS df_within,
       round((ssb / (k - 1)) / (ssw / (total - k)), 4) AS f_statistic
FROM (SELECT count(*) AS k, sum(n) AS total, sum(n * (m - grand) ** 2) AS ssb,
             sum(n * v) AS ssw
      FROM (SELECT count(*) AS n, avg(total_amount) AS m, var_pop(total_amount) AS v
            FROM trips WHERE {c} IS NOT NULL AND total_amount IS NOT NULL GROUP BY {c}),
           (SELECT avg(total_amount) AS grand FROM trips WHERE {c} IS NOT NULL))""" for c in columns)


@query("sta_02_one_way_anova", with_tables(_anova_sql(["payment_type", "DOLocationID"]), "trips"))
def sta_02(spark, sf):
    columns = ["payment_type", "DOLocationID"]
    found = anova(tv.trips(spark, sf, *columns, "total_amount"), columns, "total_amount")
    return rounded(found.drop("p_value"), 4, "f_statistic")


@query("sta_02_tail_of_the_variance_test", with_tables(f"""
WITH tested AS ({_anova_sql(["payment_type"]).replace("round(", "(").replace(", 4) AS f_statistic", ") AS f_statistic")}),
x AS (SELECT *, df_within / (df_within + df_between * f_statistic) AS x, df_within / 2 AS b FROM tested)
SELECT feature, round(list_sum(list_transform(range(df_between // 2), lambda i:
         exp(b * ln(x) + lgamma(b + i) - lgamma(b) - lgamma(i + 1) + i * ln(1 - x)))), 6) AS p_value
FROM x""", "trips"))
def sta_02_tail(spark, sf):
    """Five codes, so the upper degrees of freedom are even and the tail is a finite sum."""
    found = anova(tv.trips(spark, sf, "payment_type", "total_amount"), ["payment_type"], "total_amount")
    return rounded(found.select("feature", "p_value"), 6, "p_value")


# pivots and plot data -----------------------------------------------------


@query("agg_35_pivot_counts", with_tables("""
SELECT passenger_count,
       count(*) FILTER (WHERE payment_type = '1') AS "1",
       count(*) FILTER (WHERE payment_type = '2') AS "2",
       count(*) FILTER (WHERE payment_type = '3') AS "3",
       count(*) FILTER (WHERE payment_type = '4') AS "4",
       count(*) FILTER (WHERE payment_type = '5') AS "5"
FROM trips GROUP BY 1""", "trips"))
def agg_35(spark, sf):
    return pivot_counts(
        tv.trips(spark, sf, "passenger_count", "payment_type"),
        "passenger_count", "payment_type", ["1", "2", "3", "4", "5"], missing=0,
    )


def _histogram_sql(source, column, bins, by=""):
    keys = f"{by}, " if by else ""
    return f"""
SELECT {keys}CAST(least(floor(({column} - low) / ((high - low) / {bins})), {bins - 1}) AS INTEGER)
         AS bin, count(*) AS count, min((high - low) / {bins}) AS width, min(low) AS low
FROM {source}, (SELECT min({column}) AS low, max({column}) AS high FROM {source})
GROUP BY ALL"""


@query("agg_36_histogram", f"""
WITH counted AS ({_histogram_sql("lineitem", "l_extendedprice", 50)}),
edges AS (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem)
SELECT CAST(b AS INTEGER) AS bin, coalesce(count, 0) AS count,
       round(e.low + b * ((high - e.low) / 50), 4) AS bin_start,
       round(e.low + (b + 1) * ((high - e.low) / 50), 4) AS bin_end
FROM range(50) r(b), edges e LEFT JOIN counted c ON c.bin = b""")
def agg_36(spark, sf):
    found = histogram(tv.read(spark, sf, "lineitem"), "l_extendedprice", 50)
    return rounded(found, 4, "bin_start", "bin_end")


@query("agg_37_box_numbers_by_group", """
WITH q AS (
  SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS median,
         quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
inside AS (
  SELECT q.*, value, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
  FROM events e JOIN q ON e.event_type IS NOT DISTINCT FROM q.event_type
  WHERE value IS NOT NULL)
SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(value) FILTER (WHERE ok) AS whisker_low, max(value) FILTER (WHERE ok) AS whisker_high,
       count(*) FILTER (WHERE NOT ok) AS outliers, count(*) AS count
FROM inside GROUP BY event_type, q1, median, q3""")
def agg_37(spark, sf):
    found = box_numbers(tv.read(spark, sf, "events"), "value", ["event_type"])
    return rounded(found, 6, "q1", "median", "q3")


@query("agg_37_box_numbers", """
WITH q AS (
  SELECT quantile_cont(l_extendedprice, 0.25) AS q1, median(l_extendedprice) AS median,
         quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
inside AS (
  SELECT q.*, l_extendedprice AS v,
         v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM lineitem, q)
SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(v) FILTER (WHERE ok) AS whisker_low, max(v) FILTER (WHERE ok) AS whisker_high,
       count(*) FILTER (WHERE NOT ok) AS outliers, count(*) AS count
FROM inside GROUP BY q1, median, q3""")
def agg_37_all(spark, sf):
    found = box_numbers(tv.read(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(found, 6, "q1", "median", "q3")


@query("agg_38_compare_distributions", f"""
WITH sampled AS (SELECT * FROM lineitem WHERE {BUCKET_SQL} < 5),
tagged AS (SELECT 'Original' AS source, l_extendedprice AS v FROM lineitem
           UNION ALL SELECT 'Sampled', l_extendedprice FROM sampled),
counted AS ({_histogram_sql("tagged", "v", 30, "source")}),
edges AS (SELECT (max(v) - min(v)) / 30 AS width FROM tagged),
bins AS (
  SELECT s.source, CAST(b AS INTEGER) AS bin, coalesce(count, 0) AS count, e.width
  FROM range(30) r(b), edges e, (VALUES ('Original'), ('Sampled')) s(source)
  LEFT JOIN counted c ON c.bin = b AND c.source = s.source)
SELECT source, bin, count, round(count / sum(count) OVER (PARTITION BY source), 6) AS share,
       round(count / sum(count) OVER (PARTITION BY source) / width, 10) AS density
FROM bins""")
def agg_38(spark, sf):
    lines = tv.read(spark, sf, "lineitem")
    sampled = hash_sample(lines, 5, "l_orderkey", "l_linenumber")
    found = compare_distributions(lines, sampled, "l_extendedprice", 30)
    return found.select(
        "source", "bin", "count", F.round("share", 6).alias("share"),
        F.round("density", 10).alias("density"),
    )


# windows, sorts, top-k, sets ----------------------------------------------


@query("win_01_percentage_of_grand_total", with_tables("""
SELECT payment_type, count(*) AS trip_count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM trips GROUP BY 1""", "trips"))
def win_01(spark, sf):
    found = share(tv.trips(spark, sf, "payment_type"), "payment_type", count="trip_count")
    return rounded(found, 6, "percentage").orderBy(F.desc("trip_count"))


@query("srt_01_order_by_two_keys", """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem
GROUP BY 1, 2 ORDER BY 1, 2""")
def srt_01(spark, sf):
    return counts_in_order(tv.read(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("top_01_pickup_zones", with_tables(f"""
WITH {ZONED_SQL}
SELECT pickup_zone, count(*) AS count FROM zoned GROUP BY 1
ORDER BY count DESC, pickup_zone LIMIT 10""", "trips", "zones"))
def top_01(spark, sf):
    by_id = tv.trips(spark, sf, "PULocationID").groupBy("PULocationID").agg(F.count("*").alias("n"))
    named = zoned(by_id, stored_zones(spark, sf), "pickup", names={"Zone": "zone"})
    counts = named.groupBy("pickup_zone").agg(F.sum("n").alias("count"))
    return counts.orderBy(F.desc("count"), "pickup_zone").limit(10)


@query("top_02_zone_pairs", with_tables(f"""
WITH {ZONED_SQL}
SELECT pickup_zone, dropoff_zone, count(*) AS count FROM zoned GROUP BY 1, 2
ORDER BY count DESC, pickup_zone, dropoff_zone LIMIT 10""", "trips", "zones"))
def top_02(spark, sf):
    return top_k(zoned_trips(spark, sf), 10, "pickup_zone", "dropoff_zone")


@query("set_01_union_all_by_name", """
SELECT 'customer' AS kind, c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""")
def set_01(spark, sf):
    customers = tv.read(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = tv.read(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"),
        F.col("s_nationkey").alias("nation"),
    )
    return customers.unionByName(suppliers)


@query("set_02_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set_02(spark, sf):
    return tv.read(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
