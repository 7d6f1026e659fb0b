"""Queries over stages laid out by month or by key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine.plans import tripview as tv
from tripengine.plans.registry import query
from tripengine.plans.tripview import with_tables
from tripengine.session import materialise, scratch, shuffle_partitions
from tripengine.sources.files import read_stage
from tripengine.sources.stages import during, on_days, read_bucketed_stage, write_bucketed_stage, write_monthly_stage

# The part of the calendar asked for; fixed for the queries below.
FIRST_DAY, LAST_DAY = "1995-03-15", "1995-07-04"
CALENDAR_FROM, CALENDAR_TO = "1994-07-01", "1996-11-30"


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "monthly")
    trips = tv.trips(spark, sf, "order_key", "line_number", "pickup_datetime", "fare_amount")
    write_monthly_stage(trips, path, "pickup_datetime", "parquet")
    return read_stage(spark, path, "parquet")


@query("flt_06_dates_of_monthly_stage", with_tables(f"""
SELECT order_key, line_number, fare_amount FROM trips
WHERE pickup_datetime >= DATE '{FIRST_DAY}' AND pickup_datetime < DATE '{LAST_DAY}' + INTERVAL 1 DAY""", "trips"))
def flt_06_monthly(spark, sf):
    return during(_monthly(spark, sf), "pickup_datetime", FIRST_DAY, LAST_DAY).select(
        "order_key", "line_number", "fare_amount")


@query("join_03_holidays_of_monthly_stage", with_tables(f"""
SELECT holiday, h.day AS day, count(*) AS trips, round(sum(CAST(fare_amount AS DOUBLE)), 2) AS fares
FROM trips JOIN (
  SELECT CAST(date AS DATE) AS day, min(holidayName) AS holiday FROM holidays
  WHERE date >= DATE '{CALENDAR_FROM}' AND date <= DATE '{CALENDAR_TO}' GROUP BY 1) h
ON CAST(pickup_datetime AS DATE) = h.day GROUP BY 1, 2""", "trips", "holidays"))
def join_03_monthly(spark, sf):
    days = tv.holidays(spark, sf).groupBy(F.to_date("date").alias("day")).agg(F.min("holidayName").alias("holiday"))
    days = materialise(days, "days").where(F.col("day").between(CALENDAR_FROM, CALENDAR_TO))
    return on_days(_monthly(spark, sf), days, "pickup_datetime", "day").groupBy("holiday", "day").agg(
        F.count("*").alias("trips"), F.round(F.sum(F.col("fare_amount").cast("double")), 2).alias("fares"))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    spark, name = df.sparkSession, f"stage_{uuid.uuid4().hex}"
    write_bucketed_stage(df, name, scratch(spark, "bucketed"), ["order_key"], buckets)
    return read_bucketed_stage(spark, name, keep_name=False)


@query("snk_01_bucketed_stages", """
SELECT o_orderkey AS order_key, o_orderpriority AS priority, count(l_orderkey) AS lines,
       round(coalesce(sum(CAST(l_extendedprice AS DOUBLE)), 0), 2) AS fares
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def snk_01_bucketed(spark, sf):
    lines = tv.read(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("order_key"), F.col("l_extendedprice").cast("double").alias("fare"))
    orders = tv.read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("long").alias("order_key"), F.col("o_orderpriority").alias("priority"))
    buckets = shuffle_partitions(spark)  # after both tables are counted, the same for both
    lines, orders = _bucketed(lines, buckets), _bucketed(orders, buckets)
    return orders.join(lines.withColumn("line", F.lit(1)), "order_key", "left").groupBy("order_key", "priority").agg(
        F.count("line").alias("lines"), F.round(F.coalesce(F.sum("fare"), F.lit(0.0)), 2).alias("fares"))
