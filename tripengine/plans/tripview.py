"""Trips, zones, centroids, holidays and weather out of the star schema.

``SQL`` holds the same tables as common table expressions for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine import schemas
from tripengine.session import add_input

DAY_SECONDS = 86_400

# The column a role is read from decides which tables are joined.
_FROM_ORDERS = {"pickup_datetime", "payment_type", "trip_duration", "PULocationID"}
_FROM_CUSTOMER = {"PULocationID"}
_FROM_SUPPLIER = {"DOLocationID"}
_FROM_PART = {"trip_distance"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    add_input(spark, path)
    return spark.read.parquet(path)


def _moment(day: str, key: str, step: int):
    """A time of day spread over the day by a key."""
    return F.timestamp_seconds(F.unix_timestamp(day) + (F.col(key) * step) % DAY_SECONDS)


def trips(
    spark: SparkSession, sf_dir: str, *columns: str, lines: DataFrame | None = None
) -> DataFrame:
    """One row per line item in the trip roles, with only the joins needed.

    ``lines`` stands in for the line items, for example a stream of them.
    """
    wanted = set(columns)
    df = read(spark, sf_dir, "lineitem") if lines is None else lines
    if wanted & _FROM_ORDERS:
        orders = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
        if wanted & _FROM_CUSTOMER:
            # joined to the orders first, so that the lines are shuffled once for both
            customer = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
            orders = orders.join(customer, "o_custkey", "left")
        df = df.join(orders, "l_orderkey", "left")
    if wanted & _FROM_SUPPLIER:
        supplier = read(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
        df = df.join(supplier, "l_suppkey", "left")
    if wanted & _FROM_PART:
        part = read(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
        df = df.join(part, "l_partkey", "left")
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    pickup = _moment("o_orderdate", "l_orderkey", 7919)
    dropoff = _moment("l_shipdate", "l_partkey", 4133)
    roles = {
        "order_key": F.col("l_orderkey"),
        "line_number": F.col("l_linenumber"),
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        "PULocationID": F.col("c_nationkey"),
        "DOLocationID": F.col("s_nationkey"),
        "passenger_count": F.col("l_quantity").cast("int"),
        "trip_distance": F.col("p_size").cast("double"),
        "payment_type": F.substring("o_orderpriority", 1, 1),
        "fare_amount": price,
        "tolls_amount": price * discount,
        "improvement_surcharge": F.col("l_tax"),
        "total_amount": price * (1 - discount) * (1 + F.col("l_tax")),
        "trip_duration": (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / 60,
    }
    return df.select([roles[c].alias(c) for c in columns])


TRIP_COLUMNS = [
    "order_key", "line_number", "pickup_datetime", "dropoff_datetime", "PULocationID",
    "DOLocationID", "passenger_count", "trip_distance", "payment_type", "fare_amount",
    "tolls_amount", "improvement_surcharge", "total_amount", "trip_duration",
]


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips under the names and in the order of a monthly source file."""
    names = [c.replace("tpep_", "") for c in schemas.TRIP_RAW.names]
    return trips(spark, sf_dir, *names).toDF(*schemas.TRIP_RAW.names)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    region = read(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    service = (
        F.when(F.col("r_name") == "AFRICA", "Airports")
        .when(F.col("r_name") != "MIDDLE EAST", "Boro Zone")
    )
    return read(spark, sf_dir, "nation").join(region, "n_regionkey", "left").select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        service.alias("service_zone"),
    )


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of the zones; one borough is off the map and has none."""
    key = F.col("LocationID")
    return zones(spark, sf_dir).filter(F.col("Borough") != "MIDDLE EAST").select(
        "LocationID",
        (F.lit(40.5) + key * F.lit(0.02)).alias("latitude"),
        (F.lit(-74.1) + key * F.lit(0.015)).alias("longitude"),
    )


# Month and day of the holidays, the last two on one date.
HOLIDAYS = [
    ("01-01", "New Year's Day"),
    ("07-04", "Independence Day"),
    ("11-11", "Veterans Day"),
    ("12-25", "Christmas Day"),
    ("12-25", "Christmas Day (Observed)"),
]


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holidays among the order dates, and the same days of another country."""
    names = spark.createDataFrame(HOLIDAYS, "month_day string, holidayName string")
    days = read(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("date")).distinct()
    countries = F.explode(F.array(
        F.struct(F.lit("United States").alias("name"), F.lit("US").alias("code")),
        F.struct(F.lit("Canada").alias("name"), F.lit("CA").alias("code")),
    ))
    return (
        days.withColumn("month_day", F.date_format("date", "MM-dd"))
        .join(names, "month_day")
        .withColumn("country", countries)
        .select(
            F.col("country.name").alias("countryOrRegion"),
            "holidayName",
            F.regexp_replace("holidayName", r" \(Observed\)$", "").alias("normalizeHolidayName"),
            F.lit(None).cast("boolean").alias("isPaidTimeOff"),
            F.col("country.code").alias("countryRegionCode"),
            F.col("date").cast("timestamp").alias("date"),
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temperature per order date, out of whole numbers so that it is exact."""
    return (
        read(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("weather_date"))
        .agg((F.sum(F.col("o_custkey") % 52).cast("double") / F.count("*") - 8).alias("temp"))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the hour-bearing time and the number inside ``props``."""
    props = F.from_json("props", "k int")
    return read(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("pickup_datetime"), "user_id", "event_type", "value",
        props["k"].alias("temp"),
    )


SQL = {
    "trips": """
  SELECT *, (epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60 AS trip_duration
  FROM (
    SELECT l_orderkey AS order_key, l_linenumber AS line_number,
           o_orderdate + to_seconds((l_orderkey * 7919) % 86400) AS pickup_datetime,
           l_shipdate + to_seconds((l_partkey * 4133) % 86400) AS dropoff_datetime,
           c_nationkey AS PULocationID, s_nationkey AS DOLocationID,
           CAST(l_quantity AS INTEGER) AS passenger_count,
           CAST(p_size AS DOUBLE) AS trip_distance,
           left(o_orderpriority, 1) AS payment_type,
           l_extendedprice AS fare_amount,
           l_extendedprice * l_discount AS tolls_amount,
           l_tax AS improvement_surcharge,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount
    FROM lineitem
    LEFT JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN part ON p_partkey = l_partkey)""",
    "zones": """
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
         CASE WHEN r_name = 'AFRICA' THEN 'Airports'
              WHEN r_name <> 'MIDDLE EAST' THEN 'Boro Zone' END AS service_zone
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
    "centroids": """
  SELECT n_nationkey AS LocationID,
         CAST(40.5 AS DOUBLE) + n_nationkey * CAST(0.02 AS DOUBLE) AS latitude,
         CAST(-74.1 AS DOUBLE) + n_nationkey * CAST(0.015 AS DOUBLE) AS longitude
  FROM nation JOIN region ON r_regionkey = n_regionkey
  WHERE r_name <> 'MIDDLE EAST'""",
    "holiday_list": """
  SELECT * FROM (VALUES ('01-01', 'New Year''s Day'), ('07-04', 'Independence Day'),
    ('11-11', 'Veterans Day'), ('12-25', 'Christmas Day'),
    ('12-25', 'Christmas Day (Observed)')) v(month_day, holidayName)""",
    "holidays": """
  SELECT c.name AS countryOrRegion, holidayName,
         replace(holidayName, ' (Observed)', '') AS normalizeHolidayName,
         c.code AS countryRegionCode, d.o_orderdate AS date
  FROM (SELECT DISTINCT o_orderdate FROM orders) d
  JOIN holiday_list ON month_day = strftime(d.o_orderdate, '%m-%d')
  CROSS JOIN (VALUES ('United States', 'US'), ('Canada', 'CA')) c(name, code)""",
    "weather": """
  SELECT CAST(o_orderdate AS DATE) AS weather_date,
         CAST(sum(o_custkey % 52) AS DOUBLE) / count(*) - 8 AS temp
  FROM orders GROUP BY 1""",
    "event_rows": """
  SELECT event_id, ts AS pickup_datetime, user_id, event_type, value,
         CAST(props->>'k' AS INTEGER) AS temp
  FROM events""",
}

_NEEDS = {"holidays": ["holiday_list"]}


def with_tables(sql: str, *names: str) -> str:
    """Put the named common table expressions before a statement.

    A statement that itself starts with WITH goes on with its own ones.
    """
    order: list[str] = []
    for name in names:
        for need in [*_NEEDS.get(name, []), name]:
            if need not in order:
                order.append(need)
    head = ",\n".join(f"{name} AS ({SQL[name]})" for name in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
