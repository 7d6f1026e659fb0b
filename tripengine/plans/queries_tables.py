"""Queries on sources, sinks, projections, filters, nulls and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripengine import schemas
from tripengine.functions.calendar import in_year
from tripengine.functions.geo import inside_box
from tripengine.functions.labels import PAYMENT_LABELS
from tripengine.functions.predicates import above_up_to, any_null, in_none, positive
from tripengine.operators.clean import (
    conform,
    hash_sample,
    hash_split,
    null_sentinels,
    numeric_columns,
    round_half_even,
)
from tripengine.operators.joins import join_role, one_per_key
from tripengine.operators.models import metrics
from tripengine.operators.profile import correlation_scores, shape
from tripengine.operators.quantiles import iqr_bounds, outliers
from tripengine.plans import tripview as tv
from tripengine.plans.registry import query
from tripengine.plans.tripview import with_tables
from tripengine.session import materialise, scratch
from tripengine.sources.files import (
    lookup_table,
    monthly_paths,
    read_holidays,
    read_monthly,
    read_stage,
    read_weather,
    read_zone_lookup,
    result_table,
    write_stage,
)
from tripengine.sources.zones import polygon_centroids, ring_vertices, zone_attributes


def trip_sums():
    return [
        F.count("*").alias("n"),
        F.sum("passenger_count").alias("passengers"),
        F.round(F.sum("fare_amount"), 2).alias("fares"),
    ]


TRIP_SUMS_SQL = """count(*) AS n, CAST(sum(passenger_count) AS BIGINT) AS passengers,
  round(sum(fare_amount), 2) AS fares"""


# sources ------------------------------------------------------------------


@query("src_01_monthly_files", with_tables(f"""
SELECT strftime(pickup_datetime, '%m') AS month, {TRIP_SUMS_SQL},
       min(CAST(PULocationID AS INTEGER)) AS first_zone
FROM trips WHERE pickup_datetime IS NOT NULL GROUP BY 1""", "trips"))
def src_01(spark, sf):
    folder = scratch(spark, "monthly")
    named = F.concat(F.lit("trips_"), F.date_format("tpep_pickup_datetime", "MM"), F.lit(".parquet"))
    tv.raw_trips(spark, sf).withColumn("file", named).write.partitionBy("file").parquet(folder)
    trips = read_monthly(spark, monthly_paths(folder, "file=trips_{:02d}.parquet"))
    return trips.groupBy("month").agg(*trip_sums(), F.min("PULocationID").alias("first_zone"))


@query("src_02_zone_lookup_csv", with_tables("SELECT * FROM zones", "zones"))
def src_02(spark, sf):
    path = scratch(spark, "zones")
    tv.zones(spark, sf).fillna("N/A").write.csv(path, header=True)
    return read_zone_lookup(spark, path)


@query("src_03_stage_scan", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity
FROM lineitem GROUP BY ALL""")
def src_03(spark, sf):
    return read_stage(spark, f"{sf}/lineitem.parquet", "parquet").groupBy(
        "l_returnflag", "l_linestatus"
    ).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("src_04_weather_json", with_tables("""
SELECT strftime(weather_date, '%Y-%m-%d') AS weather_date, round(temp, 6) AS temp
FROM weather""", "weather"))
def src_04(spark, sf):
    path = scratch(spark, "weather")
    day = F.struct(F.col("weather_date").cast("string").alias("datetime"), "temp")
    # one document per month, so at most 31 days in an array
    tv.weather(spark, sf).groupBy(F.trunc("weather_date", "month").alias("month")).agg(
        F.collect_list(day).alias("days")
    ).select("days").write.json(path)
    return read_weather(spark, path, multi_line=False).select(
        F.col("weather_date").cast("string").alias("weather_date"),
        F.round("temp", 6).alias("temp"),
    )


@query("src_05_holidays_between", with_tables("""
SELECT countryOrRegion, holidayName, normalizeHolidayName, countryRegionCode,
       strftime(date, '%Y-%m-%d') AS date
FROM holidays WHERE date >= '1996-07-01' AND date < '1999-01-01'""", "holidays"))
def src_05(spark, sf):
    path = scratch(spark, "holidays")
    write_stage(tv.holidays(spark, sf), path, "parquet")
    found = read_holidays(read_stage(spark, path, "parquet"), "1996-07-01", "1998-12-31")
    return found.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


CORNERS_SQL = """
corners AS (
  SELECT c_custkey AS LocationID, c_nationkey AS cx, c_acctbal / 100 AS cy,
         1 + c_custkey % 7 AS w, 2 + c_custkey % 5 AS h FROM customer),
vertices AS (
  SELECT LocationID, 0 AS seq, cx AS x, cy AS y FROM corners
  UNION ALL SELECT LocationID, 1, cx + w, cy FROM corners
  UNION ALL SELECT LocationID, 2, cx + w + 1, cy + h FROM corners
  UNION ALL SELECT LocationID, 3, cx, cy + h FROM corners),
edges AS (
  SELECT LocationID, x, y,
         coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2,
         coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
  FROM vertices WINDOW w AS (PARTITION BY LocationID ORDER BY seq))"""


@query("src_06_polygon_centroids", f"""
WITH {CORNERS_SQL}
SELECT LocationID,
       round(sum((y + y2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)), 6) AS latitude,
       round(sum((x + x2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)), 6) AS longitude
FROM edges GROUP BY 1""")
def src_06(spark, sf):
    key = F.col("c_custkey")
    x = F.col("c_nationkey").cast("double")
    y = F.col("c_acctbal") / 100
    w, h = 1 + key % 7, 2 + key % 5

    def corner(seq, cx, cy):
        return F.struct(F.lit(seq).alias("seq"), cx.alias("x"), cy.alias("y"))

    corners = F.array(
        corner(0, x, y), corner(1, x + w, y), corner(2, x + w + 1, y + h), corner(3, x, y + h)
    )
    vertices = tv.read(spark, sf, "customer").select(
        key.alias("LocationID"), F.lit(0).alias("ring"), F.inline(corners)
    )
    return polygon_centroids(vertices).select(
        "LocationID",
        F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"),
    )


@query("src_07_zone_attributes", """
SELECT s_name AS zone, s_suppkey AS LocationID,
       CAST(s_suppkey % 80 + 1.5 AS DOUBLE) AS latitude,
       CAST(s_nationkey + 2 AS DOUBLE) AS longitude
FROM supplier""")
def src_07(spark, sf):
    x, y = F.col("s_nationkey"), F.col("s_suppkey") % 80
    ring = [(x, y), (x + 4, y), (x + 4, y + 3), (x, y + 3), (x, y)]
    points = F.concat_ws(", ", *[F.concat_ws(" ", px, py) for px, py in ring])
    zones = tv.read(spark, sf, "supplier").select(
        F.col("s_name").alias("zone"),
        F.col("s_suppkey").alias("LocationID"),
        F.concat(F.lit("POLYGON (("), points, F.lit("))")).alias("geometry"),
    )
    centroids = polygon_centroids(ring_vertices(zones))
    return zone_attributes(zones.join(centroids, "LocationID", "left")).withColumns({
        "latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6),
    })


@query("src_08_literal_lookup", with_tables("""
SELECT label, count(*) AS n FROM trips
LEFT JOIN (VALUES (1, 'Credit Card'), (2, 'Cash'), (3, 'No Charge'), (4, 'Dispute'),
                  (5, 'Unknown'), (6, 'Voided Trip')) v(code, label)
  ON code = CAST(payment_type AS INTEGER)
GROUP BY 1""", "trips"))
def src_08(spark, sf):
    labels = lookup_table(
        spark, PAYMENT_LABELS, schemas.table(code=schemas.INT, label=schemas.TEXT)
    )
    # counted per code first: a literal table has no known size, so the join shuffles
    counts = tv.trips(spark, sf, "payment_type").groupBy(
        F.col("payment_type").try_cast("int").alias("code")
    ).agg(F.count("*").alias("n"))
    return counts.join(labels, "code", "left").groupBy("label").agg(F.sum("n").alias("n"))


@query("src_09_result_rows", with_tables("""
SELECT 'fare only' AS model_name,
       round(1 - sum((total_amount - fare_amount) ** 2)
               / (var_pop(total_amount) * count(*)), 6) AS r2_score,
       round(avg(abs(total_amount - fare_amount)), 4) AS mae
FROM trips""", "trips"))
def src_09(spark, sf):
    found = metrics(
        tv.trips(spark, sf, "fare_amount", "total_amount"), "total_amount", "fare_amount"
    ).first()
    schema = schemas.table(model_name=schemas.TEXT, r2_score=schemas.DOUBLE, mae=schemas.DOUBLE)
    rows = [("fare only", round(found["r2"], 6), round(found["mae"], 4))]
    return result_table(spark, rows, schema)


@query("src_10_score_list", with_tables("""
SELECT feature, round(correlation_importance, 4) AS correlation_importance FROM (
  SELECT 'fare_amount' AS feature, abs(corr(fare_amount, total_amount))
    AS correlation_importance FROM trips
  UNION ALL SELECT 'passenger_count', abs(corr(passenger_count, total_amount)) FROM trips
  UNION ALL SELECT 'Mean total_amount for payment_type = ' || coalesce(payment_type, 'None'),
    abs(avg(total_amount)) FROM trips GROUP BY payment_type)""", "trips"))
def src_10(spark, sf):
    trips = tv.trips(spark, sf, "fare_amount", "passenger_count", "payment_type", "total_amount")
    scores = correlation_scores(
        trips, ["fare_amount", "passenger_count"], ["payment_type"], "total_amount"
    )
    return scores.withColumn(
        "correlation_importance", F.round("correlation_importance", 4))


# sinks --------------------------------------------------------------------


@query("snk_01_stage_round_trip", with_tables(f"""
SELECT CAST(PULocationID AS INTEGER) AS PULocationID, {TRIP_SUMS_SQL}
FROM trips GROUP BY 1""", "trips"))
def snk_01(spark, sf):
    path = scratch(spark, "stage")
    write_stage(
        tv.trips(spark, sf, "PULocationID", "passenger_count", "fare_amount"), path, "parquet"
    )
    return read_stage(spark, path, "parquet").groupBy("PULocationID").agg(*trip_sums())


@query("snk_02_stage_new_schema", with_tables("""
SELECT order_key, line_number, CAST(payment_type AS INTEGER) AS payment_type FROM trips""",
    "trips"))
def snk_02(spark, sf):
    path = scratch(spark, "stage")
    write_stage(tv.trips(spark, sf, "order_key", "fare_amount"), path, "parquet")
    trips = tv.trips(spark, sf, "order_key", "line_number", "payment_type")
    write_stage(
        trips.withColumn("payment_type", F.col("payment_type").cast("int")),
        path, "parquet", replace_schema=True,
    )
    return read_stage(spark, path, "parquet")


# projections --------------------------------------------------------------


@query("prj_01_select", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def prj_01(spark, sf):
    return tv.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@query("prj_02_conform", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
       CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice,
       TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority,
       CAST(o_custkey AS VARCHAR) AS o_custkey
FROM orders""")
def prj_02(spark, sf):
    target = schemas.table(
        o_orderkey=schemas.INT, o_totalprice=schemas.LONG, o_orderpriority=schemas.INT,
        o_custkey=schemas.TEXT,
    )
    return conform(tv.read(spark, sf, "orders"), target, lenient=True)


@query("prj_03_rename", """
SELECT s_suppkey AS LocationID, s_name AS Zone, s_nationkey, s_acctbal FROM supplier""")
def prj_03(spark, sf):
    return tv.read(spark, sf, "supplier").withColumnsRenamed(
        {"s_suppkey": "LocationID", "s_name": "Zone"}
    )


@query("prj_04_drop", "SELECT * EXCLUDE (p_name, p_type) FROM part")
def prj_04(spark, sf):
    return tv.read(spark, sf, "part").drop("p_name", "p_type")


@query("prj_05_drop_joined_key", """
SELECT customer.*, n_name, n_regionkey FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey""")
def prj_05(spark, sf):
    customer, nation = tv.read(spark, sf, "customer"), tv.read(spark, sf, "nation")
    return customer.join(
        nation, customer["c_nationkey"] == nation["n_nationkey"], "left"
    ).drop(nation["n_nationkey"])


@query("prj_06_file_lineage", """
SELECT 'events' AS origin, event_type, count(*) AS n FROM events GROUP BY event_type""")
def prj_06(spark, sf):
    origin = F.regexp_extract("_metadata.file_path", r"/([a-z]+)\.parquet", 1)
    return tv.read(spark, sf, "events").groupBy(origin.alias("origin"), "event_type").agg(
        F.count("*").alias("n")
    )


@query("prj_07_shape", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def prj_07(spark, sf):
    return shape(tv.read(spark, sf, "lineitem"))


@query("prj_08_round_half_even", """
SELECT l_orderkey, l_linenumber, round_even(l_extendedprice, 0) AS l_extendedprice,
       round_even(l_discount, 1) AS l_discount
FROM lineitem""")
def prj_08(spark, sf):
    return round_half_even(
        tv.read(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"
        ),
        {"l_extendedprice": 0, "l_discount": 1},
    )


@query("prj_09_numeric_columns", """
UNPIVOT (SELECT count(l_partkey) AS l_partkey, count(l_suppkey) AS l_suppkey,
  count(l_linenumber) AS l_linenumber, count(l_quantity) AS l_quantity,
  count(l_extendedprice) AS l_extendedprice, count(l_discount) AS l_discount,
  count(l_tax) AS l_tax FROM lineitem)
ON COLUMNS(*) INTO NAME feature VALUE n""")
def prj_09(spark, sf):
    lines = tv.read(spark, sf, "lineitem")
    names = numeric_columns(lines, without=["l_orderkey"])
    return lines.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n")


# filters ------------------------------------------------------------------


@query("flt_01_positive", with_tables("""
SELECT order_key, line_number, trip_duration FROM trips WHERE trip_duration > 0""", "trips"))
def flt_01(spark, sf):
    return tv.trips(spark, sf, "order_key", "line_number", "trip_duration").filter(
        positive("trip_duration")
    )


@query("flt_02_range", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_quantity > 0 AND l_quantity <= 6""")
def flt_02(spark, sf):
    return tv.read(spark, sf, "lineitem").filter(above_up_to("l_quantity", 0, 6)).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("flt_03_not_in_set", with_tables("""
SELECT order_key, line_number, PULocationID, DOLocationID FROM trips
WHERE PULocationID NOT IN (3, 7, 11) AND DOLocationID NOT IN (3, 7, 11)""", "trips"))
def flt_03(spark, sf):
    return tv.trips(
        spark, sf, "order_key", "line_number", "PULocationID", "DOLocationID"
    ).filter(in_none(["PULocationID", "DOLocationID"], [3, 7, 11]))


@query("flt_04_null_rows", """
SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)
WHERE quality IS NULL OR toxic IS NULL""")
def flt_04(spark, sf):
    documents = tv.read(spark, sf, "documents").select("doc_id")
    return documents.join(tv.read(spark, sf, "labels"), "doc_id", "left").filter(
        any_null(["quality", "toxic"])
    )


@query("flt_05_complete_rows", """
SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)
WHERE lang IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def flt_05(spark, sf):
    documents = tv.read(spark, sf, "documents").select("doc_id", "lang")
    return documents.join(tv.read(spark, sf, "labels"), "doc_id", "left").dropna()


@query("flt_06_calendar_year", """
SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997""")
def flt_06(spark, sf):
    return tv.read(spark, sf, "orders").filter(in_year("o_orderdate", 1997)).select(
        "o_orderkey", "o_totalprice"
    )


@query("flt_07_equality", with_tables("""
SELECT holidayName, strftime(date, '%Y-%m-%d') AS date FROM holidays
WHERE countryRegionCode = 'US'""", "holidays"))
def flt_07(spark, sf):
    return tv.holidays(spark, sf).filter(F.col("countryRegionCode") == "US").select(
        "holidayName", F.date_format("date", "yyyy-MM-dd").alias("date")
    )


COORDINATES = {
    "latitude": ("pickup_latitude", "dropoff_latitude"),
    "longitude": ("pickup_longitude", "dropoff_longitude"),
}


def located_trips(spark, sf, *columns):
    """Trips with the coordinates of both ends; null for zones off the map."""
    places = materialise(one_per_key(tv.centroids(spark, sf), "LocationID"), "centroids")
    df = tv.trips(spark, sf, *columns)
    for i, key in enumerate(["PULocationID", "DOLocationID"]):
        names = {c: n[i] for c, n in COORDINATES.items()}
        df = join_role(df, places, "LocationID", key, names, unique=True)
    return df


LOCATED_SQL = """
located AS (
  SELECT t.*, p.latitude AS pickup_latitude, p.longitude AS pickup_longitude,
         d.latitude AS dropoff_latitude, d.longitude AS dropoff_longitude
  FROM trips t LEFT JOIN centroids p ON p.LocationID = PULocationID
  LEFT JOIN centroids d ON d.LocationID = DOLocationID)"""


@query("flt_08_bounding_box", with_tables(f"""
WITH {LOCATED_SQL}
SELECT order_key, line_number FROM located
WHERE pickup_longitude BETWEEN -74.03 AND -73.75 AND dropoff_longitude BETWEEN -74.03 AND -73.75
  AND pickup_latitude BETWEEN 40.63 AND 40.85 AND dropoff_latitude BETWEEN 40.63 AND 40.85""",
    "trips", "centroids"))
def flt_08(spark, sf):
    pairs = list(zip(COORDINATES["longitude"], COORDINATES["latitude"]))
    return located_trips(
        spark, sf, "order_key", "line_number", "PULocationID", "DOLocationID"
    ).filter(inside_box(pairs)).select("order_key", "line_number")


BOUNDS_SQL = """
quartiles AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
bounds AS (
  SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM quartiles)"""


@query("flt_09_outlier_rows", f"""
WITH {BOUNDS_SQL}
SELECT event_id, value FROM events, bounds WHERE value < lower OR value > upper""")
def flt_09(spark, sf):
    rows = tv.read(spark, sf, "events").select("event_id", "value")
    return outliers(rows, "value", iqr_bounds(rows, "value"))


# nulls and samples --------------------------------------------------------


@query("nul_01_sentinel_to_null", """
SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
FROM orders""")
def nul_01(spark, sf):
    return null_sentinels(
        tv.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        "4-NOT SPECIFIED",
    )


@query("nul_02_fill", """
SELECT d.doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic
FROM documents d LEFT JOIN labels USING (doc_id)""")
def nul_02(spark, sf):
    documents = tv.read(spark, sf, "documents").select("doc_id")
    return documents.join(tv.read(spark, sf, "labels"), "doc_id", "left").fillna(
        {"quality": -1, "toxic": 0}
    )


BUCKET_SQL = """CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) % 100"""


@query("smp_01_hash_sample", f"""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE {BUCKET_SQL} < 10""")
def smp_01(spark, sf):
    lines = tv.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return hash_sample(lines, 10, "l_orderkey", "l_linenumber")


@query("smp_01_bernoulli_sample")
def smp_01_bernoulli(spark, sf):
    return tv.read(spark, sf, "lineitem").sample(fraction=0.1, seed=42).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("smp_02_hash_split", f"""
SELECT CASE WHEN {BUCKET_SQL} < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
       CAST(sum(l_orderkey) AS BIGINT) AS key_sum
FROM lineitem GROUP BY 1""")
def smp_02(spark, sf):
    lines = tv.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    parts = hash_split(lines, 80, "l_orderkey", "l_linenumber")
    sums = [
        part.agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"))
        .select(F.lit(name).alias("part"), "n", "key_sum")
        for name, part in zip(["train", "test"], parts)
    ]
    return sums[0].unionByName(sums[1])


@query("smp_02_random_split")
def smp_02_random(spark, sf):
    train, test = tv.read(spark, sf, "lineitem").select("l_orderkey").randomSplit(
        [0.8, 0.2], seed=42
    )
    return train.agg(F.count("*").alias("n")).select(F.lit("train").alias("part"), "n").unionByName(
        test.agg(F.count("*").alias("n")).select(F.lit("test").alias("part"), "n")
    )


@query("smp_03_preview", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def smp_03(spark, sf):
    return tv.read(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(5)
