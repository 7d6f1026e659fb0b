"""Declared schemas of the inputs and of the finished tables."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
TEXT, TIME, DATE = T.StringType(), T.TimestampType(), T.DateType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TRIP_RAW = table(
    tpep_pickup_datetime=TIME,
    tpep_dropoff_datetime=TIME,
    PULocationID=INT,
    DOLocationID=INT,
    passenger_count=INT,
    trip_distance=DOUBLE,
    payment_type=TEXT,
    fare_amount=DOUBLE,
    tolls_amount=DOUBLE,
    improvement_surcharge=DOUBLE,
    total_amount=DOUBLE,
)

ZONE = table(LocationID=INT, Borough=TEXT, Zone=TEXT, service_zone=TEXT)

CENTROID = table(LocationID=INT, latitude=DOUBLE, longitude=DOUBLE)

HOLIDAY = table(
    countryOrRegion=TEXT,
    holidayName=TEXT,
    normalizeHolidayName=TEXT,
    isPaidTimeOff=T.BooleanType(),
    countryRegionCode=TEXT,
    date=TIME,
)

WEATHER_DOCUMENT = T.StructType(
    [T.StructField("days", T.ArrayType(table(datetime=TEXT, temp=DOUBLE)))]
)

# The inputs of a fare model, in the order of the form that asks for them.
SCORING_ROW = table(
    passenger_count=INT,
    payment_type=INT,
    trip_duration=DOUBLE,
    pickup_day_of_week=INT,
    pickup_hour=INT,
    pickup_month=INT,
    pickup_borough=TEXT,
    dropoff_borough=TEXT,
    is_holiday=INT,
    distance_bin=TEXT,
    time_of_day_bin=TEXT,
    near_airport=INT,
)

# The columns of the feature table and of the model table.
FEATURE_COLUMNS = [
    "DOLocationID", "PULocationID", "passenger_count", "payment_type",
    "total_amount", "trip_duration", "pickup_day_of_week", "pickup_hour",
    "pickup_month", "pickup_borough", "dropoff_borough", "temp", "distance_km",
    "is_holiday", "distance_bin", "temp_bin", "time_of_day_bin", "season",
    "near_airport",
]

MODEL_COLUMNS = [
    "passenger_count", "payment_type", "total_amount", "trip_duration",
    "pickup_day_of_week", "pickup_hour", "pickup_month", "pickup_borough",
    "dropoff_borough", "is_holiday", "distance_bin", "time_of_day_bin",
    "near_airport",
]

LABEL = "total_amount"
CATEGORICAL = ["pickup_borough", "dropoff_borough", "distance_bin", "time_of_day_bin"]
NUMERIC = [
    "pickup_day_of_week", "payment_type", "trip_duration", "pickup_hour",
    "pickup_month", "is_holiday", "passenger_count", "near_airport",
]
