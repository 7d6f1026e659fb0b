"""File scans with declared schemas, and stage tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripengine import schemas
from tripengine.operators.clean import conform

MONTH_IN_NAME = r"_(\d{2})\.parquet"


def read_monthly(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType = schemas.TRIP_RAW,
    month_pattern: str = MONTH_IN_NAME,
) -> DataFrame:
    """Union of monthly Parquet files, each cast to the schema on its own.

    Types may drift between files, so every file is conformed before the
    union. ``month`` holds the digits of the month in the path.
    """
    months = []
    for path in paths:
        scan = spark.read.parquet(path)
        month = F.regexp_extract("_metadata.file_path", month_pattern, 1)
        months.append(conform(
            scan.withColumn("month", month),
            T.StructType([*schema, T.StructField("month", schemas.TEXT)]),
        ))
    return reduce(DataFrame.unionByName, months)


def monthly_paths(folder: str, pattern: str, months: Sequence[int] = range(1, 13)) -> list[str]:
    """Paths such as ``<folder>/trips_2023_01.parquet`` from ``trips_2023_{:02d}.parquet``."""
    return [f"{folder.rstrip('/')}/{pattern.format(month)}" for month in months]


def read_zone_lookup(spark: SparkSession, path: str, missing: str = "N/A") -> DataFrame:
    """Zone table from CSV with a header; the missing marker reads as null."""
    return spark.read.schema(schemas.ZONE).csv(path, header=True, nullValue=missing)


def read_weather(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Daily temperatures out of JSON documents with a ``days`` array."""
    documents = spark.read.schema(schemas.WEATHER_DOCUMENT).json(path, multiLine=multi_line)
    return documents.select(F.explode("days").alias("day")).select(
        F.to_date("day.datetime").alias("weather_date"), F.col("day.temp").alias("temp")
    )


def read_holidays(holidays: DataFrame, start: str, end: str) -> DataFrame:
    """Holidays within two dates, without the empty paid-time-off column."""
    day = F.col("date")
    in_range = (day >= F.lit(start)) & (day < F.date_add(F.lit(end).cast("date"), 1))
    return holidays.filter(in_range).drop("isPaidTimeOff")


def table_format(spark: SparkSession) -> str:
    """``delta`` where its session extension is configured, else ``parquet``."""
    extensions = spark.conf.get("spark.sql.extensions", None) or ""
    return "delta" if "delta" in extensions.lower() else "parquet"


def read_stage(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return spark.read.format(fmt or table_format(spark)).load(path)


def write_stage(
    df: DataFrame, path: str, fmt: str | None = None, replace_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Overwrite a stage; Parquet always takes the new schema, Delta if told so."""
    writer = df.write.format(fmt or table_format(df.sparkSession)).mode("overwrite")
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def lookup_table(spark: SparkSession, mapping: Mapping, schema: T.StructType) -> DataFrame:
    """A small literal lookup as a table with a declared schema.

    Spark does not know how small it is: count or group the other side first,
    or ``materialise`` the lookup, before joining it to a large table.
    """
    return spark.createDataFrame(list(mapping.items()), schema)


def result_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A short list of results as a table with a declared schema."""
    return spark.createDataFrame(list(rows), schema)
