"""Stages laid out for the reads that follow: partitioned by month, or bucketed by key.

A monthly stage holds a folder for each month, so that a range of dates or a
join with a calendar opens only the months it needs, and a month that comes
again replaces its own folder. A bucketed stage holds a file for each range of
a key's hash, so that two of them with equally many buckets meet on that key
without a shuffle.

Rows without a date lie in a month of their own (null) and belong to no range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine.session import shuffle_partitions
from tripengine.sources.files import table_format

MONTH = "stage_month"


def month_of(date: Column) -> Column:
    """Year and month of a date as one whole number, such as 202307."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def write_monthly_stage(
    df: DataFrame, path: str, date_column: str, fmt: str | None = None, month_column: str = MONTH,
    only_given: bool = False,
) -> None:
    """Write a stage partitioned by the month of a date.

    Rows of a month are brought together first, and adaptive execution splits a
    month that is large: a month has as many files as its size asks for, not
    one of every task. With ``only_given`` other months stay as they are.
    """
    rows = df.withColumn(month_column, month_of(F.col(date_column))).hint("rebalance", month_column)
    writer = rows.write.format(fmt or table_format(df.sparkSession)).mode("overwrite")
    if only_given:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(month_column).save(path)


def during(stage: DataFrame, date_column: str, start: str, end: str, month_column: str = MONTH) -> DataFrame:
    """Rows whose date lies within two days, both included; other months are not opened."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    day = F.col(date_column)
    return stage.where(
        F.col(month_column).between(month_of(first), month_of(last))
        & (day >= first) & (day < F.date_add(last, 1))
    )


def on_days(
    stage: DataFrame, calendar: DataFrame, date_column: str, day_column: str, month_column: str = MONTH
) -> DataFrame:
    """Rows on the days of a calendar, with its other columns.

    The month is part of the join, so that the months of the calendar's rows
    prune the stage while it runs. A calendar with two rows for a day repeats
    the rows of that day.
    """
    days = calendar.withColumn(month_column, month_of(F.col(day_column)))
    dated = stage.withColumn(day_column, F.to_date(date_column))
    return dated.join(days, [month_column, day_column])


def write_bucketed_stage(
    df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int | None = None, fmt: str = "parquet"
) -> None:
    """Write a stage in sorted buckets by key, and name it in the session's catalog.

    ``buckets`` defaults to the partitions shuffles start with, which follow the
    size of the tables read. Two stages meet without a shuffle if keys have
    equal types and the numbers of buckets are equal. All rows of a key lie in
    one bucket: this is for keys with few rows each, such as order numbers.
    """
    count = buckets or shuffle_partitions(df.sparkSession)
    # dealt by the buckets' own hash, so that each is written by one task into one file
    dealt = df.repartition(count, *keys)
    dealt.write.format(fmt).mode("overwrite").bucketBy(count, *keys).sortBy(*keys).option(
        "path", path).saveAsTable(name)


def read_bucketed_stage(spark: SparkSession, name: str, keep_name: bool = True) -> DataFrame:
    """A bucketed stage; without ``keep_name`` the catalog forgets it, the files stay."""
    stage = spark.table(name)
    if not keep_name:
        spark.sql(f"DROP TABLE {name}")
    return stage
