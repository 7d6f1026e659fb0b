"""Dimension joins, key checks and merges of small tables.

No join carries a broadcast hint. Dimensions read from files have a size that
Spark knows, so it broadcasts them below ``spark.sql.autoBroadcastJoinThreshold``
and shuffles beyond it, splitting hot keys. Derived tables are written first
(``materialise``), after which the same holds for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripengine.session import materialise


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per key: the least of those that repeat it, nulls in it last."""
    rest = [c for c in dim.columns if c != key]
    ranked = F.struct(*[F.struct(F.col(c).isNull(), F.col(c).alias("value")).alias(c) for c in rest])
    return dim.groupBy(key).agg(F.min(ranked).alias("least")).select(
        key, *[F.col("least")[c]["value"].alias(c) for c in rest]
    )


def join_role(
    fact: DataFrame, dim: DataFrame, key: str, fact_key: str, attributes: Mapping[str, str],
    unique: bool = False,
) -> DataFrame:
    """Left join of a dimension in one role.

    ``attributes`` maps dimension columns to their names in this role; the
    dimension key is renamed to the fact's key and not repeated. A dimension
    that is not known to be ``unique`` in its key is brought to one row per
    key first, so no fact row is repeated.
    """
    if not unique:
        dim = materialise(one_per_key(dim.select(key, *attributes), key), "dimension")
    side = dim.select(
        F.col(key).alias(fact_key), *[F.col(c).alias(n) for c, n in attributes.items()]
    )
    return fact.join(side, on=fact_key, how="left")


def one_per_day(holidays: DataFrame, country: str = "US") -> DataFrame:
    """One holiday per date: the first by name when several share a date."""
    first = F.min(F.struct("holidayName", "normalizeHolidayName"))
    return (
        holidays.filter(F.col("countryRegionCode") == country)
        .filter(F.col("holidayName").isNotNull())
        .groupBy(F.to_date("date").alias("holiday_date"))
        .agg(first.alias("holiday"))
        .select("holiday_date", "holiday.*")
    )


def flag_calendar(
    fact: DataFrame,
    holidays: DataFrame,
    date_column: str = "pickup_date",
    country: str = "US",
    filler: str = "No Holiday",
) -> DataFrame:
    """Left join of a holiday calendar with a 0/1 flag and filled names.

    The calendar is reduced to one row per date first, so no fact row is
    repeated.
    """
    days = one_per_day(holidays, country).withColumnRenamed("holiday_date", date_column)
    return (
        fact.join(days, on=date_column, how="left")
        .withColumn("is_holiday", F.col("holidayName").isNotNull().cast("int"))
        .fillna({"holidayName": filler, "normalizeHolidayName": filler})
    )


def join_daily(
    fact: DataFrame, daily: DataFrame, date_column: str = "pickup_date",
    daily_date: str = "weather_date",
) -> DataFrame:
    """Left join of a daily series; of rows that repeat a day the least is taken."""
    series = materialise(one_per_key(daily, daily_date), "daily")
    return fact.join(series.withColumnRenamed(daily_date, date_column), date_column, "left")


def unmatched_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Distinct fact keys the dimension lacks, under the dimension's key name."""
    keys = fact.select(F.col(fact_key).alias(dim_key)).distinct()
    return keys.join(dim.select(dim_key), on=dim_key, how="left_anti")


def merge_scores(tables: Mapping[str, DataFrame], key: str = "feature") -> DataFrame:
    """Merge score tables ``(key, <name>)`` on the key, missing scores 0.

    One union and one aggregate stand for the chain of full outer joins. A
    key that occurs twice in a table is an error, as it would multiply rows.
    """
    parts = [
        df.select(key, F.lit(name).alias("source"), F.col(name).cast("double").alias("score"))
        for name, df in tables.items()
    ]

    def score_of(name: str) -> Column:
        ours = F.col("source") == name
        return F.when(
            F.count_if(ours) > 1, F.raise_error(F.lit(f"repeated {key} in {name}"))
        ).otherwise(F.coalesce(F.max(F.when(ours, F.col("score"))), F.lit(0.0)))

    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy(key).agg(*[score_of(name).alias(name) for name in tables])


def merge_counts(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, key: str
) -> DataFrame:
    """Full outer merge of two count tables on one coalesced key, missing 0.

    A null key is a group of its own and meets the other side's null group.
    """
    l, r = left.withColumnRenamed(left_key, "l_key"), right.withColumnRenamed(right_key, "r_key")
    counts = [c for c in l.columns + r.columns if c not in ("l_key", "r_key")]
    return (
        l.join(r, F.col("l_key").eqNullSafe(F.col("r_key")), "full_outer")
        .select(F.coalesce("l_key", "r_key").alias(key), *counts)
        .fillna(0, subset=counts)
    )


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of per-group columns, where the null group meets the null group."""
    side = right.withColumnsRenamed({g: f"right_{g}" for g in by})
    match = [F.col(g).eqNullSafe(F.col(f"right_{g}")) for g in by]
    return left.join(side, match, "left").drop(*[f"right_{g}" for g in by])


def attach_means(
    fact: DataFrame, means: DataFrame, column: str, mean_column: str
) -> DataFrame:
    """Left join of per-category means; unseen categories stay null."""
    return fact.join(means.select(column, mean_column), on=column, how="left")


def category_means(df: DataFrame, column: str, target: str) -> DataFrame:
    return df.groupBy(column).agg(F.mean(target).alias(f"{column}_target_mean"))


def encode_with_means(
    train: DataFrame, others: Sequence[DataFrame], columns: Sequence[str], target: str
) -> list[DataFrame]:
    """Replace nothing, add ``<column>_target_mean`` fitted on ``train`` to all."""
    frames = [train, *others]
    for column in columns:
        means = materialise(category_means(train, column, target), "means")
        name = f"{column}_target_mean"
        frames = [attach_means(df, means, column, name) for df in frames]
    return frames
