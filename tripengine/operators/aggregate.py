"""Counts, shares, grouped means, pivots, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most frequent first, ties in key order."""
    return df.groupBy(*keys).count().orderBy(F.desc("count"), *keys)


def counts_in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key in key order."""
    return df.groupBy(*keys).count().orderBy(*keys)


def value_counts_all(df: DataFrame) -> DataFrame:
    """Rows per value of every column, in one pass over the table."""
    texts = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    return (
        texts.unpivot([], df.columns, "column", "value").groupBy("column", "value").count()
    )


def top_k(df: DataFrame, k: int, *keys: str) -> DataFrame:
    """The ``k`` most frequent keys, ties in key order."""
    return value_counts(df, *keys).limit(k)


def share(df: DataFrame, *keys: str, count: str = "count") -> DataFrame:
    """Rows per key and their percentage of all rows.

    The total is a scalar subquery over the grouped rows, whose exchange it
    shares, so that nothing is gathered into one window partition.
    """
    grouped = df.groupBy(*keys).agg(F.count("*").alias(count))
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn("percentage", F.try_divide(F.col(count) * 100, total))


def normalise(df: DataFrame, column: str) -> DataFrame:
    """Scale a score column to sum 1."""
    total = df.agg(F.sum(column)).scalar()
    return df.withColumn(column, F.try_divide(F.col(column), total))


def share_in_set(df: DataFrame, columns: Sequence[str], ids: Sequence) -> DataFrame:
    """Per column the percentage of rows whose value is among ``ids``; one pass."""
    rows = F.count("*")
    return df.agg(*[
        F.try_divide(F.count_if(F.col(c).isin(list(ids))) * 100, rows).alias(f"{c}_percentage")
        for c in columns
    ])


def null_percentage(df: DataFrame, column: str) -> DataFrame:
    nulls = F.count_if(F.col(column).isNull())
    return df.agg(
        F.count("*").alias("rows"),
        nulls.alias("nulls"),
        F.try_divide(nulls * 100, F.count("*")).alias("percentage"),
    )


def bucket_mean(df: DataFrame, bucket: Column, name: str, value: str, mean: str) -> DataFrame:
    """Mean of ``value`` per bucket, in bucket order."""
    return df.groupBy(bucket.alias(name)).agg(F.mean(value).alias(mean)).orderBy(name)


def pivot_counts(
    df: DataFrame, row: str, column: str, values: Sequence | None = None,
    missing: int | None = None,
) -> DataFrame:
    """Counts of two keys as a matrix with one column per value of ``column``.

    Without ``values`` Spark looks them up, up to its own pivot limit.
    """
    counts = df.groupBy(row, column).count().groupBy(row)
    pivoted = counts.pivot(column, list(values)) if values is not None else counts.pivot(column)
    matrix = pivoted.agg(F.sum("count"))
    if missing is None:
        return matrix
    return matrix.fillna(missing, subset=[c for c in matrix.columns if c != row])


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum.

    Every bin is left-closed and the last one closed on both sides; a bin
    without values has a row with count 0, in each group that has any value.
    A table without values has no bins. All groups share the bins.
    """
    value = F.col(column)
    edges = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    low, high = edges.select("low").scalar(), edges.select("high").scalar()
    width = (high - low) / F.lit(bins)
    position = F.coalesce(F.floor(F.try_divide(value - low, width)), F.lit(0))
    counted = (
        df.filter(value.isNotNull())
        .groupBy(*by, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .count()
    )
    # every bin of a group is looked up in the counts of that group, at most ``bins`` of them
    held = counted.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("held"))
    return (
        held.filter(F.size("held") > 0)
        .select(*by, "held", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select(*by, "bin", F.coalesce(F.col("held")[F.col("bin")], F.lit(0)).alias("count"))
        .withColumns({
            "bin_start": low + F.col("bin") * width,
            "bin_end": low + (F.col("bin") + 1) * width,
        })
    )


def compare_distributions(
    first: DataFrame, second: DataFrame, column: str, bins: int,
    names: Sequence[str] = ("Original", "Sampled"),
) -> DataFrame:
    """Histograms of two tables over common bins, with shares and densities."""
    both = (
        first.select(column).withColumn("source", F.lit(names[0]))
        .unionByName(second.select(column).withColumn("source", F.lit(names[1])))
    )
    counted = histogram(both, column, bins, by=["source"])
    sizes = counted.groupBy("source").agg(F.sum("count").alias("rows"))
    totals = [
        F.when(F.col("source") == name,
               sizes.filter(F.col("source") == name).select("rows").scalar())
        for name in names
    ]
    ratio = F.try_divide(F.col("count"), F.coalesce(*totals))
    return counted.withColumns({
        "share": ratio,
        "density": F.try_divide(ratio, F.col("bin_end") - F.col("bin_start")),
    })
