"""Stored summaries of a table's parts, from which the whole table is described.

A part (a monthly file) is read when it arrives, once for its number columns and once
for its code columns, and not again. Of its number columns are kept row and value counts, mean, second to fourth central moments, extremes, a
quantile sketch and a distinct-count sketch; of its code columns the exact counts
of all values. Merging reads these few rows only: counts, moments and extremes come
out as from one pass over all rows, quantiles and distinct counts within the error of
their sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NUMBERS, CODES = "numbers", "codes"


def summarise_numbers(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """A row for each part and column; nulls are counted, NaN is a value without a rank."""
    def row(c: str):
        value = F.col(c).cast("double")
        n, spread = F.count(c).cast("double"), F.var_pop(value)
        return F.struct(
            F.lit(c).alias("column"), F.count("*").alias("rows"), F.count(c).alias("values"),
            F.mean(value).alias("mean"), (n * spread).alias("m2"),
            # a column of one value has no skewness, and moments of 0
            F.coalesce(F.skewness(value) * n * F.pow(spread, F.lit(1.5)), n * spread).alias("m3"),
            F.coalesce((F.kurtosis(value) + 3) * n * spread * spread, n * spread).alias("m4"),
            F.min(value).alias("min"), F.max(value).alias("max"),
            F.kll_sketch_agg_double(F.when(~F.isnan(value), value)).alias("ranks"),
            F.hll_sketch_agg(value.cast("string")).alias("kinds"),
        )

    return df.groupBy(part).agg(F.array(*[row(c) for c in columns]).alias("found")) \
        .select(part, F.inline("found"))


def summarise_codes(df: DataFrame, part: str, columns: Sequence[str]) -> DataFrame:
    """Rows of each part, column and value; null is a value."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(part, F.inline(each)).groupBy(part, "column", "value").agg(F.count("*").alias("count"))


def store_parts(
    df: DataFrame, folder: str, part: str, numbers: Sequence[str] = (), codes: Sequence[str] = (),
) -> None:
    """Summarise the parts in ``df``, in place of what is stored of these very parts."""
    for name, columns, summarise in (
        (NUMBERS, numbers, summarise_numbers), (CODES, codes, summarise_codes),
    ):
        if columns:
            summarise(df, part, columns).write.partitionBy(part).mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/{name}")


def merged_numbers(
    spark: SparkSession, folder: str, quantiles: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """A row per column: counts, moments and extremes as of all rows, and sketched figures."""
    found = spark.read.parquet(f"{folder}/{NUMBERS}")
    own = Window.partitionBy("column")  # a row per part
    n = F.col("values")
    overall = F.try_divide(F.sum(n * F.col("mean")).over(own), F.sum(n).over(own))
    moved = found.withColumn("d", F.col("mean") - overall)
    d, m2, m3, m4 = (F.col(c) for c in ("d", "m2", "m3", "m4"))
    probabilities = F.array(*[F.lit(float(q)) for q in quantiles])
    summed = moved.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum(n).alias("values"),
        F.try_divide(F.sum(n * F.col("mean")), F.sum(n)).alias("mean"),
        F.sum(m2 + n * d * d).alias("M2"),
        F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("M3"),
        F.sum(m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("M4"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.when(F.sum(n) > 0, F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("ranks"), probabilities))
        .alias("quantiles"),
        F.hll_sketch_estimate(F.hll_union_agg("kinds")).alias("distinct"),
    )
    n = F.col("values")
    return summed.select(
        "column", "rows", "values", "mean",
        F.sqrt(F.try_divide("M2", n - 1)).alias("stddev"),
        F.try_divide(F.sqrt(n) * F.col("M3"), F.pow("M2", F.lit(1.5))).alias("skewness"),
        (F.try_divide(n * F.col("M4"), F.col("M2") * F.col("M2")) - 3).alias("kurtosis"),
        "min", "max", "quantiles", "distinct",
    )


def merged_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per column and value over all parts."""
    found = spark.read.parquet(f"{folder}/{CODES}")
    return found.groupBy("column", "value").agg(F.sum("count").alias("count"))
