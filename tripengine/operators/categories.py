"""Encodings of columns with very many categories, as tables that are joined.

Codes and means stay distributed: nothing is gathered on the driver, so that a
column may have as many categories as rows. ``encode.indexer`` and
``encode.target_mean`` are for columns whose categories fit into a model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripengine.operators.clean import fresh_name
from tripengine.session import materialise

#: Row numbers within a partition take so many low bits of a row's id.
ROW_BITS = 33


def frequency_codes(df: DataFrame, column: str) -> DataFrame:
    """``value`` and ``code``: 0 for the most frequent value, ties in order; a written table.

    Values are counted, dealt out by ranges of (count, value) and numbered within each
    range; what comes before a range is the sum of the counts of the ranges before it, one
    row each. Nulls have no code.
    """
    counted = df.select(F.col(column).alias("value")).where("value IS NOT NULL") \
        .groupBy("value").agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.col("value")]
    placed = counted.repartitionByRange(*order).sortWithinPartitions(*order) \
        .select("value", F.monotonically_increasing_id().alias("place"))
    placed = materialise(placed, "places").withColumn("part", F.shiftright("place", ROW_BITS))
    sizes = materialise(placed.groupBy("part").agg(F.count("*").alias("size")), "sizes")
    earlier = sizes.withColumnsRenamed({"part": "other", "size": "before"})
    starts = sizes.join(earlier, F.col("other") < F.col("part"), "left") \
        .groupBy("part").agg(F.coalesce(F.sum("before"), F.lit(0)).alias("start"))
    starts = materialise(starts, "starts")  # a row per shuffle partition
    within = F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    coded = placed.join(starts, "part").select("value", (F.col("start") + within).alias("code"))
    return materialise(coded, "codes")


def with_codes(df: DataFrame, codes: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Add the code of each row's value; null and unknown values get the number of codes."""
    output = output or f"{column}_index"
    value, code = (fresh_name(n, df.columns) for n in ("value", "code"))
    known = codes.select(F.col("value").alias(value), F.col("code").alias(code))
    total = codes.agg(F.count("*").alias("n")).select("n").scalar()
    return df.join(known, df[column] == known[value], "left") \
        .withColumn(output, F.coalesce(code, total).cast("double")).drop(value, code)


def _smoothed(total: Column, count: Column, prior: Column, smoothing: float) -> Column:
    """Mean of a category drawn towards the prior as by ``smoothing`` rows of it."""
    weight = count + F.lit(float(smoothing))
    return F.coalesce(F.try_divide(total + F.lit(float(smoothing)) * prior, weight), prior)


def label_means(df: DataFrame, column: str, label: str, smoothing: float = 0.0) -> DataFrame:
    """``value`` and ``mean`` of the label, for rows that gave no means; a written table."""
    sums = materialise(df.select(F.col(column).alias("value"), F.col(label).cast("double").alias("y"))
                       .groupBy("value").agg(F.sum("y").alias("total"), F.count("y").alias("rows")), "sums")
    prior = sums.agg(F.try_divide(F.sum("total"), F.sum("rows")).alias("prior")).select("prior").scalar()
    total = F.coalesce("total", F.lit(0.0))
    return materialise(sums.select("value", _smoothed(total, F.col("rows"), prior, smoothing).alias("mean")), "means")


def with_means(df: DataFrame, means: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Add the mean of each row's category; unknown values get none."""
    value, mean = (fresh_name(n, df.columns) for n in ("value", "mean"))
    known = means.select(F.col("value").alias(value), F.col("mean").alias(mean))
    return df.join(known, df[column].eqNullSafe(known[value]), "left") \
        .withColumn(output or f"{column}_target", F.col(mean)).drop(value, mean)


def out_of_fold_means(
    df: DataFrame, column: str, label: str, fold: str, output: str | None = None, smoothing: float = 0.0,
) -> DataFrame:
    """Add to each row the mean label of its category in all other folds.

    So no row's own label is in its feature. A category that no other fold has gets the
    mean of all rows of the other folds; null is a category. Sums per category and
    fold are made before anything is joined, at most folds times categories of them.
    """
    sums = materialise(
        df.select(F.col(column).alias("k"), F.col(fold).alias("f"), F.col(label).cast("double").alias("y"))
        .groupBy("k", "f").agg(F.coalesce(F.sum("y"), F.lit(0.0)).alias("t"), F.count("y").alias("r")), "sums")
    everything = sums.agg(F.sum("t").alias("t"), F.sum("r").alias("r"))
    all_total, all_rows = everything.select("t").scalar(), everything.select("r").scalar()
    folds = materialise(sums.groupBy("f").agg(
        F.try_divide(all_total - F.sum("t"), all_rows - F.sum("r")).alias("prior")), "folds")
    own = Window.partitionBy("k")  # a row per fold
    others = sums.select("k", "f", (F.sum("t").over(own) - F.col("t")).alias("t"),
                         (F.sum("r").over(own) - F.col("r")).alias("r"))
    means = others.join(folds.withColumnRenamed("f", "g"), F.col("f").eqNullSafe(F.col("g"))).select(
        "k", "f", _smoothed(F.col("t"), F.col("r"), F.col("prior"), smoothing).alias("m"))
    names = {n: fresh_name(n, df.columns) for n in ("k", "f", "m")}
    means = materialise(means, "means").withColumnsRenamed(names)
    met = df[column].eqNullSafe(means[names["k"]]) & df[fold].eqNullSafe(means[names["f"]])
    return df.join(means, met, "left").withColumn(output or f"{column}_target", F.col(names["m"])) \
        .drop(*names.values())
