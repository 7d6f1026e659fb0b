"""Quantiles, quartile bounds, capping and box-plot numbers.

Exact quantiles never hold a group in one task. Cut points taken from bounded
sketches, merged in two levels, spread the values over range buckets. Counts
per bucket tell which bucket holds a wanted rank; a bucket with many rows is
cut again by a sketch of its own rows, and what is left is looked at value by
value, equal values counted together. The cut points affect the balance alone,
never the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripengine.operators.joins import join_groups
from tripengine.session import materialise

BUCKETS = 4096
#: Sketches of tasks are merged in so many groups before the last merge.
MERGES = 64
#: Rows of a bucket that are looked at value by value; a larger one is cut again.
HIT_ROWS = 1_000_000


def _constant_array(numbers: Iterable[float]) -> Column:
    """Many numbers as one constant, without an expression for each."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").try_cast("array<double>")


def _cut_points(values: DataFrame) -> set[float]:
    """Fewer than BUCKETS values that part the rows about evenly, fetched once."""
    steps = _constant_array(i / BUCKETS for i in range(1, BUCKETS))
    part = F.pmod(F.spark_partition_id(), F.lit(MERGES))
    sketches = values.filter(~F.isnan("value")).groupBy(part.alias("part")).agg(
        F.kll_sketch_agg_double("value").alias("sketch")
    )
    # an empty sketch has no quantiles and may not be asked for them
    merged = F.kll_merge_agg_double("sketch")
    found = sketches.agg(
        F.when(F.count("*") > 0, F.kll_sketch_get_quantile_double(merged, steps))
    ).first()[0]
    return set(found or [])


def _range_buckets(values: DataFrame, cuts: Iterable[float]) -> DataFrame:
    """Add ``bucket``, the number of distinct cut points at or below ``value``."""
    inner = sorted({c for c in cuts if math.isfinite(c)})
    ends = [-math.inf, *inner, math.inf]
    return Bucketizer(
        splits=ends if inner else [-math.inf, 0.0, math.inf],
        inputCol="value", outputCol="bucket", handleInvalid="keep",
    ).transform(values)


def exact_quantiles(
    df: DataFrame,
    column: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    interpolate: bool = True,
    hit_rows: int = HIT_ROWS,
) -> DataFrame:
    """Exact quantiles, one named column each, overall or per group.

    ``interpolate`` weighs the two neighbours of a fractional rank; without
    it the smallest value whose share reaches the probability is taken.
    Nulls are left out; groups without values are not in the result.
    """
    by = list(by)
    values = df.select(*by, F.col(column).cast("double").alias("value")).filter(
        F.col("value").isNotNull()
    )
    # a bounded number of rows per group
    per_group = Window.partitionBy(*by)
    earlier = per_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)

    def ranks(name: str, p: float) -> list[Column]:
        """The ranks that make up a quantile, with their weights."""
        if not interpolate:
            rank = F.greatest(F.ceil(F.lit(p) * F.col("size")) - 1, F.lit(0))
            return [F.struct(F.lit(name).alias("name"), rank.alias("rank"),
                             F.lit(1.0).alias("weight"))]
        position = F.lit(p) * (F.col("size") - 1)
        low = F.floor(position)
        return [
            F.struct(F.lit(name).alias("name"), low.alias("rank"),
                     (1 - (position - low)).alias("weight")),
            F.struct(F.lit(name).alias("name"), F.least(low + 1, F.col("size") - 1).alias("rank"),
                     (position - low).alias("weight")),
        ]

    wanted = [r for name, p in quantiles.items() for r in ranks(name, p)]
    cuts = _cut_points(values)
    while True:
        bucketed = _range_buckets(values, cuts)
        totals = (
            bucketed.groupBy(*by, "bucket")
            .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .withColumns({
                "before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
                "size": F.sum("n").over(per_group),
            })
        )
        # two rows per group and quantile
        targets = materialise(
            totals.withColumn("target", F.explode(F.array(*wanted)))
            .select(*by, "bucket", "before", "n", "low", "high", "target.*")
            .withColumn("offset", F.col("rank") - F.col("before"))
            .filter((F.col("offset") >= 0) & (F.col("offset") < F.col("n")))
            .filter(F.col("weight") > 0),
            "ranks",
        )
        large = targets.filter((F.col("n") > hit_rows) & (F.col("low") < F.col("high")))
        again = [r[0] for r in large.select("bucket").distinct().collect()]  # among the cuts' buckets
        more = _cut_points(bucketed.filter(F.col("bucket").isin(again))) - cuts if again else set()
        if not more:
            break
        cuts |= more

    # at most BUCKETS numbers: rows of all other buckets are not shuffled
    used = targets.agg(F.collect_set("bucket").alias("used"))
    running = Window.partitionBy(*by, "bucket").orderBy("value").rowsBetween(
        Window.unboundedPreceding, 0
    )
    counted = (
        bucketed.filter(F.array_contains(used.scalar(), F.col("bucket")))
        .groupBy(*by, "bucket", "value")
        .agg(F.count("*").alias("copies"))
        .withColumn("upto", F.sum("copies").over(running))
    )
    c, t = counted.alias("c"), targets.alias("t")
    match = (F.col("c.bucket") == F.col("t.bucket"))
    for g in by:
        match = match & F.col(f"c.{g}").eqNullSafe(F.col(f"t.{g}"))
    hit = (F.col("t.offset") < F.col("c.upto")) & (
        F.col("t.offset") >= F.col("c.upto") - F.col("c.copies")
    )
    found = c.join(t, match & hit)
    weighed = F.col("c.value") * F.col("t.weight")
    return found.groupBy(*[F.col(f"c.{g}") for g in by]).agg(*[
        F.sum(F.when(F.col("t.name") == name, weighed)).alias(name) for name in quantiles
    ])


def sketch_quantiles(
    df: DataFrame,
    column: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    rel_err: float = 1e-4,
) -> DataFrame:
    """Approximate quantiles in one pass, within ``rel_err`` of the rank."""
    accuracy = max(1, round(1 / rel_err))
    return df.groupBy(*by).agg(*[
        F.percentile_approx(column, p, accuracy).alias(name) for name, p in quantiles.items()
    ])


def quantiles(
    df: DataFrame,
    column: str,
    wanted: Mapping[str, float],
    by: Sequence[str] = (),
    rel_err: float | None = None,
) -> DataFrame:
    """Exact quantiles, or a one-pass sketch when an error is allowed."""
    if rel_err is None:
        return exact_quantiles(df, column, wanted, by)
    return sketch_quantiles(df, column, wanted, by, rel_err)


def iqr_bounds(
    df: DataFrame,
    column: str,
    k: float = 1.5,
    by: Sequence[str] = (),
    rel_err: float | None = None,
) -> DataFrame:
    """Quartiles with the bounds ``q1 - k*iqr`` and ``q3 + k*iqr``."""
    reach = (F.col("q3") - F.col("q1")) * k
    return quantiles(df, column, {"q1": 0.25, "q3": 0.75}, by, rel_err).withColumns({
        "lower": F.col("q1") - reach, "upper": F.col("q3") + reach,
    })


def outliers(df: DataFrame, column: str, bounds: DataFrame) -> DataFrame:
    """Rows outside one row of bounds."""
    limits = bounds.select(F.struct("lower", "upper")).scalar()
    return df.filter((F.col(column) < limits["lower"]) | (F.col(column) > limits["upper"]))


def cap_upper(df: DataFrame, column: str, bounds: DataFrame) -> DataFrame:
    """Lower values above the upper bound to it; nulls stay null."""
    upper = bounds.select("upper").scalar()
    return df.withColumn(
        column, F.when(F.col(column) > upper, upper).otherwise(F.col(column))
    )


def box_numbers(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers and outlier count, overall or per group.

    Whiskers end at the extreme values within 1.5 quartile ranges.
    """
    by = list(by)
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    box = exact_quantiles(df, column, wanted, by)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    box = materialise(
        box.withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach}), "box"
    )
    rows = df.select(*by, F.col(column).alias("value")).filter(F.col("value").isNotNull())
    value = F.col("value")
    if by:
        rows = join_groups(rows, box, by)
    else:
        rows = rows.withColumns({
            name: box.select(name).scalar() for name in [*wanted, "lower", "upper"]
        })
    inside = value.between(F.col("lower"), F.col("upper"))
    return rows.groupBy(*by, *wanted).agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.count("*").alias("count"),
    )
