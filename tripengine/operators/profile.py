"""One-pass profiles of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripengine.functions.tails import f_tail
from tripengine.operators.clean import numeric_columns


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def duplicate_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Rows beyond the first of each distinct row, from one aggregate."""
    keys = columns or df.columns
    return (
        df.groupBy(*keys).agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, a row per column.

    Text columns have no mean and deviation; their extremes are in
    ``min_text`` and ``max_text``. Without names all columns of these two
    sorts are described; a named column of another sort is an error.
    """
    numeric = set(numeric_columns(df))
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    if other := [c for c in columns if c not in numeric | text]:
        raise ValueError(f"neither numbers nor text: {', '.join(other)}")
    names = [c for c in columns or df.columns if c in numeric | text]

    def row(c: str):
        is_number = c in numeric
        number = F.col(c).cast("double") if is_number else F.lit(None).cast("double")
        words = F.lit(None).cast("string") if is_number else F.col(c)
        return F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.mean(number).alias("mean"),
            F.stddev(number).alias("stddev"),
            F.min(number).alias("min"),
            F.max(number).alias("max"),
            F.min(words).alias("min_text"),
            F.max(words).alias("max_text"),
        )

    return df.agg(F.array(*[row(c) for c in names]).alias("rows")).select(F.inline("rows"))


def moments(df: DataFrame, *columns: str) -> DataFrame:
    """Population skewness and excess kurtosis, a row per column."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.skewness(c).alias("skewness"),
            F.kurtosis(c).alias("kurtosis"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample variance, a row per column."""
    rows = [
        F.struct(F.lit(c).alias("feature"), F.var_samp(c).alias("variance")) for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def select_by_variance(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    return variances(df, columns).filter(F.col("variance") > threshold)


def correlations_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, a row per column."""
    rows = [
        F.struct(F.lit(c).alias("feature"), F.corr(c, target).alias("correlation"))
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise Pearson correlations in long form, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    rows = []
    for a, b in pairs:
        for left, right in {(a, b), (b, a)}:
            rows.append(F.struct(
                F.lit(left).alias("feature_a"),
                F.lit(right).alias("feature_b"),
                F.corr(a, b).alias("corr"),
            ))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def category_target_means(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Mean target per category of every column, in one pass."""
    texts = df.select(target, *[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([target], list(columns), "column", "category")
        .groupBy("column", "category")
        .agg(F.mean(target).alias("mean_target"))
    )


def correlation_scores(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str
) -> DataFrame:
    """Absolute correlations and absolute category means as one score list."""
    corr = correlations_with(df, numeric, target).select(
        "feature", F.abs("correlation").alias("correlation_importance")
    )
    if not categorical:
        return corr
    label = F.concat(
        F.lit(f"Mean {target} for "), F.col("column"), F.lit(" = "),
        F.coalesce("category", F.lit("None")),
    )
    means = category_target_means(df, categorical, target).select(
        label.alias("feature"), F.abs("mean_target").alias("correlation_importance")
    )
    return corr.unionByName(means)


def mean_score(df: DataFrame, scores: Sequence[str], name: str = "average_importance") -> DataFrame:
    """Average of several score columns, best first."""
    total = sum((F.col(c) for c in scores[1:]), F.col(scores[0]))
    return df.withColumn(name, total / len(scores)).orderBy(F.desc(name), df.columns[0])


def anova(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """One-way analysis of variance of the target over each column's groups."""
    y = F.col(target)
    texts = df.filter(y.isNotNull()).select(
        y.cast("double").alias("y"), *[F.col(c).cast("string").alias(c) for c in columns]
    )
    groups = (
        texts.unpivot(["y"], list(columns), "feature", "category")
        .filter(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count("*").alias("n"), F.mean("y").alias("m"), F.var_pop("y").alias("v"))
    )
    between = F.sum(F.col("n") * F.col("m") * F.col("m")) - F.try_divide(
        F.pow(F.sum(F.col("n") * F.col("m")), F.lit(2)), F.sum("n")
    )
    sums = groups.groupBy("feature").agg(
        between.alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
        (F.count("*") - 1).alias("df_between"),
        (F.sum("n") - F.count("*")).alias("df_within"),
    )
    f_value = F.try_divide(
        F.try_divide("ssb", "df_between"), F.try_divide("ssw", "df_within")
    )
    found = sums.select("feature", "df_between", "df_within", f_value.alias("f_statistic"))
    # a row per feature, so the tail of the distribution is worked out on the driver
    rows = [
        (*r, None if r["f_statistic"] is None
         else f_tail(r["f_statistic"], r["df_between"], r["df_within"]))
        for r in found.collect()
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, df_between bigint, df_within bigint, f_statistic double, p_value double"
    )
