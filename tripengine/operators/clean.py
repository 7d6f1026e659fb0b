"""Conforming, null handling, rounding, sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripengine.functions.predicates import hash_bucket


def conform(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Select and cast to a declared schema in one projection.

    ``lenient`` turns values that do not fit into null instead of an error.
    """
    columns = []
    for field in schema:
        c = F.col(field.name)
        cast = c.try_cast(field.dataType) if lenient else c.cast(field.dataType)
        columns.append(cast.alias(field.name))
    return df.select(columns)


def null_sentinels(df: DataFrame, sentinel: str) -> DataFrame:
    """Replace a marker text by null in every text column."""
    return df.withColumns({
        f.name: F.nullif(F.col(f.name), F.lit(sentinel))
        for f in df.schema
        if isinstance(f.dataType, T.StringType)
    })


def round_half_even(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round several columns, ties to the even digit."""
    return df.withColumns({c: F.bround(c, d) for c, d in digits.items()})


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, each once, in schema order."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in without
    ]


def hash_sample(df: DataFrame, percent: int, *keys: str) -> DataFrame:
    """A repeatable sample: the rows whose key falls in the first buckets."""
    return df.filter(hash_bucket(*keys) < percent)


def hash_split(
    df: DataFrame, percent: int, *keys: str, salt: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """A repeatable split into ``percent`` of the key space and the rest.

    A part is split again with another ``salt``; without one it would stay whole.
    """
    bucket = hash_bucket(*keys, salt=salt)
    return df.filter(bucket < percent), df.filter(bucket >= percent)


def fresh_name(name: str, taken: Sequence[str]) -> str:
    """A column name none of ``taken`` clashes with, in any case."""
    while name.lower() in (t.lower() for t in taken):
        name += "_"
    return name
