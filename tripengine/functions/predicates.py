"""Row tests used by filters."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def positive(*columns: str) -> Column:
    """All columns above zero; a null fails the test."""
    return reduce(and_, [F.col(c) > 0 for c in columns])


def above_up_to(column: str, low: float, high: float) -> Column:
    """``low < column <= high``."""
    return (F.col(column) > low) & (F.col(column) <= high)


def in_none(columns, ids) -> Column:
    """No column holds one of the ids; a null key fails the test."""
    return reduce(and_, [~F.col(c).isin(list(ids)) for c in columns])


def any_null(columns) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def hash_bucket(*keys: str, buckets: int = 100, salt: str | None = None) -> Column:
    """A bucket 0..buckets-1 that depends on the key values alone.

    MD5 rather than Spark's own hash, so that other systems can redo it. Rows
    that one split has put together are parted anew by another ``salt``.
    """
    # a null key has a mark of its own, so that (null, a) and (a, null) differ
    first = [] if salt is None else [F.lit(salt)]
    text = F.concat_ws("|", *first, *[F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
