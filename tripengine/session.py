"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on.
SETTINGS = {
    # calendar parts and durations are read in one fixed zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split over several tasks, even where a later
    # aggregate on that key then needs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and hand it back."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


#: Input bytes for each partition a shuffle starts with. Adaptive execution merges
#: partitions that turn out small but never makes more of them.
SHUFFLE_BYTES = 256 << 20
_INPUT = "tripengine.input.bytes"
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def begin_sizing(spark: SparkSession) -> None:
    """Forget the inputs counted so far: a new query or job begins."""
    spark.conf.set(_INPUT, "0")
    spark.conf.set(_PARTITIONS, spark.conf.get("spark.sql.shuffle.partitions"))


def add_input(spark: SparkSession, *paths: str) -> int:
    """Count tables about to be read, and start shuffles with partitions for them.

    The session's own ``spark.sql.shuffle.partitions`` is the least. Scans are
    left alone, so that rows lie in the same splits at every size.
    """
    size = int(spark.conf.get(_INPUT, "0"))
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    spark.conf.set(_INPUT, str(size))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHUFFLE_BYTES))
    spark.conf.set(_PARTITIONS, str(partitions))
    return partitions


def shuffle_partitions(spark: SparkSession) -> int:
    """The partitions shuffles of this query or job start with."""
    return int(spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tripengine-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Working paths of this process that nobody has removed yet.
_working: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one written table."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _working.append(path)
    return path


def clear_scratch(spark: SparkSession, since: int = 0) -> None:
    """Remove working tables, all or those made after the first ``since``.

    To be called when nothing reads them any more, as after a query's result
    has been fetched or written.
    """
    for path in _working[since:]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _working[since:]


@contextmanager
def job(spark: SparkSession):
    """Settings of a job, and the end of the working tables it makes."""
    since = len(_working)
    begin_sizing(prepare(spark))
    try:
        yield spark
    finally:
        clear_scratch(spark, since)


def materialise(df: DataFrame, name: str = "derived") -> DataFrame:
    """Write a derived table once and read it back.

    This cuts its lineage, and Spark then knows its true size: it broadcasts
    the table below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it
    beyond, where the estimate of an unwritten table could be far off.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
