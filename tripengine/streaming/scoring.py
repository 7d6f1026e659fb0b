"""Scoring of arriving trip files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripengine.operators.models import score


def score_arriving(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    output: list[str] | None = None,
    file_filter: str = "*.parquet",
) -> StreamingQuery:
    """Score every new Parquet file below ``source`` and append to ``sink``.

    Stateless, so neither watermark nor state is kept; the checkpoint
    remembers the files already scored. Takes what has arrived and ends.
    """
    arriving = (
        spark.readStream.schema(schema).option("pathGlobFilter", file_filter).parquet(source)
    )
    scored = score(model, prepare(arriving))
    if output is not None:
        scored = scored.select(*output)
    return (
        scored.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(sink)
    )


def error_windows(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    schema: T.StructType,
    sink: str,
    checkpoint: str,
    keys: Sequence[str],
    label: str,
    event_time: str = "pickup_datetime",
    width: str = "1 day",
    delay: str = "2 days",
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_filter: str = "*.parquet",
) -> StreamingQuery:
    """Errors of a model on arriving trips, a row for each closed window of time.

    A trip that is sent again within ``delay`` counts once: its keys are kept as
    state until the watermark, ``delay`` behind the latest event, has passed
    them. Rows behind the watermark are dropped, so that a window that is
    written is final; windows still open stay in the state of the checkpoint,
    for the next run. Rows without an event time or a label are left out.
    """
    arriving = (
        spark.readStream.schema(schema).option("pathGlobFilter", file_filter).parquet(source)
    )
    trips = prepare(arriving).filter(F.col(event_time).isNotNull() & F.col(label).isNotNull())
    once = score(model, trips.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys)))
    error = F.col(label) - F.col("prediction")
    found = once.groupBy(F.window(event_time, width).alias("w")).agg(
        F.count("*").alias("trips"), F.sum(error).alias("error_sum"),
        F.sum(F.abs(error)).alias("absolute_sum"), F.sum(error * error).alias("square_sum"),
    )
    return (
        found.select(F.col("w.start").alias("window_start"), "trips", "error_sum", "absolute_sum", "square_sum")
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(sink)
    )
