"""The jobs of the trip analysis, from files to a scored table.

Each job reads stored tables and writes one, so that a later job, or a rerun
of it, starts from storage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine import schemas
from tripengine.functions.labels import (
    FORM_PAYMENT,
    FORM_WEEKDAY,
    FORM_YES_NO,
    form_code,
    form_term,
)
from tripengine.functions.predicates import any_null, in_none
from tripengine.operators.clean import conform, hash_split
from tripengine.operators.models import GRIDS, MODELS, regression_pipeline, save_model, score, tune
from tripengine.plans.cleaned import (
    UNMAPPED_ZONES,
    clean,
    enrich,
    explored_table,
    feature_table,
    model_table,
)
from tripengine.session import add_input, job, materialise
from tripengine.sources.files import (
    read_holidays,
    read_monthly,
    read_stage,
    read_weather,
    read_zone_lookup,
    write_stage,
)
from tripengine.sources.zones import polygon_centroids, ring_vertices


@dataclass
class Inputs:
    """Where the raw data lies."""

    trip_paths: Sequence[str]  # one Parquet path per month
    zone_lookup: str  # CSV with a header
    zone_shapes: str  # table with LocationID and geometry text, in degrees
    holidays: str  # table of holidays
    weather: str  # JSON document with daily temperatures
    year: int
    table_format: str | None = None
    excluded_zones: Sequence[int] = field(default_factory=lambda: list(UNMAPPED_ZONES))


def zone_dimension(spark: SparkSession, path: str, without: Sequence[int] = (264, 265)) -> DataFrame:
    """The zone lookup without the ids that stand for no zone."""
    return read_zone_lookup(spark, path).filter(in_none(["LocationID"], without))


def incomplete_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zones of the lookup that lack an attribute."""
    return zone_dimension(spark, path).filter(any_null(schemas.ZONE.names))


def cleaned_job(spark: SparkSession, inputs: Inputs, output: str) -> DataFrame:
    """Monthly trips, zones, shapes, holidays and weather to the cleaned table."""
    with job(spark):
        add_input(spark, *inputs.trip_paths)
        return _cleaned(spark, inputs, output)


def _cleaned(spark: SparkSession, inputs: Inputs, output: str) -> DataFrame:
    fmt, year = inputs.table_format, inputs.year
    shapes = read_stage(spark, inputs.zone_shapes, fmt)
    holidays = read_holidays(
        read_stage(spark, inputs.holidays, fmt), f"{year}-01-01", f"{year}-12-31"
    )
    cleaned = enrich(
        clean(read_monthly(spark, inputs.trip_paths), year),
        zone_dimension(spark, inputs.zone_lookup),
        materialise(polygon_centroids(ring_vertices(shapes)), "centroids"),
        holidays,
        read_weather(spark, inputs.weather),
        inputs.excluded_zones,
    )
    write_stage(cleaned, output, fmt)
    return read_stage(spark, output, fmt)


def explored_job(
    spark: SparkSession, cleaned: str, output: str, fmt: str | None = None
) -> DataFrame:
    """The cleaned table without implausible values, for profiles and plots."""
    with job(spark):
        write_stage(explored_table(read_stage(spark, cleaned, fmt)), output, fmt)
    return read_stage(spark, output, fmt)


def model_table_job(
    spark: SparkSession, cleaned: str, output: str, fmt: str | None = None
) -> DataFrame:
    """Filter, cap, bin and select the cleaned table for training."""
    with job(spark):
        write_stage(
            model_table(feature_table(read_stage(spark, cleaned, fmt))), output, fmt,
            replace_schema=True,
        )
    return read_stage(spark, output, fmt)


def training_job(
    spark: SparkSession, table: str, output: str, keys: Sequence[str] = tuple(schemas.MODEL_COLUMNS),
    model: str = "random_forest", encoding: str = "one_hot", fmt: str | None = None, **params,
) -> tuple[PipelineModel, DataFrame]:
    """Train on 80 percent of the key space, save the model, score the rest."""
    with job(spark):
        train, test = hash_split(read_stage(spark, table, fmt), 80, *keys)
        fitted = regression_pipeline(
            model, encoding, schemas.CATEGORICAL, schemas.NUMERIC, schemas.LABEL, **params
        ).fit(train)
        save_model(fitted, output)
    return fitted, score(fitted, test)


def tuning_job(
    spark: SparkSession, table: str, model_path: str, board_path: str,
    names: Sequence[str] = tuple(MODELS), encoding: str = "one_hot", fmt: str | None = None,
    grids: Mapping[str, Mapping[str, Sequence]] = GRIDS,
    keys: Sequence[str] = tuple(schemas.MODEL_COLUMNS),
) -> tuple[PipelineModel, DataFrame]:
    """Tune on 80 percent of the key space; store the best model and the leaderboard.

    The best is the one with the highest validated R2.
    """
    with job(spark):
        train, test = hash_split(read_stage(spark, table, fmt), 80, *keys)
        board, best = tune(
            spark, train, test, schemas.CATEGORICAL, schemas.NUMERIC, schemas.LABEL, names,
            encoding, grids,
        )
        write_stage(board, board_path, fmt)
        first = max(board.collect(), key=lambda r: r["validation_r2"])  # a row per model
        save_model(best[first["model_name"]], model_path)
    return best[first["model_name"]], read_stage(spark, board_path, fmt)


def form_rows(form: DataFrame) -> DataFrame:
    """Rows of form labels as model inputs, in the codes of the training data."""
    return conform(
        form.withColumns({
            "payment_type": form_code(F.col("payment_type"), FORM_PAYMENT),
            "pickup_day_of_week": form_code(F.col("pickup_day_of_week"), FORM_WEEKDAY),
            "is_holiday": form_code(F.col("is_holiday"), FORM_YES_NO),
            "near_airport": form_code(F.col("near_airport"), FORM_YES_NO),
            "time_of_day_bin": form_term(F.col("time_of_day_bin")),
        }),
        schemas.SCORING_ROW,
    )


def scoring_job(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predictions for rows with the 12 model inputs."""
    ready = conform(rows, schemas.SCORING_ROW)
    return score(model, ready).select(
        *schemas.SCORING_ROW.names, F.col("prediction").alias("predicted_total")
    )
