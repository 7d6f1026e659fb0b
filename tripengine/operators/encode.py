"""Feature encodings as Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    PCA,
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    TargetEncoder,
    VectorAssembler,
)

ENCODINGS = ("one_hot", "ordinal", "target_mean", "one_hot_pca")


def refuse_label(inputs: Sequence[str], label: str) -> None:
    """The label must not be among the features."""
    if label in inputs or f"{label}_index" in inputs:
        raise ValueError(f"label {label!r} is among the features")


def indexer(columns: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """Ordinal codes, most frequent value first, ties in text order."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def one_hot(columns: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_encoded" for c in columns],
        dropLast=drop_last,
        handleInvalid="keep",
    )


def target_mean(columns: Sequence[str], label: str) -> TargetEncoder:
    """Category means of the label; the overall mean for unseen categories."""
    return TargetEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_target" for c in columns],
        labelCol=label,
        targetType="continuous",
        smoothing=0.0,
        handleInvalid="keep",
    )


def assemble(inputs: Sequence[str], output: str = "features", label: str | None = None,
             handle_invalid: str = "error") -> VectorAssembler:
    if label is not None:
        refuse_label(inputs, label)
    return VectorAssembler(
        inputCols=list(inputs), outputCol=output, handleInvalid=handle_invalid
    )


def standardise(source: str = "features", output: str = "scaledFeatures") -> StandardScaler:
    """Divide by the sample deviation, without centring."""
    return StandardScaler(inputCol=source, outputCol=output, withStd=True, withMean=False)


def min_max(source: str = "features", output: str = "scaled_features") -> MinMaxScaler:
    return MinMaxScaler(inputCol=source, outputCol=output)


def principal(k: int = 10, source: str = "scaledFeatures", output: str = "pcaFeatures") -> PCA:
    return PCA(k=k, inputCol=source, outputCol=output)


def encoding_stages(
    encoding: str, categorical: Sequence[str], numeric: Sequence[str], label: str,
    components: int = 10,
) -> tuple[list, str]:
    """Stages of one encoding and the name of its feature column."""
    stages = [indexer(categorical)]
    if encoding == "ordinal":
        encoded = [f"{c}_index" for c in categorical]
    elif encoding == "target_mean":
        stages.append(target_mean(categorical, label))
        encoded = [f"{c}_target" for c in categorical]
    elif encoding in ("one_hot", "one_hot_pca"):
        stages.append(one_hot(categorical, drop_last=False))
        encoded = [f"{c}_encoded" for c in categorical]
    else:
        raise ValueError(f"unknown encoding {encoding!r}, one of {ENCODINGS}")
    stages += [assemble([*encoded, *numeric], label=label), standardise()]
    if encoding == "one_hot_pca":
        return [*stages, principal(components)], "pcaFeatures"
    return stages, "scaledFeatures"


def importance_inputs(
    categorical: Sequence[str], numeric: Sequence[str], label: str
) -> tuple[Pipeline, list[str]]:
    """Ordinal codes, assembled and min-max scaled, with the feature names."""
    names = [*[f"{c}_index" for c in categorical], *numeric]
    if len(set(names)) != len(names):
        raise ValueError("a feature is listed twice")
    stages = [indexer(categorical)] if categorical else []
    return Pipeline(stages=[*stages, assemble(names, label=label), min_max()]), names
