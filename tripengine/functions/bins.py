"""Rule-based bins and fixed-width buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_column(
    source: Column,
    rules: Sequence[tuple[str, Column]],
    default: str,
    null_label: str | None = None,
) -> Column:
    """First rule that holds names the bin, else ``default``.

    A null source holds for no rule and so gets ``default``, unless
    ``null_label`` gives it a bin of its own.
    """
    chain = F.when(F.lit(False), F.lit(None))
    if null_label is not None:
        chain = F.when(source.isNull(), null_label)
    for label, rule in rules:
        chain = chain.when(rule, label)
    return chain.otherwise(default)


def distance_bin(column: str = "trip_distance", null_label: str | None = None) -> Column:
    c = F.col(column)
    return bin_column(c, [("Short", c <= 2), ("Medium", c <= 5)], "Long", null_label)


def temperature_bin(column: str = "temp", null_label: str | None = None) -> Column:
    c = F.col(column)
    rules = [("Cold", c <= 10), ("Cool", c <= 20), ("Warm", c <= 30)]
    return bin_column(c, rules, "Hot", null_label)


def time_of_day_bin(column: str = "pickup_hour", null_label: str | None = None) -> Column:
    c = F.col(column)
    rules = [
        ("Late Night", c.between(0, 5)),
        ("Morning", c.between(6, 11)),
        ("Afternoon", c.between(12, 17)),
    ]
    return bin_column(c, rules, "Evening", null_label)


def season(month: Column, null_label: str | None = None) -> Column:
    rules = [
        ("Winter", month.isin(12, 1, 2)),
        ("Spring", month.isin(3, 4, 5)),
        ("Summer", month.isin(6, 7, 8)),
    ]
    return bin_column(month, rules, "Fall", null_label)


def near_airport(*service_zones: str, marker: str = "Airports") -> Column:
    """1 when any of the zones is an airport zone; a null zone counts as none."""
    hits = [F.coalesce(F.col(c) == marker, F.lit(False)) for c in service_zones]
    flag = hits[0]
    for hit in hits[1:]:
        flag = flag | hit
    return flag.cast("int")


def cut_bin(column: str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bins between cut points; null stays null."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("one label more than cut points is needed")
    c = F.col(column)
    rules = [(label, c < cut) for label, cut in zip(labels, cuts)]
    return F.when(c.isNotNull(), bin_column(c, rules, labels[-1]))


# Cut points of the two frequency tables, labels of the fares, and
# names of the distance classes.
DISTANCE_CUTS = [2, 5, 10, 20]
FARE_CUTS, FARE_LABELS = (
    [10, 20, 50, 100], ["$0-10", "$10-20", "$20-50", "$50-100", "$100+"])
CLASSES = ["Very High (>20 {})", "High (10-20 {})", "Average (5-10 {})", "Low (1-5 {})",
           "Very Low (<1 {})"]


def distance_labels(unit: str = "miles") -> list[str]:
    """Labels of ``DISTANCE_CUTS`` in the unit the column is measured in."""
    edges = [0, *DISTANCE_CUTS]
    return [f"{a}-{b} {unit}" for a, b in zip(edges, DISTANCE_CUTS)] + [f"{edges[-1]}+ {unit}"]


DISTANCE_LABELS = distance_labels()


def distance_category(column: str = "trip_distance", unit: str = "miles") -> Column:
    """Five named distance classes; exactly 1 and null are in the lowest."""
    c = F.col(column)
    *names, lowest = [name.format(unit) for name in CLASSES]
    rules = list(zip(names, [c > 20, c >= 10, c >= 5, c > 1]))
    return bin_column(c, rules, lowest)


def width_bucket_floor(column: str, width: float) -> Column:
    """Lower edge of the fixed-width bucket a value falls in."""
    return F.floor(F.col(column) / width) * width
