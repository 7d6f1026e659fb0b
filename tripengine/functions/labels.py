"""Code and label lookups shared by training data and scoring input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes and their labels.
PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}

# Codes for the labels of the scoring form. The weekday codes
# are those of ``dayofweek`` on the training data (1 is Sunday).
FORM_PAYMENT = {"Card": 1, "Cash": 2}
FORM_YES_NO = {"Yes": 1, "No": 0}
FORM_WEEKDAY = {
    "Sunday": 1, "Monday": 2, "Tuesday": 3, "Wednesday": 4, "Thursday": 5,
    "Friday": 6, "Saturday": 7,
}
# The form says "Night" where the training data says "Late Night".
FORM_TIME_OF_DAY = {"Night": "Late Night"}


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def code_label(code: Column, mapping: Mapping[int, str] = PAYMENT_LABELS) -> Column:
    """Label of an integer code given as number or text; unknown codes are null."""
    return F.try_element_at(literal_map(mapping), code.try_cast("int"))


def form_code(label: Column, mapping: Mapping[str, int]) -> Column:
    """Code of a form label; an unknown label is 0."""
    return F.coalesce(F.try_element_at(literal_map(mapping), label), F.lit(0))


def form_term(label: Column, mapping: Mapping[str, str] = FORM_TIME_OF_DAY) -> Column:
    """The training data's word for a form label, the label itself by default."""
    return F.coalesce(F.try_element_at(literal_map(mapping), label), label)
