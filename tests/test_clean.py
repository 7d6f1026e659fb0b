import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tests.conftest import rows
from tripengine import schemas
from tripengine.operators import clean


def test_rounding_keeps_values_from_a_thousand_on_and_ties_to_even(spark):
    df = spark.createDataFrame([(1234.57,), (999.99,), (0.125,), (0.375,), (None,)], "c double")
    got = [r[0] for r in clean.round_half_even(df, {"c": 2}).collect()]
    assert got == [1234.57, 999.99, 0.12, 0.38, None]


def test_the_formatted_number_detour_would_lose_them(spark):
    # what rounding through text does: the thousands comma cannot be cast back
    df = spark.createDataFrame([(1234.57,)], "c double")
    assert df.select(F.format_number("c", 2).try_cast("double")).first()[0] is None


def test_sentinels_become_null_in_text_columns_only(spark):
    df = spark.createDataFrame([(264, "N/A", "x"), (1, "EWR", "N/A")], "id int, a string, b string")
    assert rows(clean.null_sentinels(df, "N/A"), "id") == [(1, "EWR", None), (264, None, "x")]


def test_conform_casts_and_orders(spark):
    df = spark.createDataFrame([("2", 1.0, "x")], "b string, a double, c string")
    target = StructType([StructField("a", schemas.INT), StructField("b", schemas.DOUBLE)])
    out = clean.conform(df, target)
    assert out.dtypes == [("a", "int"), ("b", "double")] and out.first() == (1, 2.0)
    bad = StructType([StructField("c", schemas.INT)])
    assert clean.conform(df, bad, lenient=True).first()[0] is None
    with pytest.raises(Exception):
        clean.conform(df, bad).collect()


def test_numeric_columns_are_listed_once_without_the_target(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "x")], "a int, a_index double, y double, t string")
    names = clean.numeric_columns(df, without=["y"])
    assert names == ["a", "a_index"] and len(set(names)) == len(names)


def test_hash_split_is_complete_and_repeatable(spark):
    df = spark.range(5000)
    train, test = clean.hash_split(df, 80, "id")
    assert train.count() + test.count() == 5000 and 3800 < train.count() < 4200
    assert train.join(test, "id").count() == 0
    again, _ = clean.hash_split(df.repartition(5), 80, "id")
    assert rows(again) == rows(train)
    assert set(rows(clean.hash_sample(df, 10, "id"))) <= set(rows(train))
