import random
from collections import Counter

import pytest

from tripengine.operators import categories


@pytest.fixture(scope="module")
def many(spark):
    draw = random.Random(2)
    # a third of all rows in one category, thousands of rare ones, nulls; names that clash
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"c{draw.randrange(3000)}",
             draw.random() if i % 41 else None, i % 4, 7.0) for i in range(9000)]
    return rows, spark.createDataFrame(rows, "id int, value string, y double, fold int, code double")


def test_codes_are_ranks_by_count_then_value(many):
    rows, df = many
    counts = Counter(v for _, v, *_ in rows if v is not None)
    want = {v: i for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    codes = categories.frequency_codes(df, "value")
    assert {r.value: r.code for r in codes.collect()} == want
    found = categories.with_codes(df, codes, "value")
    assert found.columns == [*df.columns, "value_index"]
    assert {r.id: r.value_index for r in found.collect()} == {i: want.get(v, len(want)) for i, v, *_ in rows}


def test_values_are_not_brought_into_one_task(many, monkeypatch):
    plans, write = {}, categories.materialise

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(categories, "materialise", seen)
    categories.frequency_codes(many[1], "value")
    assert "rangepartitioning" in plans["places"]
    assert not any("SinglePartition" in plans[name] for name in ("places", "codes"))


def test_numbers_of_a_wide_range(spark):
    codes = categories.frequency_codes(spark.range(200_000).selectExpr("id % 50000 AS part"), "part")
    assert codes.count() == 50_000
    assert {(r.value, r.code) for r in codes.where("code IN (0, 777, 49999)").collect()} == {
        (0, 0), (777, 777), (49999, 49999)}


@pytest.mark.parametrize("smoothing", [0.0, 3.0])
def test_out_of_fold_means_leave_the_own_fold_out(many, smoothing):
    rows, df = many
    found = categories.out_of_fold_means(df, "value", "y", "fold", smoothing=smoothing)
    assert found.columns == [*df.columns, "value_target"]
    got = {r.id: r.value_target for r in found.collect()}
    sums, folds = {}, {}
    for _, v, y, f, _ in rows:
        if y is not None:
            for held, key in ((sums, v), (folds, None)):
                for g in range(4):
                    if g != f:
                        t, n = held.get((key, g), (0.0, 0))
                        held[key, g] = t + y, n + 1
    assert len(got) == len(rows)
    for i, v, _, f, _ in rows:
        prior = folds[None, f][0] / folds[None, f][1]
        t, n = sums.get((v, f), (0.0, 0))
        want = (t + smoothing * prior) / (n + smoothing) if n + smoothing else prior
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_means_for_new_rows(many, spark):
    rows, df = many
    means = categories.label_means(df, "value", "y")
    hot = [y for _, v, y, *_ in rows if v == "hot" and y is not None]
    new = spark.createDataFrame([("hot",), ("never seen",), (None,)], "value string")
    got = {r.value: r.value_target for r in categories.with_means(new, means, "value").collect()}
    assert got["hot"] == pytest.approx(sum(hot) / len(hot)) and got["never seen"] is None and got[None] is not None


def test_empty_table(many):
    none = many[1].where("id < 0")
    codes = categories.frequency_codes(none, "value")
    assert codes.collect() == [] and categories.with_codes(none, codes, "value").collect() == []
    assert categories.out_of_fold_means(none, "value", "y", "fold").collect() == []
