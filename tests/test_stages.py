from datetime import date, datetime

import pytest

from tests.conftest import rows
from tripengine.plans.queries_stages import snk_01_bucketed
from tripengine.session import begin_sizing
from tripengine.sources import stages
from tripengine.sources.files import read_stage


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partitions_read(df):
    """Partition folders that the scans of an executed plan opened."""
    df.collect()
    found, open_plans = [], [df._jdf.queryExecution().executedPlan()]
    while open_plans:
        plan = open_plans.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            open_plans.append(plan.executedPlan())
        elif name.endswith("QueryStage"):
            open_plans.append(plan.plan())
        else:
            if plan.metrics().contains("numPartitions") and name.startswith("Scan"):
                found.append(plan.metrics().apply("numPartitions").value())
            children = plan.children()
            open_plans += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture(scope="module")
def monthly(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stages") / "monthly")
    trips = spark.createDataFrame(
        [(m * 100 + d, datetime(2023, m, d, 23, 59)) for m in range(1, 13) for d in (1, 15, 28)] + [(0, None)],
        "id long, at timestamp")
    stages.write_monthly_stage(trips, path, "at", "parquet")
    return path


def test_a_range_of_dates_opens_its_months(spark, monthly):
    got = stages.during(read_stage(spark, monthly, "parquet"), "at", "2023-03-15", "2023-05-01")
    assert [r[0] for r in rows(got.select("id"), "id")] == [315, 328, 401, 415, 428, 501]
    assert _partitions_read(got) == [3]


def test_a_calendar_prunes_months_while_running(spark, monthly, tmp_path):
    calendar = str(tmp_path / "calendar")
    spark.createDataFrame([(date(2023, 3, 1), "a"), (date(2023, 3, 28), "b"), (date(2023, 12, 15), "a"),
                           (date(2023, 7, 2), "a")], "day date, name string").write.parquet(calendar)
    days = spark.read.parquet(calendar).where("name = 'a'")
    got = stages.on_days(read_stage(spark, monthly, "parquet"), days, "at", "day").select("id", "name")
    assert "dynamicpruning" in _plan(got)
    assert _partitions_read(got) == [3]
    assert rows(got) == [(301, "a"), (1215, "a")]


def test_a_month_that_comes_again_replaces_itself(spark, monthly):
    again = spark.createDataFrame([(1, datetime(2023, 2, 3))], "id long, at timestamp")
    before = read_stage(spark, monthly, "parquet").count()
    stages.write_monthly_stage(again, monthly, "at", "parquet", only_given=True)
    stage = read_stage(spark, monthly, "parquet")
    assert stage.count() == before - 2
    assert rows(stages.during(stage, "at", "2023-02-01", "2023-02-28").select("id")) == [(1,)]


def test_buckets_meet_without_an_exchange(spark, tmp_path):
    left = spark.range(1000).selectExpr("id AS order_key", "id * 2 AS a")
    right = spark.range(3000).selectExpr("id % 1000 AS order_key", "id AS b")
    for name, df in (("left_stage", left), ("right_stage", right)):
        stages.write_bucketed_stage(df, name, str(tmp_path / name), ["order_key"], 4)
    one, other = (stages.read_bucketed_stage(spark, n, keep_name=False) for n in ("left_stage", "right_stage"))
    assert len(one.inputFiles()) == 4 and not spark.catalog.tableExists("left_stage")
    joined = one.hint("merge").join(other, "order_key").groupBy("order_key").sum("a", "b")
    assert joined.where("`sum(a)` <> 6 * order_key OR `sum(b)` <> 3 * order_key + 3000").count() == 0
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)


def test_the_registered_query_meets_without_an_exchange(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        begin_sizing(spark)
        got = snk_01_bucketed(spark, "/root/testdata/sf0.001")
        assert "Exchange" not in _plan(got) and got.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
