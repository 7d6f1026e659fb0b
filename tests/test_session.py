from pathlib import Path

import pytest

from tripengine import session


def test_settings_are_applied(spark):
    for name, value in session.SETTINGS.items():
        assert spark.conf.get(name) == value


def test_scratch_lies_in_the_shared_folder(spark):
    a, b = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert a != b and a.startswith(session.shared_folder(spark))
    assert session.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf(dict):
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_a_materialised_table_has_its_true_size(spark):
    df = spark.range(100_000).selectExpr("id % 3 AS k").groupBy("k").count()
    kept = session.materialise(df)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect()))
    size = kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 100_000


def test_task_counts_follow_the_tables_read(spark, tmp_path, monkeypatch):
    spark.range(10_000).write.parquet(str(tmp_path / "t"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scan = spark.conf.get("spark.sql.files.maxPartitionBytes")
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.begin_sizing(spark)
    assert session.add_input(spark, str(tmp_path / "t")) == least == int(spark.conf.get(name))
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 10)
    many = session.add_input(spark, str(tmp_path / "t"))
    assert many > 1000 and session.add_input(spark, str(tmp_path / "t")) > many
    session.begin_sizing(spark)
    assert int(spark.conf.get(name)) == least
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == scan
    spark.conf.unset(name)


def test_a_job_pins_settings_and_leaves_no_working_tables(spark, tmp_path):
    folder = session.shared_folder(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    with session.job(spark):
        made = session.materialise(spark.range(3), "gone")
        assert made.count() == 3 and list(Path(folder).glob("gone-*"))
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert not list(Path(folder).glob("gone-*"))
