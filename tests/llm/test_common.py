import pytest

from tripengine import session as settings
from tripengine.llm import jaccard
from tripengine.llm.bpe import Remembered
from tripengine.llm.common import begin, query, table

SF = "/root/testdata/sf0.001"
START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture()
def own_start(session):
    before = session.conf.get(START)
    yield session
    session.conf.set(START, before)


def test_shuffles_start_with_partitions_for_the_tables_read(own_start, monkeypatch):
    monkeypatch.setattr(settings, "SHUFFLE_BYTES", 8 << 10)
    own_start.conf.set(START, "1234")  # as an earlier query may leave it
    begin(own_start, SF)
    assert own_start.conf.get(START) == own_start.conf.get("spark.sql.shuffle.partitions")
    table(own_start, SF, "documents")
    once = int(own_start.conf.get(START))
    assert once > int(own_start.conf.get("spark.sql.shuffle.partitions"))
    begin(own_start, SF, "documents")
    assert int(own_start.conf.get(START)) == once


def test_exchanges_of_an_operator_follow(own_start, monkeypatch):
    monkeypatch.setattr(settings, "SHUFFLE_BYTES", 8 << 10)
    begin(own_start, SF)
    docs = table(own_start, SF, "documents")
    plans, write = [], jaccard.materialise

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(jaccard, "materialise", seen)
    jaccard.signature_groups(docs, 3, 90)
    assert f", {own_start.conf.get(START)})" in plans[0]


def test_long_words_are_forgotten_by_their_characters(monkeypatch):
    monkeypatch.setattr("tripengine.llm.bpe.REMEMBERED_CHARS", 10_000)
    held = Remembered(lambda words: [len(w) for w in words])
    for i in range(100):
        own = [f"{i}-{j}" * 500 for j in range(4)]
        of = held.of(own)
        assert [of(w) for w in own] == [len(w) for w in own]
        assert sum(map(len, held.results)) + sum(map(len, held.old)) < 40_000


def test_a_query_starts_anew(own_start):
    own_start.conf.set(START, "1234")
    query("test_only")(lambda spark, sf: None)
    from tripengine.llm.common import QUERIES
    QUERIES.pop("test_only").run(own_start, SF)
    assert own_start.conf.get(START) == own_start.conf.get("spark.sql.shuffle.partitions")
