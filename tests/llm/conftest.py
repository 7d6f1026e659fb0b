import pytest

from tripengine.llm.common import ready

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def session(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4")
    return ready(spark)


@pytest.fixture(scope="session")
def docs_of(session):
    """A documents table of (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        return session.createDataFrame(full, DOC)
    return make
