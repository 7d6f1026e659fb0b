import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.llm.test_decontaminate import distance
from tests.llm.test_jaccard import brute
from tripengine.llm import bpe
from tripengine.llm import decontaminate as d

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and [s for s, _ in corpus_pipeline.STAGES] == [
        "language", "exact_dedup", "near_dedup", "decontaminate", "encode"]


def test_run_against_brute_force(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    own = [r for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)]
    first = {}
    for r in sorted(own, key=lambda r: r.doc_id):
        first.setdefault(" ".join(filter(None, [r.text])) and __import__("re").sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
    rows = [(r.doc_id, r.text) for r in first.values()]
    rows = [(i, t) for (i, t) in rows if (i, i) in {(a, c) for a, _, c in brute(rows, 5, 80)}]
    bench = [d.normal(r.text) for r in session.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bench = [b for b in bench if len(b) >= d.LEAST]

    def leaks(text):
        text = d.normal(text)
        grams = {text[i:i + d.Q] for i in range(len(text))}
        return any(any(b[i:i + d.Q] in grams for i in range(len(b)))
                   and distance(b[:d.WINDOW], text) <= len(b[:d.WINDOW]) * d.RATE // 100 for b in bench
                   if sum(b[i:i + d.Q] in grams for i in range(len(b))) > 15)

    want = {i: t for i, t in rows if not leaks(t)}
    library = Tokenizer.from_file(public_tokenizers.path(bpe.WORD_BPE))
    got = {r.doc_id: r for r in corpus_pipeline.run(session, SF).collect()}
    assert set(got) == set(want)
    for i, text in want.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert np.array(ids).size == got[i].n_tokens


def test_stages_keep_the_columns_and_odd_rows(session, docs_of):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34", "en"), (None, "words without an id", None),
            *((i, f"the words of text {i} are these and those " * 3, "en") for i in range(10, 16)),
            (10, "the words of text 10 are these and those " * 3, "en"), (20, "long " * 30_000, "en")]
    docs = docs_of(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(session, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    kept = sorted((r.doc_id for r in docs.collect()), key=str)
    assert None in kept and 20 in kept and not {1, 2, 3} & set(kept) and len(kept) == len(set(kept))
    coded = corpus_pipeline.encode(session, docs, SF)
    assert coded.count() == len(kept) and set(coded.columns) >= {"doc_id", "ids", "n_tokens"}


def test_one_of_each_component_stays_where_ids_repeat(session, docs_of):
    one, other = ("first words of a text number " + " ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(10, one + " end"), (11, one + " end more"), (5, other + " end"), (10, other + " end more"), (None, one)]
    kept = corpus_pipeline.near_dedup(session, docs_of(rows), SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(5, other + " end"), (10, one + " end")]


def test_empty_documents(session, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(session, docs, SF)
    assert docs.collect() == []


def test_near_copies_without_or_with_repeated_ids(session, docs_of):
    text = " ".join(f"word{i}" for i in range(100))
    rows = [(None, text + f" end{i}") for i in range(3)] + [(7, text + " a"), (7, text + " b"), (7, text + " b"),
            (8, "alone"), (None, "alone too here now and then"), (9, None), (9, "")]
    kept = corpus_pipeline.near_dedup(session, docs_of(rows), SF).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[-4:]) for r in kept if (r.text or "").startswith("word")) in (
        [(7, "99 a")], [(7, "99 b")])
    assert sorted(r.doc_id or 0 for r in kept if not (r.text or "").startswith("word")) == [0, 8, 9, 9]
    assert kept[0].__fields__ == docs_of(rows).columns
