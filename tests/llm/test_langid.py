import math
from collections import Counter

import numpy as np

from tripengine.llm import langid

TRAIN = [(i, t, lang) for i, (t, lang) in enumerate(
    [("the cat and the dog sat on the mat " * 3, "en"), ("le chat et le chien sont sur la table " * 3, "fr"),
     ("der hund und die katze liegen auf der matte " * 3, "de")] * 20)]


def brute_bits(texts, text):
    """Code length of ``text`` after ``texts``, one byte and one context at a time."""
    after = {}
    for t in texts:
        data = langid.START + t.encode()
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER + 1):
                after.setdefault(data[i - k:i], Counter())[data[i]] += 1
    data, bits = langid.START + text.encode(), 0.0
    for i in range(langid.ORDER, len(data)):
        for k in range(langid.ORDER, -1, -1):
            seen = after.get(data[i - k:i])
            if not seen:
                continue
            whole = seen.total() + len(seen)
            if n := seen.get(data[i]):
                bits += math.log2(whole / n)
                break
            bits += math.log2(whole / len(seen))
        else:
            bits += 8
    return bits


def test_code_lengths_against_brute_force(docs_of):
    trees = langid.fit(docs_of(TRAIN), sample_bytes=1 << 30)
    probes = ["the dog", "la table und", "xyz § é", "", "c"]
    want = [[brute_bits([t for _, t, x in TRAIN if x == lang], p) for lang in ("de", "en", "fr")] for p in probes]
    assert trees.languages == ["de", "en", "fr"]
    assert np.allclose(trees.bits([p.encode() for p in probes]), want, rtol=1e-5)


def test_long_texts_are_scored_in_pieces(docs_of):
    trees = langid.fit(docs_of(TRAIN))
    text = ("the cat " * 400_000).encode()
    part = trees.bits([text[:8000]])[0] / 8000
    assert np.allclose(trees.bits([b"a", text, b"b"])[1] / len(text), part, rtol=1e-2)


def test_predictions_and_odd_rows(docs_of):
    trees = langid.fit(docs_of([*TRAIN, (99, None, "en"), (98, "no language", None)]))
    rows = [(1, "the dog and the cat"), (2, "der hund"), (3, None), (4, ""), (5, "12 !? 3"), (5, "le chien"),
            (None, "sur la table")]
    found = sorted(((r.doc_id, r.lang_pred, 0 <= r.score <= 1) for r in
                    langid.predict(docs_of(rows), trees).collect()), key=str)
    assert found == sorted([(1, "en", True), (2, "de", True), (3, "und", True), (4, "und", True),
                            (5, "und", True), (5, "fr", True), (None, "fr", True)], key=str)
    kept = langid.known_language(docs_of(rows), trees)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 5, None], key=str)
    assert kept.columns == docs_of(rows).columns


def test_nothing_to_learn_from(docs_of, session):
    trees = langid.fit(docs_of([(1, "a text", None)]))
    assert [tuple(r)[2:] for r in langid.predict(docs_of([(1, "a text")]), trees).collect()] == [("und", 0.0)]
    assert langid.predict(docs_of([]), trees).collect() == []


def test_held_out_accuracy(session):
    from tripengine.llm.common import QUERIES
    import tripengine.llm.queries  # noqa: F401
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in session.read.parquet(f"{folder}/documents.parquet").collect()}
    found = [r for r in QUERIES["op6_language_id"].run(session, folder).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in found) >= 0.99 * len(found) > 100


def test_no_language_is_lost_to_the_sample(docs_of):
    """Long texts only, or none that the hash would draw: the shortest text stands for the language."""
    rows = [(i, f"these are the words of a plain text number {i} and some more of them " * 3, "en") for i in range(20)]
    rows += [(100 + i, f"to jest bardzo długi tekst po polsku numer {i} " * 2500, "pl") for i in range(3)]
    trees = langid.fit(docs_of(rows))
    assert trees.languages == ["en", "pl"]
    assert trees.predict(["to jest tekst po polsku"])[0][0] == "pl"
    assert langid.fit(docs_of(rows), sample_bytes=2).languages == ["en", "pl"]


def test_without_labels_texts_with_letters_stay(docs_of):
    docs = docs_of([(1, "words here"), (2, "12 34"), (3, None), (4, ""), (5, "слово")])
    kept = langid.known_language(docs, langid.fit(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5] and kept.columns == docs.columns
