import hashlib
import random
import zlib

import numpy as np
import pytest

from tripengine.llm import runs


def brute_runs(words, least=24, times=3):
    """Every period's maximal stretches, kept where the period is their smallest."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(text, doc_id):
    words = (text or "").encode().split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(text, doc_id)
    found = brute_runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(words, found)).hexdigest())


def found_in(words, least=24, times=3):
    [got] = runs.of_texts([" ".join(words)], least, times)
    return [(r["start"], r["length"], r["period"]) for r in got["runs"]], got["collapsed"]


def nested(rng, depth):
    """Words made of repeats of repeats, with breaks: progressions inside progressions."""
    if depth == 0:
        return [rng.choice("abc") for _ in range(rng.randint(1, 4))]
    out = []
    for _ in range(rng.randint(1, 3)):
        out += nested(rng, depth - 1) * rng.choice((1, 2, 3, 5, 9))
        if rng.random() < 0.5:
            out.append(rng.choice("abcd"))
    return out


@pytest.mark.parametrize("seed", range(150))
def test_all_runs_against_brute_force(seed):
    rng = random.Random(seed)
    words = nested(rng, 3)[:1500] if seed % 3 else [rng.choice("ab") for _ in range(rng.randint(0, 400))] \
        + [str(i) for i in range(rng.randint(1, 9))] * rng.randint(1, 40)
    want = brute_runs(words)
    got, collapsed = found_in(words)
    assert got == want
    assert collapsed == brute_collapsed([w.encode() for w in words], want)


@pytest.mark.parametrize("least,times", [(3, 3), (8, 3), (12, 4), (40, 3)])
def test_other_bounds(least, times):
    rng = random.Random(least)
    for _ in range(40):
        words = nested(rng, 2)[:300]
        assert found_in(words, least, times)[0] == brute_runs(words, least, times)


def test_batches_never_join_texts():
    text = "x y " * 30
    many = runs.of_texts([text, None, "", text, "a", text * 2], batch_words=50)
    assert [[tuple(r.values()) for r in m["runs"]] for m in many] == \
        [[(0, 60, 2)], [], [], [(0, 60, 2)], [], [(0, 120, 2)]]
    assert [m["collapsed"] for m in many] == [b"x y", b"", b"", b"x y", b"a", b"x y"]


def test_wavelet_tree_against_sorting():
    rng = np.random.default_rng(1)
    values = rng.permutation(333)
    tree = runs.WaveletTree(values)
    low = rng.integers(0, 333, 500)
    high = np.array([rng.integers(x, 334) for x in low])
    above = rng.integers(-1, 333, 500)
    want = [min((v for v in values[a:b] if v > x), default=np.iinfo(np.int64).max)
            for a, b, x in zip(low, high, above, strict=True)]
    assert tree.successor(low, high, above).tolist() == want


def test_long_periodic_text_is_bounded():
    words = [f"w{i}" for i in range(50_000)] * 4 + ["same"] * 200_000
    assert found_in(words)[0] == [(0, 200_000, 50_000), (200_000, 200_000, 1)]


def test_columns_and_odd_rows(session):
    rows = [(1, "q " * 30, "a", 1), (1, "q " * 30, "a", 1), (None, None, None, None), (2, "", "b", 2)]
    docs = session.createDataFrame(rows, "doc_id long, text string, source string, FOUND int")
    got = runs.with_runs(docs)
    assert got.columns == ["doc_id", "text", "source", "FOUND", "runs", "collapsed"]
    assert sorted((r.doc_id or 0, r.FOUND, len(r.runs), r.collapsed) for r in got.collect() if r.FOUND) == \
        [(1, 1, 1, "q"), (1, 1, 1, "q"), (2, 2, 0, "")]
    clash = docs.withColumnRenamed("source", "Runs")
    assert runs.with_runs(clash).columns == ["doc_id", "text", "FOUND", "runs", "collapsed"]
    assert runs.with_runs(docs.limit(0)).collect() == []


def test_query_against_brute_force(session, tmp_path):
    from tripengine.llm.common import QUERIES
    rng = random.Random(5)
    texts = [None, "", " \t", "a", "one two three " * 9, "\n".join(["l1 l2", "x"] * 20),
             "b " * 23, "b " * 24, "é ß " * 50]
    rows = [(i, texts[i] if i < len(texts) else " ".join(
        rng.choice("abcdefgh") for _ in range(rng.randint(0, 300)))) for i in range(160)]
    rows += [rows[5], rows[5], (None, "n " * 40), (None, None)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    session.createDataFrame(rows, "doc_id long, text string").withColumn("N_Runs", runs.F.lit("x")) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in QUERIES["op12_periodic_runs"].run(session, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t in rows), key=str)
