import math

import numpy as np
import pytest

from tripengine.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Every entry compared with every part, in whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0], kept[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            books[p] = [[sum(c[p][j] for c, o in zip(cut, own, strict=True) if o == i) // own.count(i)
                         for j in range(size)] if i in own else e for i, e in enumerate(books[p])]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    return sorted((i, "".join(f"{e:02x}" for _, e in f), error, by_label[label])
                  for (i, _, label), f, error in zip(kept, found, errors, strict=True)), books


@pytest.mark.parametrize("n,size,spread", [(64, 4, 40), (64, 4, 2), (64, 1, 300), (7, 3, 5), (1, 4, 9), (64, 8, 100_000)])
def test_nearest_entry_against_all_entries(n, size, spread):
    rng = np.random.default_rng(n * size)
    entries = rng.integers(-spread, spread + 1, (n, size))
    points = np.concatenate([rng.integers(-3 * spread, 3 * spread + 1, (2000, size)), entries])
    index, found = vectors.Codebook(entries).nearest(points)
    whole = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert index.tolist() == whole.argmin(axis=1).tolist()  # argmin takes the first of equals
    assert found.tolist() == whole.min(axis=1).tolist()


def test_largest_numbers_do_not_overflow():
    far = vectors.LARGEST
    entries = np.array([[-far] * 4, [far] * 4, [far] * 4])
    index, found = vectors.Codebook(entries).nearest(np.array([[far] * 4, [-far] * 4, [0] * 4, [far, -far, 0, far]]))
    assert index.tolist() == [1, 0, 0, 1]
    assert found.tolist() == [0, 0, 4 * far * far, 5 * far * far]


@pytest.mark.parametrize("count", [300, 20])
def test_codes_against_brute_force(session, count):
    rng = np.random.default_rng(count)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=32)], int(rng.integers(4)) or None)
            for i in rng.permutation(count)]
    rows += [(500, None, 1), (501, [], 1), (502, [None] + [0.0] * 31, 1), (503, [float("nan")] + [0.0] * 31, 2),
             (504, [float("-inf")] + [0.0] * 31, None)]
    frame = session.createDataFrame(rows, SCHEMA).repartition(5).withColumn("Code", vectors.F.lit(1))
    codes, books = vectors.compress(frame)
    want, want_books = brute(rows)
    assert books.tolist() == want_books
    got = vectors.with_label_error(codes).select("vec_id", "code", "error", "label_error")
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(set(w[1] for w in want)) > 10


def test_repeated_rows_ties_and_odd_lengths(session):
    rows = [(1, [0.5, 0.25, -0.5], 1)] * 3 + [(2, [0.5, 0.25, -0.5], None), (None, [0.0, 0.0, 1.0], None),
                                             (3, [1.0], 1), (4, [1e30, -1e30, 0.0], 1)]
    codes, books = vectors.compress(session.createDataFrame(rows, SCHEMA), parts=2, entries=4, rounds=1)
    assert books.shape == (2, 4, 2)
    got = sorted(((r.vec_id, r.code, r.error) for r in codes.collect()), key=str)
    # of four equal first entries the lowest takes all and moves away; the next one stays
    assert [g for g in got if g[0] in (1, 2)] == [(1, "0101", 0)] * 3 + [(2, "0101", 0)]
    assert len(got) == 6  # the vector of another length is dropped
    assert vectors.decode("0101", books).tolist() == [128, 64, -128, 0]


def test_empty_table(session):
    frame = session.createDataFrame([(1, None, 1)], SCHEMA)
    codes, books = vectors.compress(frame)
    assert vectors.with_label_error(codes).collect() == [] and books.size == 0
