import random

import numpy as np
import pytest

from tripengine.llm import jaccard
from tripengine.llm.components import components


def shingles(text, width):
    own = (text or "").encode().lower().split()
    if not own:
        return frozenset()
    return frozenset(tuple(own[i:i + width]) for i in range(max(1, len(own) - width + 1)))


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    of = list(range(len(rows)))

    def top(i):
        while of[i] != i:
            i = of[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                of[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(
        zip(rows, sets, strict=True))), key=str)


def found(df, width, percent):
    return sorted((tuple(r) for r in jaccard.near_duplicates(df, width, percent).select(
        "doc_id", "n_shingles", "component_id").collect()), key=str)


def cloud(seed, count, length, edits):
    """Texts that stem from one another by few edits, so that links form chains."""
    draw = random.Random(seed)
    texts = [[f"w{draw.randrange(400)}" for _ in range(length)]]
    while len(texts) < count:
        new = list(draw.choice(texts))
        for _ in range(draw.randrange(edits + 1)):
            at = draw.randrange(len(new))
            new[at:at + draw.randrange(2)] = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(3))]
        texts.append(new or ["w"])
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize(("width", "percent", "frequent", "block"), [(3, 90, 24, 1024), (5, 80, 3, 4)])
def test_components_against_brute_force(docs_of, monkeypatch, width, percent, frequent, block):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)  # in these tasks' processes only where forked
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = cloud(1, 90, 60, 3) + cloud(2, 60, 12, 1) + cloud(3, 40, 300, 12) + cloud(4, 40, 4, 1)
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    assert found(docs_of(rows), width, percent) == brute(rows, width, percent)


def test_odd_rows(docs_of, session):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two"),
            (7, "a b c d"), (7, "a b c d"), (7, "other words here now"), (8, "k " * 40_000), (9, "K " * 50_000),
            (None, "just null"), (None, "just null")]
    assert found(docs_of(rows), 3, 90) == brute(rows, 3, 90)
    assert found(docs_of([]), 3, 90) == []
    odd = session.createDataFrame([(1, "x y z", 5, 6)], "doc_id long, text string, sid long, component_id long")
    assert found(odd, 3, 90) == [(1, 1, 1)]


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature(percent):
    scheme, draw = jaccard.Scheme(percent), np.random.default_rng(3)
    for size in [1, 2, 3, 5, 9, 10, 11, 20, 40, 41, 100, 500, 2000]:
        for _ in range(40):
            a = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64))
            gone = draw.integers(0, max(1, size // 5) + 1)
            new = draw.integers(0, max(1, size // 5) + 1)
            b = np.unique(np.concatenate([draw.permutation(a)[gone:], draw.integers(0, 1 << 63, new).astype(np.uint64)]))
            if not len(b) or not scheme.link(a, b):
                continue
            shared = np.intersect1d(scheme.signatures(a), scheme.signatures(b))
            assert len(shared), (len(a), len(b))
            d = jaccard.differing(scheme.sketch(a), scheme.sketch(b))
            assert scheme.may_link(np.array([len(a)]), np.array([len(b)]), np.array([d]))[0]


def test_sets_with_empty_parts_still_meet():
    # features that all fall into one part, so that most parts are empty
    scheme = jaccard.Scheme(80)
    a = np.arange(1, 41, dtype=np.uint64)
    b = np.arange(1, 41, dtype=np.uint64) + np.uint64(2)
    assert scheme.link(a, b)
    assert len(np.intersect1d(scheme.signatures(a), scheme.signatures(b)))


def test_subsets_of_pieces(monkeypatch):
    monkeypatch.setattr(jaccard, "PIECES", 3)
    monkeypatch.setattr(jaccard, "SPARE", 1)
    test_linked_sets_share_a_signature(90)


def test_connected_components(session):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [
        (draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    of = {n: n for pair in links for n in pair}
    for _ in of:
        for a, b in links:
            of[a] = of[b] = min(of[a], of[b])
    got = {r.node: r.root for r in components(session.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: of[n] for n in linked}
    assert components(session.createDataFrame([], "a long, b long")).collect() == []


def test_large_groups_of_unequal_members(docs_of, monkeypatch):
    """Members of one group that do not all link: stars are repeated, the rest is compared."""
    monkeypatch.setattr(jaccard, "LARGE", 4)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    draw = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(80):  # a common half, and a few of many small changes in the other
        own = list(base)
        for _ in range(draw.randrange(5)):
            own[draw.randrange(40, 80)] = f"x{draw.randrange(60)}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    assert len({r[2] for r in brute(rows, 3, 90)}) > 3
    assert found(docs_of(rows), 3, 90) == brute(rows, 3, 90)


def test_rest_rows_do_not_grow_with_pairs(docs_of, monkeypatch):
    """Where three quarters of all pairs of a large group link, stars leave little to compare."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        own = list(base)
        for _ in range(draw.randrange(1, 3)):
            own[draw.randrange(200)] = f"y{i}"
        rows.append((i, " ".join(own)))
    seen, rest = [], jaccard.rest_pairs
    monkeypatch.setattr(jaccard, "rest_pairs", lambda *a: seen.append(rest(*a)) or seen[-1])
    assert found(docs_of(rows), 3, 90) == brute(rows, 3, 90)
    assert seen[0].count() < 10 * len(rows)


def test_pairs_of_a_large_group_that_pass_the_sketch_and_do_not_link_are_no_rows(docs_of, monkeypatch):
    draw = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        own = list(base)
        for at in draw.sample(range(200), 1 if i % 30 == 0 else 2):
            own[at] = f"y{i}"
        rows.append((i, " ".join(own)))
    seen, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *a: seen.append(pairs.count()) or verified(pairs, *a))
    assert found(docs_of(rows), 3, 90) == brute(rows, 3, 90)
    assert seen[-1] < 3 * len(rows)


@pytest.mark.parametrize("facing", [False, True])
def test_links_of_a_cell_span_its_components(facing):
    scheme, draw = jaccard.Scheme(80), np.random.default_rng(8)
    sets, base = [], draw.integers(0, 1 << 63, 60).astype(np.uint64)
    for _ in range(70):
        new = draw.integers(0, 1 << 63, draw.integers(1, 9)).astype(np.uint64)
        sets.append(np.unique(np.concatenate([draw.permutation(base)[len(new):], new])))
    sid, root, own = np.arange(70) + 100, np.arange(70) // 2, np.arange(70) % 2
    a, b = jaccard.spanning(scheme, sid, root, own, sets, facing)
    assert all(scheme.link(sets[i - 100], sets[j - 100]) and (not facing or i % 2 != j % 2)
               for i, j in zip(a, b, strict=True))

    def parts(links):
        of = root.copy()
        for i, j in links:
            of[of == of[j]] = of[i]
        return len(set(of.tolist())), {tuple(np.flatnonzero(of == r)) for r in of}

    every = [(i, j) for i in range(70) for j in range(i) if (not facing or own[i] != own[j])
             and scheme.link(sets[i], sets[j])]
    count, want = parts(every)
    assert parts([(i - 100, j - 100) for i, j in zip(a, b, strict=True)])[1] == want
    assert 1 < count and len(a) == 35 - count


def test_missing_and_repeated_ids_find_their_texts(docs_of):
    texts = cloud(7, 30, 60, 2)
    rows = [(None, t) for t in texts[:15]] + [(7, t) for t in texts[15:]]
    assert found(docs_of(rows), 3, 90) == brute(rows, 3, 90)
