import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tripengine.llm import lm

ROWS = [(i, f"The cat number{i % 5} sat on the mat\tagain {'zz' * (i % 3)}") for i in range(60)] + [
    (60, None), (61, ""), (None, "unseen tokens only"), (62, "LONG " * 30_000), (62, "cat cat")]


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


@pytest.fixture(params=[1 << 17, 4])
def head(request, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", request.param)


def test_scores_against_brute_force(head, docs_of):
    docs = docs_of(ROWS)
    training = [r for r in ROWS if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 != 2]
    counts = Counter(t for _, text in training for t in tokens(text))
    model, table = lm.learn(docs.where(lm.remainder("doc_id", 7) != 2))
    total, distinct = sum(counts.values()), len(counts)
    got = sorted((tuple(r) for r in lm.score(docs, model, table).collect()), key=lambda r: (str(r[0]), r[2]))
    want, single = [], model.single
    own = lm.ClassOf(single)
    totals = Counter()
    for t, c in counts.items():
        totals[own[t]] += c + 1
    for doc_id, text in ROWS:
        out = zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens(text))
        score, a, b = 0.0, own[b" "], own[b" "]
        for t in tokens(text):
            c = own[t]
            score += model.network.log_probabilities(np.array([a]), np.array([b]))[0, c] / math.log(10)
            score += math.log10((counts[t] + 1) / (totals[c] + (c >= lm.SINGLE)))
            a, b = b, c
        want.append((doc_id, out, len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total, base, score))
    want.sort(key=lambda r: (str(r[0]), r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_probabilities_sum_to_one_after_training():
    draw = np.random.default_rng(1)
    trigrams = np.unique(draw.integers(0, lm.CLASSES**3, 5000))
    network = lm.LogBilinear().train(trigrams, np.ones(len(trigrams)), steps=50)
    logs = network.log_probabilities(np.arange(lm.CLASSES), np.arange(lm.CLASSES)[::-1])
    assert np.allclose(np.exp(logs).sum(axis=1), 1)


def test_training_learns_what_follows_what():
    # class 3 follows (1, 2), class 4 follows (2, 1)
    size = lm.CLASSES
    trigrams = np.array([(1 * size + 2) * size + 3, (2 * size + 1) * size + 4])
    network = lm.LogBilinear().train(trigrams, np.array([5.0, 5.0]), steps=600)
    logs = network.log_probabilities(np.array([1, 2]), np.array([2, 1]))
    assert logs[0, 3] > logs[0, 4] and logs[1, 4] > logs[1, 3] and logs[0, 3] > math.log(0.3)


def test_empty_tables(docs_of):
    model, table = lm.learn(docs_of([]))
    assert lm.score(docs_of([]), model, table).collect() == []
    row = lm.score(docs_of([(1, "a b")]), model, table).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert row.score < 0


def test_training_follows_the_training_tokens(docs_of, monkeypatch):
    made, train = [], lm.LogBilinear.train

    def counted(self, trigrams, counts, steps=lm.STEPS):
        made.append(steps)
        return train(self, trigrams, counts, min(steps, 5))

    monkeypatch.setattr(lm.LogBilinear, "train", counted)
    lm.learn(docs_of(ROWS))
    monkeypatch.setattr(lm, "STEP_TOKENS", 4)
    model, _ = lm.learn(docs_of(ROWS))
    assert made == [3000, model.train_tokens // 4] and made[1] > 3000
