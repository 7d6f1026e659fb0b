import hashlib
import random
import re
import time

import numpy as np

from tripengine.llm import pii

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    """The patterns as they are stated, and their checks."""
    found = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((kind, *m.span()))
    return found


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def test_base_spans_are_the_stated_patterns():
    draw = random.Random(3)
    pieces = ["a", "b.c", "@", "@@", ".", "..", "-", "+", "1", "22", "255", "256", "4111 1111-1111 1111",
              "4111111111111111", "+1 (743) 555-3824", " ", "\n", "x@y.z", "1.2.3.4", "é", "%", "(", ")", "0007"]
    for _ in range(6000):
        text = "".join(draw.choices(pieces, k=draw.randrange(14)))
        assert pii.base_spans(text) == plain(text), repr(text)


def test_long_runs_take_linear_time():
    for run in ("1" * 300_000, "a" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "A1" * 100_000):
        pii.base_spans(run)
        pii.candidates(run)


def test_trees_learn_a_rule_and_thresholds_hold():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(4000, 6))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    trees = pii.BoostedTrees(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) > 0) == y[2000:].astype(bool)).mean() > 0.97


def samples():
    draw = random.Random(9)
    rows = []
    for i in range(400):
        hexes = "".join(draw.choices("0123456789abcdef", k=40))
        rows.append((i, draw.choice([f'words token = "{hexes}" words', f"file {hexes[:26]}x seen", "plain words",
                                     f"call +1 (743) 555-{draw.randrange(1000, 9999)} now",
                                     f"order 2024-{draw.randrange(10, 12)}-11 12345 of"])))
    return rows


def test_added_spans_and_odd_rows(docs_of):
    detector = pii.fit(docs_of(samples()))
    secret = 'my token = "' + "0a1b2c3d" * 5 + '" x'
    rows = [(1, None), (2, ""), (3, secret), (3, secret), (None, "a@b.co"), (4, "w " * 60_000 + "1.2.3.4")]
    found = {}
    for r in pii.find(docs_of(rows), detector).collect():
        found.setdefault(r.doc_id, []).append(r)
    nothing = hashlib.sha256(b"").hexdigest()
    assert [(r.base_sha256, r.spans) for r in found[1] + found[2]] == [(nothing, "")] * 2
    # the value and the token are the same characters; either name will do
    assert {r.spans.partition(":")[2] for r in found[3]} == {"12:52"} and len(found[3]) == 2
    assert found[3][0].base_sha256 == nothing
    assert (found[None][0].n_email, found[None][0].spans) == (1, "email:0:6")
    assert (found[4][0].n_ip, found[4][0].spans) == (1, "ip:120000:120007")
    clean = pii.redact(docs_of(rows), detector)
    assert clean.columns == ["doc_id", "lang", "source", "n_chars", "text"]
    assert {r.text for r in clean.where("doc_id = 3").collect()} <= {'my token = "[token]" x', 'my token = "[value]" x'}


def test_nothing_to_learn_from(docs_of):
    detector = pii.fit(docs_of([(1, "no data here")]))
    assert detector.trees is None
    assert [r.spans for r in pii.find(docs_of([(1, "1.2.3.4 " + "z" * 40)]), detector).collect()] == ["ip:0:7"]
    assert pii.find(docs_of([]), pii.fit(docs_of([]))).collect() == []


def test_a_rare_kind_is_learned_from_all_texts(session, docs_of):
    # written-out addresses only where a sample of 8,000 texts by the id's hash would not look
    outside = [r.id for r in session.range(1000, 13_000).where(
        f"pmod(xxhash64(id), {1 << 20}) >= {(8000 << 20) // 12_400}").limit(40).collect()]
    rows = samples() + [(i, f"write joe{i} (at) example{i} (dot) com soon" if i in outside else f"plain words {i}")
                        for i in range(1000, 13_000)]
    docs = docs_of(rows)
    detector = pii.fit(docs)
    assert np.isfinite(detector.least[pii.MORE.index("mail")])
    text = "write joe4242 (at) example4242 (dot) com soon"
    assert [r.spans for r in pii.find(docs_of([(1, text)]), detector).collect()] == ["mail:6:40"]


def test_thresholds_from_counts_and_even_shares():
    detector = pii.Detector().calibrate(*(np.array(c) for c in zip(
        (0, 512, 1, 90), (0, 256, 1, 8), (0, 256, 0, 2), (0, -256, 1, 1), (0, -256, 0, 90), (1, 0, 0, 5), strict=True)))
    assert detector.least.tolist() == [1.0, *[np.inf] * 4]
    assert pii._shares({(0, 0): 1000, (0, 1): 10, (1, 0): 500}, 210) == {(0, 1): 1.0, (1, 0): 0.2, (0, 0): 0.1}


def test_dense_long_texts_take_linear_time():
    draw = random.Random(8)
    line = 'mail bob{0}@site{0}.org, ip 10.0.{1}.7, call +1 (743) 555-{2} token="{3}" from joe (at) home.org; '
    text = "".join(line.format(i, i % 250, 1000 + i % 9000, f"{draw.getrandbits(160):040x}") for i in range(20_000))
    x = np.array([pii.features(k, text, a, b) for k, a, b in pii.candidates(text[:40_000])])
    trees = pii.BoostedTrees(x, (x[:, 2] > 0).astype(float), trees=5)
    detector = pii.Detector(trees)
    detector.least[:] = -9
    began = time.process_time()
    (base, added), = detector.spans([text])
    covering = pii.Covering(base)
    marked = [covering.of(a, b) for _, a, b in pii.candidates(text)]
    assert time.process_time() - began < 60  # 2.3 million characters
    assert len(base) >= 60_000 and len(added) >= 20_000 and sum(marked) > 0
    taken = sorted((a, b) for _, a, b in base + added)
    assert all(b <= c for (_, b), (c, _) in zip(taken, taken[1:]))


def test_covered_stretches_against_all_spans():
    draw = random.Random(6)
    for _ in range(300):
        base = []
        for kind in pii.KINDS:
            at = 0
            for _ in range(draw.randrange(6)):
                at += draw.randrange(8)
                base.append((kind, at, at := at + draw.randrange(1, 9)))
        covering = pii.Covering(base)
        for _ in range(30):
            a = draw.randrange(60)
            e = a + draw.randrange(1, 20)
            want = any(max(a, c) < min(e, d) and min(e, d) - max(a, c) >= 0.8 * (e - a) for _, c, d in base)
            assert covering.of(a, e) == want
