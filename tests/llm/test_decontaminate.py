import random

from tripengine.llm import decontaminate as d

DRAW = random.Random(6)
ALPHABET = "abcdefghij klmnop  qrst"


def words(n):
    return d.normal("".join(DRAW.choice(ALPHABET) for _ in range(n)))


def distance(needle, text):
    """Least edit distance of the needle to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(needle, 1):
        now = [i]
        for j, e in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != e)))
        row = now
    return min(row)


def edited(text, edits):
    chars = list(text)
    for _ in range(edits):
        at = DRAW.randrange(len(chars))
        chars[at:at + DRAW.randrange(2)] = [DRAW.choice("xyz")] * DRAW.randrange(2)
    return "".join(chars)


def test_every_occurrence_within_the_budget_is_found():
    items = [(i, words(DRAW.randrange(60, 200))) for i in range(8)]
    needles = d.Needles(items)
    texts = []
    for _ in range(60):
        i, item = DRAW.choice(items)
        texts.append(words(80) + edited(item, DRAW.randrange(20)) + words(80))
    found = {(t, needles.items[n]) for t, n, *_ in needles.search(texts)}
    want = {(t, i) for t, text in enumerate(texts) for i, item in items
            if distance(item, d.normal(text)) <= len(item) * d.RATE // 100}
    assert found == want and 5 < len(want) < 60


def test_distances_and_places():
    item = words(150)
    text = "Some  words\n" + item.upper().replace(" ", "\t\n") + " and more"
    [(t, _, start, end, edits)] = d.Needles([(1, item)]).search(["other", text])
    assert (t, edits, d.normal(text[start:end])) == (1, 0, item)


def test_windows_of_long_items():
    item = words(1000)
    needles = d.Needles([(1, item)])
    assert {needles.items[n] for _, n, *_ in needles.search([words(50) + item[300:620] + words(50)])} == {1}
    assert not needles.search([words(3000), item[300:420]])


def test_odd_rows(docs_of, session):
    item = words(120)
    bench = session.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "short"), (None, item + " ")],
                                    "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (3, "x " + item), (None, words(50_000) + item), (4, "a\0b short")]
    got = sorted((str(r.doc_id), str(r.item_id), r.edits) for r in d.find(docs_of(rows), bench).collect())
    assert got == sorted((str(i), j, 0) for i in (3, 3, None) for j in ("1", "None"))
    kept = d.clean(docs_of(rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert kept.columns == docs_of(rows).columns
    assert d.find(docs_of([]), bench).collect() == []
    assert d.find(docs_of(rows), bench.limit(0)).collect() == []
    assert d.clean(docs_of(rows), bench.limit(0)).count() == len(rows)


def test_blocks_together_are_the_whole_benchmark(session):
    rows = [(i, words(100)) for i in range(30)]
    parts = list(d.blocks(session.createDataFrame(rows, "item_id long, text string"), block_chars=700))
    assert len(parts) >= 3 and sorted(i for p in parts for i in p.items) == list(range(30))


def test_passages_of_the_tables(session):
    folder = "/root/testdata/sf0.001"
    docs = session.read.parquet(f"{folder}/documents.parquet")
    bench = session.read.parquet(f"{folder}/benchmark.parquet")
    want = {(r.doc_id, b.item_id) for r in docs.collect() for b in bench.collect()
            if d.normal(b.text) in d.normal(r.text or "") and len(d.normal(b.text)) >= d.LEAST}
    got = {(r.doc_id, r.item_id) for r in d.find(docs, bench).collect()}
    assert want <= got and len(got - want) <= 1


def test_parts_of_items_are_found(docs_of, session):
    draw = random.Random(11)
    prose = ["".join(draw.choice("bcdfglmnprstuaeio ") for _ in range(600)) for _ in range(4)]
    short, long = ("".join(draw.choice(ALPHABET.replace("  ", " z")) for _ in range(n)) for n in (180, 400))
    bench = session.createDataFrame([(1, short), (2, long)], "item_id long, text string")
    low = d.normal(long)
    planted = {1: (short[:144], 1), 2: (low[50:250], 2), 3: (low[25:265], 2),
               4: (low[133:133 + d.PART + d.PART // 2 - 1], 2),  # the least run that holds a whole part
               5: (low[60:90] + "#" + low[91:120] + "##" + low[122:160], 2), 6: (low[70:100], None)}
    rows = [(i, f"{prose[0]}{t.upper()}{prose[1]}") for i, (t, _) in planted.items()]
    rows += [(7, prose[2] + " " + long + " " + prose[3]), (8, prose[3])]
    got = {(r.doc_id, r.item_id): r for r in d.find(docs_of(rows), bench).collect()}
    assert set(got) == {(i, item) for i, (_, item) in planted.items() if item} | {(7, 2)}
    assert all((r.windows, r.edits) == (0, 0) for (i, _), r in got.items() if i in (1, 4))
    for i in (1, 2, 3, 4):  # at most a half part at either end lies in no whole part
        assert 600 - 4 <= got[i, planted[i][1]].start < 600 + d.PART // 2 + 4
    assert (got[7, 2].windows, got[7, 2].edits, got[7, 2].start) == (3, 0, 601)
    assert sorted(r.doc_id for r in d.clean(docs_of(rows), bench).collect()) == [6, 8]


def test_parts_add_to_what_whole_items_find():
    draw = random.Random(3)
    items = [(i, "".join(draw.choice(ALPHABET) for _ in range(draw.randrange(40, 700)))) for i in range(12)]
    texts = ["x" * 30 + items[i % 12][1][draw.randrange(5):] + "tail of the text" for i in range(24)]
    plain, parts = d.Needles(items), d.Needles(items, parts=True)
    assert parts.items[:parts.whole] == plain.items
    own = parts.search(texts)
    assert [r for r in own if r[1] < parts.whole] == plain.search(texts)
    ends = {}
    for t, n, start, end, _ in own:
        ends.setdefault((t, parts.items[n]), []).append((start, end))
    assert all((t, t % 12) in ends for t in range(24))
