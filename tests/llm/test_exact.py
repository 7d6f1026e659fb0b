import hashlib
import random
import re

from tripengine.llm import exact
from tripengine.llm.common import SharedFiles

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, None), (2, ""), (4, " "), (7, "x" * 300_000),
        (6, "x" * 300_000), (None, "only"), (None, "only"), (8, "tie"), (8, "tie"), (8, "other")]


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    found = []
    for (i, _), text in zip(rows, norm, strict=True):
        same = [j for (j, _), other in zip(rows, norm, strict=True) if other == text]
        keep = min((j for j in same if j is not None), default=None)
        found.append((i, keep, len(same), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


def assigned(df, **options):
    return sorted(map(tuple, exact.assign_groups(df, **options).collect()), key=str)


def test_groups_against_brute_force(docs_of):
    assert assigned(docs_of(ROWS)) == brute(ROWS)


def test_tables_of_a_few_bytes_spill_and_change_nothing(docs_of):
    rows = [(i, f"text {i % 40} " + "y" * (i % 7)) for i in range(300)]
    assert assigned(docs_of(rows), table_bytes=900) == brute(rows)


def test_spill_files_are_split_again_and_removed(tmp_path):
    draw = random.Random(4)
    rows = []
    for i in range(2000):
        text = f"t{draw.randrange(700)}".encode()
        rows.append((hashlib.sha256(text).digest(), text, i, 1, 1))
    spill = SharedFiles(str(tmp_path / "spill"))
    found = list(exact.grace(iter(rows), spill, limit=3000))
    want = {}
    for digest, text, i, _, _ in rows:
        keep, n = want.get(text, (i, 0))
        want[text] = min(keep, i), n + 1
    assert {e[1]: (e[2], e[3]) for e in found} == want and len(found) == len(want)
    assert not list((tmp_path / "spill").iterdir())


def test_equal_digests_with_other_contents_stay_apart():
    table = exact.ContentTable()
    for content, i in ((b"a", 3), (b"b", 2), (b"a", 1)):
        table.add(b"\0" * 32, content, i, 1, 1)
    assert sorted(e[1:4] for e in table.entries) == [[b"a", 1, 2], [b"b", 2, 1]]


def test_deduplicate_keeps_one_row_of_each_text(docs_of):
    kept = exact.deduplicate(docs_of(ROWS))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, "a\tb"), (1, None), (4, " "), (6, "x" * 300_000), (None, "only"), (8, "tie"), (8, "other")], key=str)


def test_clashing_columns_and_empty_tables(docs_of, session):
    odd = session.createDataFrame([(1, "a", "d", 5, 6), (2, "a", "e", 5, 6)],
                                  "doc_id long, text string, digest string, keep_id long, row long")
    assert [tuple(r) for r in exact.deduplicate(odd).collect()] == [(1, "a", "d", 5, 6)]
    assert exact.assign_groups(docs_of([])).collect() == []
    assert exact.deduplicate(docs_of([])).collect() == []
