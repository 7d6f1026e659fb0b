"""Benchmark passages in documents, within an edit budget, by the q-gram lemma.

Texts are compared in lower case with each run of ASCII blanks as one space. A
benchmark item is searched as a whole, a longer one in windows of ``WINDOW``
characters that overlap by half. Each needle of L characters may differ by
k = ``RATE`` percent of L edits.

A part of an item counts as well: items are also cut into parts of ``PART``
characters, one from every half part on, each searched like an item of that
length. So every verbatim run of ``PART`` + ``PART`` / 2 - 1 characters of an
item is found, and an edited run where one whole part in it keeps to its budget.

* Lemma: an occurrence with at most k edits shares at least L - q + 1 - k * q
  q-grams with the needle, and all lie on diagonals (place in the text less
  place in the needle) that differ by at most k.
* Bands: diagonals fall into bands of 2s, s above k, which overlap by s, so
  every occurrence lies in one band. Shared q-grams are counted by needle and
  band, and only bands that reach the bound are kept.
* Alignment: for those, the edit distance of the needle to any part of the
  region is worked out along the band's diagonals, all bands of a batch at once.
* Parts come after whole needles; a part's region inside a passage of its item
  that is already found would add nothing, and is not aligned.

The benchmark is a stated set of queries. It is dealt out into blocks of
bounded size; a block's q-gram table is sent to all tasks, and every document
is searched for every block.

Defined results: null and empty texts and items match nothing. Items of fewer
than ``LEAST`` characters are not searched, as so short a text proves nothing.
Repeated rows of either table count each, an item's repetition with the same
id and text once; empty tables give no rows, and an empty benchmark leaves all
documents clean. ``clean`` keeps all columns of the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import BLANKS, fresh_name, in_batches, query, table, with_column

Q, RATE, WINDOW, LEAST = 9, 8, 200, 40
#: Characters of a part of an item: as short as an item may be.
PART = LEAST
#: Characters of benchmark text in one block.
BLOCK_CHARS = 4 << 20

U64 = np.uint64
HIT = "doc_id long, item_id long, start long, end long, windows long, edits long"
HIT_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "start", "end", "windows", "edits")])


def lowered(text: str) -> str:
    """Lower case that keeps the number of characters."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normal(text: str) -> str:
    return re.sub(BLANKS, " ", lowered(text)).strip(" ")


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(codes: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` characters from each place on."""
    n = max(0, len(codes) - Q + 1)
    found = np.zeros(n, U64)
    for i in range(Q):
        found = found * U64(0x9E3779B97F4A7C15) + codes[i:i + n] + U64(1)
    return found ^ (found >> U64(29))


class Needles:
    """The windows of a block of items, and where each q-gram occurs in them.

    With ``parts`` the items' parts follow, from needle ``whole`` on.
    """

    def __init__(self, items: list[tuple[int, str]], parts: bool = False):
        self.items, needles = [], []
        texts = [(item_id, points(text)) for item_id, text in ((i, normal(t)) for i, t in items)
                 if len(text) >= LEAST]

        def cut(size: int, least: int) -> None:
            for item_id, codes in texts:
                if len(codes) >= least:
                    last = max(0, len(codes) - size)
                    for start in sorted({*range(0, last, size // 2), last}):
                        needles.append(codes[start:start + size])
                        self.items.append(item_id)

        cut(WINDOW, LEAST)
        self.whole = len(needles)
        if parts:
            cut(PART, PART + 1)
        self.lengths = np.array([len(n) for n in needles], np.int64)
        self.budgets = self.lengths * RATE // 100
        self.bounds = self.lengths - Q + 1 - self.budgets * Q
        self.steps = np.array([1 << int(k).bit_length() for k in self.budgets], np.int64)
        self.codes = np.concatenate([*needles, np.empty(0, np.uint32)])
        self.begins = np.cumsum(self.lengths) - self.lengths
        grams = [qgrams(n) for n in needles] or [np.empty(0, U64)]
        keys = np.concatenate(grams)
        owner = np.repeat(np.arange(len(needles), dtype=np.int32), [len(g) for g in grams] if needles else [])
        place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams])
        order = np.argsort(keys, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.bits = 24
        self.present = np.zeros(1 << self.bits, bool)
        self.present[(self.keys >> U64(64 - self.bits)).astype(np.int64)] = True

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """Text, needle, start, end (in the text as given) and edits of each occurrence."""
        if not self.items:
            return []
        joined = "\0".join(["", *((t or "").replace("\0", " ") for t in texts), ""])
        raw = points(lowered(joined))
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        kept = np.flatnonzero(~blank | ~np.concatenate([[False], blank[:-1]]))
        codes = np.where(blank, np.uint32(32), raw)[kept]
        walls = np.flatnonzero(codes == 0)
        hashes = qgrams(codes)
        at = np.flatnonzero(self.present[(hashes >> U64(64 - self.bits)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[found] == hashes[at]
        at, found = at[hit], found[hit]
        many = self.count[found]
        at = np.repeat(at, many)
        entry = np.repeat(self.first[found] - np.cumsum(many) + many, many) + np.arange(len(at))
        needle = self.owner[entry].astype(np.int64)
        diagonal = at - self.place[entry] + WINDOW  # not below zero
        band = diagonal // self.steps[needle]
        key = np.concatenate([needle << 40 | band, needle << 40 | (band - 1)])
        key, count = np.unique(key, return_counts=True)
        needle = key >> 40
        full = count >= self.bounds[needle]
        needle, band = needle[full], key[full] & ((1 << 40) - 1)
        low = band * self.steps[needle] - WINDOW
        results: dict[tuple[int, int, int], tuple[int, int]] = {}
        passages: dict[int, dict[int, tuple[int, int]]] = {}  # first start and last end, by item and text

        def align(some: np.ndarray) -> None:
            for n, end, edits in self._aligned(codes, needle[some], low[some]):
                start = self._start(codes, n, end)
                text = int(np.searchsorted(walls, start, side="right")) - 1
                place = text, n, int(kept[end - 1])
                if place not in results or edits < results[place][1]:
                    results[place] = int(kept[start]), edits
                    own = passages.setdefault(self.items[n], {})
                    a, b = own.get(text, (start, end))
                    own[text] = min(a, start), max(b, end)

        def inside(i: int) -> bool:
            n = int(needle[i])
            own = passages.get(self.items[n])
            if not own:
                return False
            k, first = int(self.budgets[n]), int(low[i])
            text = int(np.searchsorted(walls, max(0, first), side="right")) - 1
            a, b = own.get(text, (0, 0))
            return a <= first - k and first + 2 * int(self.steps[n]) + int(self.lengths[n]) + k <= b

        # needles are in order, whole ones first
        cut = int(np.searchsorted(needle, self.whole))
        for first in range(0, cut, 512):
            align(np.arange(first, min(cut, first + 512)))
        for first in range(cut, len(needle), 2048):
            align(np.array([i for i in range(first, min(len(needle), first + 2048)) if not inside(i)], np.int64))
        begin = kept[walls]
        return [(t, n, s - int(begin[t]) - 1, e - int(begin[t]), d)
                for (t, n, e), (s, d) in sorted(results.items())]

    def _aligned(self, codes: np.ndarray, needle: np.ndarray, low: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Needle, end in the codes and distance of the best occurrence in each band, if any.

        ``low`` is the band's first diagonal. One row of the table at a time,
        for all bands together; walls between texts match nothing.
        """
        if not len(needle):
            return
        k, step, length = self.budgets[needle], self.steps[needle], self.lengths[needle]
        width = int((2 * step + 2 * k).max()) + 1
        start = low - k
        across = np.arange(width)
        cost = np.zeros((len(needle), width), np.int32)
        best = np.full(len(needle), 1 << 20)
        end = np.zeros(len(needle), np.int64)
        for j in range(1, int(length.max()) + 1):
            place = start[:, None] + across + j - 1
            inside = (place >= 0) & (place < len(codes))
            char = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], 0)
            wall = char == 0
            letter = self.codes[self.begins[needle] + np.minimum(j, length) - 1]
            step_cost = np.where(wall, 1 << 16, char != letter[:, None])
            now = cost + step_cost
            now[:, :-1] = np.minimum(now[:, :-1], cost[:, 1:] + 1)
            # a character more in the text: from the left in the same row, not over a wall
            free = np.where(wall, (1 << 16), 1).cumsum(axis=1)
            now = np.minimum.accumulate(now - free, axis=1) + free
            cost = np.minimum(now, 1 << 20).astype(np.int32)
            done = np.flatnonzero(length == j)
            if len(done):
                final = cost[done]
                place_of = final.argmin(axis=1)
                best[done] = final[np.arange(len(done)), place_of]
                end[done] = start[done] + place_of + j
        for i in np.flatnonzero(best <= k).tolist():
            yield int(needle[i]), int(end[i]), int(best[i])

    def _start(self, codes: np.ndarray, n: int, end: int) -> int:
        """Where the best occurrence that ends at ``end`` starts: the same table from the end on."""
        length, k = int(self.lengths[n]), int(self.budgets[n])
        back = codes[max(0, end - length - k):end][::-1]
        word = self.codes[self.begins[n]:self.begins[n] + length][::-1]
        row = np.arange(len(back) + 1)
        for j in range(1, length + 1):
            now = np.empty_like(row)
            now[0] = j
            now[1:] = np.minimum(row[1:] + 1, row[:-1] + (back != word[j - 1]))
            row = np.minimum.accumulate(now - np.arange(len(row))) + np.arange(len(row))
        return end - int(row.argmin())


def blocks(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text",
           block_chars: int = BLOCK_CHARS, parts: bool = False) -> Iterator[Needles]:
    """The benchmark's needles, a block of bounded size at a time."""
    items = benchmark.select(F.col(f"`{id_column}`").cast("long").alias("item_id"),
                             F.col(f"`{text_column}`").cast("string").alias("text")) \
        .where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-size // block_chars)
    for b in range(count):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        yield Needles(sorted(((r.item_id, r.text) for r in mine.collect()),
                             key=lambda x: (x[0] is None, x[0] or 0, x[1])), parts)


def find(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, start, end (characters of the text), windows found and least edits.

    A row per document row and item that occurs in it, whole or in part: from
    the first found needle's start to the last one's end. Windows and edits are
    those of whole items and windows; where only parts occur, no window is
    found and the edits are those of the best part.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_column}`").cast("string").alias("text"))
    found = spark.createDataFrame([], HIT)
    for needles in blocks(benchmark, item_column, item_text, parts=True):
        shared = spark.sparkContext.broadcast(needles)

        def rows(batches, shared=shared):
            own = shared.value

            def hits():
                for b in batches:
                    doc_ids = b.column(0).to_pylist()
                    spans: dict[tuple, list] = {}
                    for text, n, start, end, edits in own.search(b.column(1).to_pylist()):
                        spans.setdefault((text, own.items[n]), []).append((start, end, n, edits))
                    for (text, item), places in spans.items():
                        full = [p for p in places if p[2] < own.whole]
                        yield (doc_ids[text], item, min(p[0] for p in places), max(p[1] for p in places),
                               len({p[2] for p in full}), min(p[3] for p in full or places))
            yield from in_batches(hits(), HIT_ARROW)

        found = found.unionByName(given.mapInArrow(rows, HIT))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The documents without any benchmark passage, whole or in part, with all their columns."""
    name = fresh_name("leaks", docs.columns)
    for needles in blocks(benchmark, item_column, item_text, parts=True):
        shared = docs.sparkSession.sparkContext.broadcast(needles)

        def work(shared=shared):
            def leaks(texts):
                hit = {t for t, *_ in shared.value.search(texts)}
                return [i in hit for i in range(len(texts))]
            return leaks

        docs = with_column(docs, text_column, name, "boolean", pa.bool_(), work) \
            .where(~F.col(name)).drop(name)
    return docs


@query("op1_benchmark_decontamination")
def op1(spark, sf_dir):
    """Every benchmark item found in a document."""
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
