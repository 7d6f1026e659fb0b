"""Periodic runs of words, by internal pattern matching.

A run is a stretch of words in which words one period apart are the same, that
no neighbouring word extends, at least ``least`` words and ``times`` periods
long; its period is its smallest one. All runs of a text are found:

1. The words of a batch of texts become one sequence of numbers, every text
   closed by a number of its own. Doubling ranks the blocks of 1, 2, 4, ...
   words at every place; the last ranks are the suffix array.
2. Blocks of ``B`` words (a power of two) are taken at every multiple of ``B``.
   A run of length ``L`` and period ``q`` holds, for the largest ``B`` with
   ``2B - 1 <= L - q``, such a block together with its copy ``q`` words on, and
   ``q < 2B``. So the block's next occurrences in the neighbouring window of
   ``2B`` words are looked for: they are range successors in the suffix array's
   interval of the block, answered for all blocks at once by a wavelet tree.
3. Occurrences at most ``B / 2`` apart form a progression whose difference is
   the block's own period. It is a candidate, and the walk steps over the rest
   of the progression. Of a later progression the candidate periods are the
   distances between the starts and between the ends of both stretches that
   keep the block's period; of single occurrences, their distances.
4. A candidate is extended both ways by comparing ranked blocks. What is long
   enough is a run; of equal stretches the one with the smallest period stays.

Work is bounded by words times the logarithm of a batch's words, however
periodic a text is. Rows are handled one by one, so no key is shuffled.

Defined results: a null text is empty and has no runs, nor has an empty table
rows. Repeated rows are treated each. Other columns are handed on under their
own names, one named like an output is replaced. A long text is taken whole;
it needs about 100 bytes a word and level of doubling (``log2`` of its longest
repeat) in its task, beside the text.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import BLANKS, fresh_name, query, table, whole, with_column

LEAST, TIMES = 24, 3
#: Words of the texts that are ranked together.
BATCH_WORDS = 1 << 17

RUN = "struct<start:bigint,length:bigint,period:bigint>"
FOUND_ARROW = pa.struct([
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string())])


class Blocks:
    """Ranks of all blocks of 1, 2, 4, ... symbols, and the suffix array.

    ``ranks[k][i]`` is the number of suffixes below the block of ``2^k`` symbols
    at ``i``; equal blocks share it. The last symbol must occur once only.
    """

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        counts = np.bincount(symbols)
        rank = (np.cumsum(counts) - counts)[symbols].astype(np.int32)
        self.ranks = [rank]
        shared = np.flatnonzero(counts[symbols] > 1)
        step = 1
        while len(shared):
            first = rank[shared].astype(np.int64)
            second = np.where(shared + step < n, rank[np.minimum(shared + step, n - 1)] + 1, 0)
            key = first * (n + 1) + second
            order = np.argsort(key, kind="stable")
            key, first, shared = key[order], first[order], shared[order]
            at = np.arange(len(key))
            begins = np.concatenate([[True], key[1:] != key[:-1]])
            begins_old = np.concatenate([[True], first[1:] != first[:-1]])
            rank = rank.copy()
            rank[shared] = first + np.maximum.accumulate(np.where(begins, at, 0)) \
                - np.maximum.accumulate(np.where(begins_old, at, 0))
            alone = begins & np.concatenate([begins[1:], [True]])
            shared = np.sort(shared[~alone])
            self.ranks.append(rank)
            step *= 2
        self.suffixes = np.empty(n, np.int32)
        self.suffixes[rank] = np.arange(n, dtype=np.int32)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and ``j`` on are the same."""
        found = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = i + found, j + found
            inside = np.maximum(a, b) + (1 << k) <= self.n
            last = self.n - 1
            same = inside & (self.ranks[k][np.minimum(a, last)] == self.ranks[k][np.minimum(b, last)])
            found[same] += 1 << k
        return found

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before ``i`` and ``j`` are the same."""
        found = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = i - found - (1 << k), j - found - (1 << k)
            same = (np.minimum(a, b) >= 0) & \
                (self.ranks[k][np.maximum(a, 0)] == self.ranks[k][np.maximum(b, 0)])
            found[same] += 1 << k
        return found


class WaveletTree:
    """Range successors in an array: a level per bit, zeros before ones, kept by prefix counts."""

    def __init__(self, values: np.ndarray):
        self.levels = []  # bit, zeros before each place, all zeros
        for bit in range(max(1, int(len(values) - 1).bit_length()) - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~one], values[one]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values at ``low`` up to ``high`` are below ``bound``."""
        low, high = low.astype(np.int64), high.astype(np.int64)
        found = np.zeros(len(low), np.int64)
        for bit, zeros, all_zeros in self.levels:
            one = (bound >> bit & 1).astype(bool)
            z_low, z_high = zeros[low], zeros[high]
            found += np.where(one, z_high - z_low, 0)
            low = np.where(one, all_zeros + low - z_low, z_low)
            high = np.where(one, all_zeros + high - z_high, z_high)
        return found

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value with ``n`` smaller ones at ``low`` up to ``high``; ``n`` must fit."""
        low, high, n = low.astype(np.int64), high.astype(np.int64), n.copy()
        value = np.zeros(len(low), np.int64)
        for bit, zeros, all_zeros in self.levels:
            z_low, z_high = zeros[low], zeros[high]
            one = n >= z_high - z_low
            n -= np.where(one, z_high - z_low, 0)
            value += np.where(one, 1 << bit, 0)
            low = np.where(one, all_zeros + low - z_low, z_low)
            high = np.where(one, all_zeros + high - z_high, z_high)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, above: np.ndarray) -> np.ndarray:
        """The smallest value over ``above`` at ``low`` up to ``high``, or the largest long."""
        smaller = self.below(low, high, above + 1)
        found = np.full(len(low), np.iinfo(np.int64).max)
        there = np.flatnonzero(smaller < high - low)
        found[there] = self.nth(low[there], high[there], smaller[there])
        return found


def smallest_block(least: int, times: int) -> int:
    """The exponent of the shortest blocks that runs can need."""
    return max(0, ((least - least // times + 1) // 2).bit_length() - 1)


def candidates(blocks: Blocks, tree: WaveletTree, k: int, at: np.ndarray, low: np.ndarray,
               high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and candidate periods from blocks of ``2^k`` symbols at ``at``."""
    size = 1 << k
    period = np.zeros(len(at), np.int64)  # of the block itself, where two occurrences show it
    now, left = at.copy(), np.arange(len(at))
    of, places = [], []  # first occurrences of later progressions
    while len(left):
        found = tree.successor(low[left], high[left], now[left])
        within = found < at[left] + 2 * size
        left, found = left[within], found[within]
        gap = found - now[left]
        close = gap <= size // 2
        inner, far = left[close], left[~close]
        p = period[inner] = gap[close]
        reach = now[inner] + p + blocks.ahead(now[inner], now[inner] + p)
        now[inner] += (reach - size - now[inner]) // p * p
        now[far] = found[~close]
        of.append(far)
        places.append(found[~close])
    of, places = np.concatenate(of or [left]), np.concatenate(places or [at[:0]])
    own, start = period > 0, at[of]
    aligned = own[of]
    single, rows = ~aligned, of[aligned]
    x, y, p = start[aligned], places[aligned], period[rows]
    starts = (y - blocks.behind(y, y + p)) - (x - blocks.behind(x, x + p))
    ends = (y + blocks.ahead(y, y + p)) - (x + blocks.ahead(x, x + p))
    where = np.concatenate([at[own], start[single], x, x])
    periods = np.concatenate([period[own], places[single] - start[single], starts, ends])
    good = (periods > 0) & (periods < 2 * size)
    return where[good], periods[good]


def find_runs(symbols: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    The last symbol, and any other that separates texts, must occur once only.
    """
    if times < 3 or least < times:
        raise ValueError("runs are found from three periods on")
    nothing = np.empty((0, 3), np.int64)
    if len(symbols) <= least:
        return nothing
    blocks, tree, found = Blocks(symbols), None, []
    for k in range(smallest_block(least, times), len(blocks.ranks)):
        rank = blocks.ranks[k]
        at = np.arange(0, len(symbols) - (1 << k) + 1, 1 << k)
        count = np.bincount(rank, minlength=len(rank))[rank[at]]
        at, count = at[count > 1], count[count > 1]
        if not len(at):
            continue
        tree = tree or WaveletTree(blocks.suffixes.astype(np.int64))
        low = rank[at].astype(np.int64)
        found.append(np.stack(candidates(blocks, tree, k, at, low, low + count), axis=1))
    if not found:
        return nothing
    at, period = np.unique(np.concatenate(found), axis=0).T
    start = at - blocks.behind(at, at + period)
    length = at + period + blocks.ahead(at, at + period) - start
    long = length >= np.maximum(least, times * period)
    rows = np.stack([start, length, period], axis=1)[long]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        first = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
        rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def of_texts(texts: Iterable[str | None], least: int = LEAST, times: int = TIMES,
             batch_words: int = BATCH_WORDS) -> list[dict]:
    """For each text its runs and the text without the repeats that runs hold."""
    results, group, held = [], [], 0
    for text in texts:
        group.append((text or "").encode("utf-8", "surrogatepass").split())
        held += len(group[-1])
        if held >= batch_words:
            results += _of_group(group, least, times)
            group, held = [], 0
    return results + _of_group(group, least, times)


def _of_group(group: list[list[bytes]], least: int, times: int) -> list[dict]:
    """Texts of fewer than ``least`` words have no runs and are left out of the sequence."""
    results = [{"runs": [], "collapsed": b" ".join(words)} for words in group]
    long = [i for i, words in enumerate(group) if len(words) >= least]
    if not long:
        return results
    joined = [word for i in long for word in group[i]]
    codes = pa.array(joined, pa.binary()).dictionary_encode()
    distinct, codes = len(codes.dictionary), codes.indices.to_numpy()
    sizes = np.array([len(group[i]) for i in long])
    ends = np.cumsum(sizes)
    symbols = np.insert(codes.astype(np.int64), ends, distinct + np.arange(len(long)))
    begins = ends - sizes + np.arange(len(long))
    rows = find_runs(symbols, least, times)
    owner = np.searchsorted(begins, rows[:, 0], side="right") - 1
    for at in np.unique(owner).tolist():
        own = rows[owner == at] - [int(begins[at]), 0, 0]
        words = group[long[at]]
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, own[:, 0] + own[:, 2], 1)
        np.add.at(edges, own[:, 0] + own[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
        results[long[at]] = {
            "runs": [dict(zip(("start", "length", "period"), row, strict=True)) for row in own.tolist()],
            "collapsed": b" ".join([words[i] for i in kept])}
    return results


def with_runs(docs: DataFrame, text_column: str = "text", runs: str = "runs", collapsed: str = "collapsed",
              least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The rows with their runs and the text without the words that runs repeat.

    ``collapsed`` joins the kept words by one space: a word goes if any run
    holds it after that run's first period.
    """
    kept = [c for c in docs.columns if c.lower() not in (runs.lower(), collapsed.lower())]
    copy = fresh_name("source", kept)
    name = fresh_name("found", [*kept, copy])

    def work():
        return lambda texts: of_texts(texts, least, times)

    given = docs.select(*(F.col(f"`{c}`") for c in kept),
                        F.col(f"`{text_column}`").cast("string").alias(copy))
    found = with_column(given, copy, name, f"struct<runs:array<{RUN}>,collapsed:string>", FOUND_ARROW, work)
    return found.select(*(F.col(f"`{c}`") for c in kept), F.col(name)["runs"].alias(runs),
                        F.col(name)["collapsed"].alias(collapsed))


def with_planted_repeats(text: Column, doc_id: Column) -> Column:
    """The text of a tenth of all ids with its tail replaced by repeats of the tail's beginning."""
    words = F.filter(F.split(text, BLANKS, -1), lambda w: w != "")
    n, hashed = F.size(words), F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(hashed / F.lit(10))
    at = (g % F.greatest(n, F.lit(1))).cast("int")
    period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
    times = F.ceil((n - at) / period).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, at + 1, period), times))
    planted = F.concat(F.slice(words, F.lit(1), at), F.slice(repeated, F.lit(1), n - at))
    return F.when((hashed % 10 == 0) & (n > 0), F.array_join(planted, " ")).otherwise(text)


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    """Runs of every document, in digests, after repeats were planted in a tenth of them."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        with_planted_repeats(whole("text"), F.col("doc_id")).alias("text"))
    found = with_runs(docs)
    # exponents as fractions, compared crosswise; equal ones by start and period, as the runs come
    best = F.reduce("runs", F.lit(None).cast(RUN), lambda top, run: F.when(
        top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run).otherwise(top))
    line = F.transform("runs", lambda r: F.concat(
        *(F.concat(r[c].cast("string"), F.lit(end)) for c, end in (("start", ","), ("length", ","), ("period", "\n")))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
