"""Text quality by positive-unlabelled learning.

Trusted good texts and all texts without a label of their own are told apart
by a classifier that never sees a bad example. Its non-negative unbiased risk
is, with class prior ``p`` and squared loss,

    p * E_trusted[loss(g, +1)] + max(0, E_all[loss(g, -1)] - p * E_trusted[loss(g, -1)])

1. Every whole text becomes measures of its form (``MEASURES``), each put into
   one of a few bins. The classifier adds a weight per bin.
2. With squared loss the risk needs nothing but how often two bins meet, among
   the trusted texts and among all. These counts are whole numbers of a fixed
   size, made in one pass over all rows, added up per task and then by a
   shuffle; no text or row is sampled, and the result does not depend on order.
3. The prior is estimated from the counts of a ratio score in both sets: the
   share of all texts over a bound, by the share of trusted ones over it, is at
   its least where only good texts are left (best bin, with the margin that the
   numbers of rows allow). Each half of the rows is scored by a ratio fitted on
   the other half. These counts, too, cover all rows.
4. The risk is minimised on the driver over the tables of counts; where its
   second part turns negative, the step goes the other way.

The score is the estimated probability that a text is good, ``(g + 1) / 2``
within 0 and 1.

Defined results: null texts count as empty ones, and an empty text has a score
as any other. Where labels of one id disagree, or the label or id is null, the
row is not trusted. Repeated rows count and are scored each. Without trusted
texts every score is 0.5. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import materialise, query, remainder, table, whole

SHARE = (0.0, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 0.95)
#: Measures of a text and the upper ends of their bins; one more bin lies above.
MEASURES: dict[str, tuple[float, ...]] = {
    "words": (0, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000),
    "bytes_per_word": (2, 3, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 15),
    "upper_of_letters": SHARE,
    "symbols": SHARE,
    "digits": SHARE,
    "punctuation": SHARE,
    "symbol_ends": SHARE,
    "top_word": SHARE,
    "distinct_words": SHARE,
    "repeated_triples": SHARE,
    "repeated_lines": SHARE,
    "bytes_per_line": (10, 30, 60, 120, 200, 300, 500, 1000, 3000, 10_000),
    "closed_lines": SHARE,
    "compressed": (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.45, 0.5, 0.6, 0.8, 1.0, 1.5),
    "short_words": SHARE,
}
#: The first place of each measure's bins among all bins.
OFFSETS = np.cumsum([0] + [len(ends) + 1 for ends in MEASURES.values()])
SCORE_BINS = 1000  # of the ratio score, for the prior
#: Added to the counts' diagonal: a part of it, and rows that a bin should have at least.
RIDGE, FEW = 1e-3, 5.0
STEPS, STEP = 400, 0.2
#: Characters of the texts measured together.
GROUP_CHARS = 1 << 20

LOWER, UPPER, DIGIT, BLANK, MARK, HIGH, SYMBOL = range(7)
KINDS = np.full(256, SYMBOL, np.uint8)
KINDS[128:] = HIGH
for _kind, _members in ((LOWER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                        (DIGIT, b"0123456789"), (BLANK, b" \t\n\v\f\r"), (MARK, b".,;:'\"?!()-")):
    KINDS[list(_members)] = _kind
#: Ends of words and lines that prose has.
CLOSING = b".!?\"'):;,"
ENDS_IN_SYMBOL = frozenset(np.flatnonzero(KINDS == SYMBOL).tolist())


def measures(texts: Sequence[str | None]) -> np.ndarray:
    """A row of ``MEASURES`` for each text."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(d) for d in data], np.int64)
    kinds = np.array([np.bincount(KINDS[np.frombuffer(d, np.uint8)], minlength=7) for d in data],
                     np.int64).reshape(-1, 7)
    words = [d.split() for d in data]
    n = np.array([len(w) for w in words], np.int64)
    lines = np.array([_lines(d) for d in data], np.float64).reshape(-1, 3)
    some, bytes_, letters = np.maximum(n, 1), np.maximum(size, 1), np.maximum(kinds[:, :2].sum(axis=1), 1)
    joined = [w for own in words for w in own]
    of = np.repeat(np.arange(len(data)), n)
    last = np.fromiter((w[-1] for w in joined), np.uint8, len(joined))
    short = np.fromiter(map(len, joined), np.int64, len(joined)) <= 3
    codes = pa.array(joined, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    distinct, top = _of_groups(of, codes, len(data))
    triples = _triples(of, codes)
    kept, _ = _of_groups(*triples, len(data))
    ends = np.bincount(of, weights=KINDS[last] == SYMBOL, minlength=len(data))
    return np.stack([
        n, kinds[:, [LOWER, UPPER, DIGIT, MARK, HIGH, SYMBOL]].sum(axis=1) / some, kinds[:, UPPER] / letters,
        kinds[:, SYMBOL] / bytes_, kinds[:, DIGIT] / bytes_, kinds[:, MARK] / bytes_, ends / some,
        top / some, distinct / some, 1 - kept / np.maximum(n - 2, 1), 1 - lines[:, 1],
        size / np.maximum(lines[:, 0], 1), lines[:, 2],
        np.array([len(zlib.compress(d, 1)) for d in data]) / bytes_,
        np.bincount(of, weights=short, minlength=len(data)) / some,
    ], axis=1).astype(np.float64)


def _lines(data: bytes) -> tuple[int, float, float]:
    """Lines with words; the share of their bytes in distinct ones; the share that ends as prose does."""
    found = Counter(line for line in (x.strip() for x in data.split(b"\n")) if line)
    if not found:
        return 0, 1.0, 0.0
    every, held = found.total(), sum(len(x) * k for x, k in found.items())
    return every, sum(map(len, found)) / held, sum(k for x, k in found.items() if x[-1] in CLOSING) / every


def _of_groups(of: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different codes each owner has, and how often the most frequent one occurs."""
    if not len(of):
        return np.zeros(n), np.zeros(n)
    key = np.sort(of * (int(codes.max()) + 1) + codes)
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    owner = key[begins] // (int(codes.max()) + 1)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, np.diff(np.append(begins, len(key))))
    return np.bincount(owner, minlength=n), top


def _triples(of: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and code of all three neighbouring words within one text."""
    inside = np.flatnonzero(of[2:] == of[:-2])
    if not len(inside):
        return of[:0], codes[:0]
    _, pairs = np.unique(codes[:-1] * (int(codes.max()) + 1) + codes[1:], return_inverse=True)
    _, triples = np.unique(pairs[inside] * (int(codes.max()) + 1) + codes[inside + 2], return_inverse=True)
    return of[inside], triples


def binned(found: np.ndarray) -> np.ndarray:
    """The bin of every measure, numbered over all measures."""
    return np.stack([OFFSETS[i] + np.searchsorted(ends, found[:, i], side="left")
                     for i, ends in enumerate(MEASURES.values())], axis=1)


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Neighbouring texts that are measured together, of bounded length beside one long text."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text or "")
        if held >= GROUP_CHARS:
            yield group
            group, held = [], 0
    if group:
        yield group


def with_bins(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              held_out: tuple[int, int] = (3, 1)) -> DataFrame:
    """doc_id, held_out and the bins of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            parts = [binned(measures(g)) for g in _groups(b.column(2).to_pylist())]
            bins = np.concatenate(parts).astype(np.int32)
            offsets = np.arange(0, bins.size + 1, bins.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(bins.ravel()))],
                names=["doc_id", "held_out", "bins"])

    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        (remainder(f"`{id_column}`", held_out[0]) == held_out[1]).alias("held_out"), whole(f"`{text_column}`"),
    ).mapInArrow(work, "doc_id long, held_out boolean, bins array<int>")


def with_trust(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id",
               label_column: str = "quality") -> DataFrame:
    """The rows, and whether they may be learned from as good: labelled 1 throughout, not held out."""
    good = labels.groupBy(F.col(f"`{id_column}`").cast("long").alias("of")).agg(
        F.min(F.coalesce(F.col(f"`{label_column}`").cast("int"), F.lit(0))).alias("least"),
        F.max(F.col(f"`{label_column}`").cast("int")).alias("most")).where("least = 1 AND most = 1")
    return rows.join(good, F.col("doc_id") == F.col("of"), "left").select(
        "doc_id", "held_out", "bins", (F.col("of").isNotNull() & ~F.col("held_out")).alias("trusted"))


class Model(NamedTuple):
    weights: np.ndarray  # by bin
    prior: float


def half_of_rows() -> Column:
    """Rows of either half estimate the prior with a score fitted on the other one."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")


def meetings(rows: DataFrame) -> np.ndarray:
    """How often two bins meet in a row, by half (0, 1) and set (all rows, trusted ones)."""
    width = int(OFFSETS[-1])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 2, width, width), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            bins = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
            trusted = b.column(1).to_numpy(zero_copy_only=False)
            half = b.column(2).to_numpy()
            ones = np.zeros((b.num_rows, width), np.float32)
            ones[np.arange(b.num_rows)[:, None], bins] = 1
            for h in (0, 1):
                own, good = ones[half == h], ones[(half == h) & trusted]
                found[h] += np.stack([own.T @ own, good.T @ good]).astype(np.int64)
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(found.ravel()[places])], names=["place", "n"])

    sums = rows.select("bins", "trusted", half_of_rows().alias("half")).mapInArrow(counted, "place long, n long") \
        .groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # at most four squares of all bins
    found = np.zeros(4 * width * width, np.int64)
    found[sums.column("place").to_numpy()] = sums.column("n").to_numpy()
    return found.reshape(2, 2, width, width)


def sum_of(weights: np.ndarray) -> Column:
    """The sum of a row's weights, measure by measure."""
    by_bin = F.array(*(F.lit(float(w)) for w in weights))
    return reduce(add, (by_bin[F.col("bins")[i]] for i in range(len(MEASURES))))


def ratio_weights(everything: np.ndarray, trusted: np.ndarray, ridge: float) -> np.ndarray:
    """Weights by bin of the density of trusted texts by that of all, in least squares."""
    return np.linalg.solve(everything + ridge * np.eye(len(everything)), np.diag(trusted))


def class_prior(rows: DataFrame, ratios: Sequence[np.ndarray], confidence: float = 0.1) -> float:
    """The share of good texts among all, from the counts of a ratio score in both sets.

    ``ratios`` scores the rows of either half; each comes from the other half.
    """
    ends = [[sum(f(r[a:b]) for a, b in zip(OFFSETS[:-1], OFFSETS[1:], strict=True)) for f in (min, max)]
            for r in ratios]
    low, high = (float(f(e)) for f, e in zip((min, max), zip(*ends, strict=True), strict=True))
    ratio = F.when(half_of_rows() == 0, sum_of(ratios[0])).otherwise(sum_of(ratios[1]))
    at = F.floor((ratio - F.lit(low)) / F.lit(max(high - low, 1e-9)) * SCORE_BINS)
    counts = np.zeros((SCORE_BINS + 1, 2))
    for r in rows.groupBy(F.greatest(F.lit(0), F.least(F.lit(SCORE_BINS), at)).alias("at")).agg(
            F.count("*").alias("n"), F.count_if("trusted").alias("good")).collect():
        counts[r["at"]] = r.n, r.good
    over = counts[::-1].cumsum(axis=0)
    share = over / over[-1]
    share = share[share[:, 1] > 0.1]
    margin = sum(np.sqrt(np.log(4 / confidence) / (2 * k)) for k in over[-1])
    best = ((share[:, 0] + margin) / share[:, 1]).argmin()
    return float(np.clip(share[best, 0] / share[best, 1], 1e-3, 1 - 1e-3))


def least_risk(everything: np.ndarray, trusted: np.ndarray, prior: float, ridge: float) -> np.ndarray:
    """Weights of least non-negative unbiased risk, from means of products of bins."""
    mean, good = np.diag(everything), np.diag(trusted)
    weigh = np.linalg.inv(everything / 2 + ridge * np.eye(len(mean)))

    def negative(w):  # the risk of bad texts and its slope
        value = (1 + 2 * w @ mean + w @ everything @ w - prior * (1 + 2 * w @ good + w @ trusted @ w)) / 4
        return value, (mean + everything @ w - prior * (good + trusted @ w)) / 2

    w, best, least = np.zeros(len(mean)), np.zeros(len(mean)), np.inf
    for _ in range(STEPS):
        value, slope = negative(w)
        positive = prior * (1 - 2 * w @ good + w @ trusted @ w) / 4
        if positive + max(0.0, value) < least:
            best, least = w, positive + max(0.0, value)
        if value >= 0:
            w = w - STEP * weigh @ (slope + prior * (trusted @ w - good) / 2 + ridge * w)
        else:
            w = w + STEP * weigh @ slope
    return best


def fit(rows: DataFrame) -> Model | None:
    """A model of the rows that are not held out; None without trusted ones."""
    known = rows.where(~F.col("held_out"))
    halves = meetings(known)
    rows_of = halves[:, :, :OFFSETS[1], :OFFSETS[1]].trace(axis1=2, axis2=3)  # each row has one bin of a measure
    n, good = rows_of.sum(axis=0)
    if not good:
        return None
    ridge = RIDGE + FEW / good
    whole_set = halves.sum(axis=0)
    # a half without trusted rows is scored by all of them
    ratios = []
    for other in (1, 0):
        found, sizes = (halves[other], rows_of[other]) if rows_of[other].all() else (whole_set, rows_of.sum(axis=0))
        ratios.append(ratio_weights(*(found / sizes[:, None, None]), ridge))
    prior = class_prior(known, ratios)
    return Model(least_risk(whole_set[0] / n, whole_set[1] / good, prior, ridge), prior)


def scored(rows: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    g = F.lit(0.0) if model is None else sum_of(model.weights)
    return rows.select("doc_id", "held_out", F.greatest(F.lit(0.0), F.least(F.lit(1.0), (g + 1) / 2)).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  label_column: str = "quality", held_out: tuple[int, int] = (3, 1)) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = materialise(with_trust(with_bins(docs, id_column, text_column, held_out), labels, id_column,
                                  label_column), "bins")
    return scored(rows, fit(rows))


@query("op11_quality_scores")
def op11(spark, sf_dir):
    """Quality score of every document."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
