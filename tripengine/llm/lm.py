"""A log-bilinear language model, trained with noise-contrastive estimation.

The model predicts the class of the next token from the classes of the two
before it; a token's probability is its class's times its share in the class:

* The ``SINGLE`` most frequent tokens are classes of their own. All others
  fall into ``SHARED`` classes by a hash of their last two bytes, so that any
  token has a class, seen or not.
* Each context class has a vector and each place a weight per dimension; their
  sum times the class vectors, plus a bias, gives scores whose normalised
  exponentials are the class probabilities (log-bilinear).
* Within a shared class a token has (c + 1) / (sum of (c + 1) + 1), where the
  last 1 is for all tokens never seen; so probabilities sum to one.

Everything learned comes from the whole training part: token counts by one
distributed count, class trigrams by a second. The trigrams fill a table
bounded by the cube of the classes, whatever the corpus; the driver trains on
that table, drawing examples in proportion to the counts and noise from the
class frequencies, with a fixed seed. A step is made for every ``STEP_TOKENS``
training tokens, ``STEPS`` at least, so what it learns from grows with the corpus.

Counts of the vocabulary can grow without bound. Tasks hold those of the most
frequent tokens only (``HEAD`` at most); the others meet their counts in a
join on the token, exactly.

Defined results: a null text is empty and has its end token only. With no
training rows every token has the same base probability and the untrained
network scores the classes. Null ids count as an empty
id when the training part is chosen. Rows are told apart by a number of their
own, so repeated ids stay separate; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine.llm.common import in_batches, materialise, query, remainder, table, words

#: Classes of one token, and classes that tokens share.
SINGLE, SHARED = 96, 32
CLASSES = SINGLE + SHARED
#: Tokens whose counts every task holds at most, and the longest of them in bytes.
HEAD, LONGEST_HEAD = 1 << 17, 64
WIDTH, STEPS, BATCH, NOISE, RATE = 24, 3000, 1024, 24, 0.3
#: Training tokens for each step, where that makes more than ``STEPS``.
STEP_TOKENS = 1 << 14
#: Different tokens a task counts before it hands them on.
HELD = 1 << 18
#: The end of a text. No word holds a blank.
END = b" "

TOKEN_ARROW = pa.schema([("token", pa.binary()), ("c", pa.int64())])
TRIGRAM_ARROW = pa.schema([("trigram", pa.int64()), ("n", pa.int64())])
PARTIAL = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, head_log double, "
           "score double, tail array<struct<token: binary, n: long>>")
PARTIAL_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("head_log", pa.float64()), ("score", pa.float64()),
    ("tail", pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())])))])


def shared_class(token: bytes) -> int:
    """The class of a token that has none of its own."""
    return SINGLE + zlib.crc32(token[-2:]) % SHARED


class ClassOf(dict):
    """Classes by token; what is not among the single ones is worked out, and kept up to a bound."""

    def __init__(self, single: dict[bytes, int]):
        super().__init__(single)

    def __missing__(self, token: bytes) -> int:
        found = shared_class(token)
        if len(self) < HELD and len(token) <= LONGEST_HEAD:
            self[token] = found
        return found


class LogBilinear:
    """Class scores from two context classes; ``log_probabilities`` are normalised."""

    def __init__(self, classes: int = CLASSES, width: int = WIDTH, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.context = draw.normal(0, 0.1, (classes, width))
        self.weight = np.ones((2, width))
        self.target = draw.normal(0, 0.1, (classes, width))
        self.bias = np.zeros(classes)
        self.classes, self.seed = classes, seed

    def _predicted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.context[a] * self.weight[0] + self.context[b] * self.weight[1]

    def log_probabilities(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Natural logarithms for all classes after each pair of classes: one matrix product."""
        scores = self._predicted(a, b) @ self.target.T + self.bias
        top = scores.max(axis=1, keepdims=True)
        return scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))

    def train(self, trigrams: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> LogBilinear:
        """Noise-contrastive estimation on counted trigrams of classes."""
        if not len(trigrams):
            return self
        draw, k = np.random.default_rng(self.seed), NOISE
        share = np.cumsum(counts) / counts.sum()
        noise = np.bincount(trigrams % self.classes, counts, self.classes) + 1
        noise = noise / noise.sum()
        log_noise = np.log(k * noise).astype(np.float32)
        self.bias = np.log(noise)
        noise_share = np.cumsum(noise)
        parts = [self.context, self.weight, self.target, self.bias]
        parts = [p.astype(np.float32) for p in parts]
        one_hot = np.eye(self.classes, dtype=np.float32)
        squares = [np.full_like(p, 1e-3) for p in parts]
        for step in range(steps):
            t = trigrams[np.minimum(np.searchsorted(share, draw.random(BATCH)), len(trigrams) - 1)]
            a, b, c = t // self.classes**2, t // self.classes % self.classes, t % self.classes
            # a batch shares its noise, so that all scores are one matrix product
            z = np.minimum(np.searchsorted(noise_share, draw.random(k)), self.classes - 1)
            context, weight, target, bias = parts
            r = context[a] * weight[0] + context[b] * weight[1]
            true = 1 / (1 + np.exp(-((r * target[c]).sum(1) + bias[c] - log_noise[c])))
            fake = 1 / (1 + np.exp(-(r @ target[z].T + bias[z] - log_noise[z])))
            up, down = (1 - true) / BATCH, -fake / BATCH
            d_r = up[:, None] * target[c] + down @ target[z]
            at_a, at_b, at_c, at_z = (one_hot[x].T for x in (a, b, c, z))
            grads = [at_a @ (d_r * weight[0]) + at_b @ (d_r * weight[1]),
                     np.stack([(d_r * context[a]).sum(0), (d_r * context[b]).sum(0)]),
                     at_c @ (up[:, None] * r) + at_z @ (down.T @ r),
                     at_c @ up + at_z @ down.sum(0)]
            rate = RATE * (1 - step / steps)
            for part, grad, square in zip(parts, grads, squares, strict=True):
                square += grad * grad
                part += rate * grad / np.sqrt(square)
        self.context, self.weight, self.target, self.bias = (p.astype(np.float64) for p in parts)
        return self


def _texts(batch: pa.RecordBatch) -> list[list[bytes]]:
    return [words(t or "") for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def count_tokens(texts: DataFrame) -> DataFrame:
    """token and c over the rows of ``texts``, end tokens included; a written table."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            held: Counter = Counter()
            for b in batches:
                own = _texts(b)
                held[END] += len(own)
                for text in own:
                    held.update(text)
                if len(held) > HELD:
                    yield from held.items()
                    held.clear()
            yield from held.items()
        yield from in_batches(found(), TOKEN_ARROW, size=1 << 15)

    return materialise(texts.mapInArrow(counted, "token binary, c long")
                       .groupBy("token").agg(F.sum("c").alias("c")), "lm-tokens")


def frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """Counts of the most frequent tokens, ``most`` at most: all from the least count that allows it."""
    short = counts.where(F.octet_length("token") <= LONGEST_HEAD)
    # sixteen steps per power of two, so a few hundred groups for any corpus
    step = F.floor(F.log2("c") * 16).cast("int")
    sizes = short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, total = None, 0
    for s in sizes:
        total += s["count"]
        if total > most:
            break
        least = s["step"]
    if least is None:
        return {}
    return {bytes(r.token): r.c for r in short.where(step >= least).collect()}


class Model:
    """What tasks need: counts of frequent tokens, classes, totals, and the network."""

    def __init__(self, head: dict[bytes, int], single: dict[bytes, int], totals: np.ndarray,
                 train_tokens: int, distinct: int, network: LogBilinear):
        self.head, self.single, self.network = head, single, network
        self.train_tokens, self.distinct = train_tokens, distinct
        # a token's share is (c + 1) / total: 1 in a class of its own; a shared one keeps
        # a share for unseen tokens
        self.log_total = np.log10(np.where(np.arange(CLASSES) < SINGLE, np.maximum(totals, 1), totals + 1))

    def class_scores(self, classes: list[np.ndarray]) -> np.ndarray:
        """For each text the log10 probabilities of its classes, less the classes' totals."""
        end = self.single.get(END, SINGLE)
        lengths = np.array([len(c) for c in classes])
        data = np.concatenate([np.concatenate([[end, end], c]) for c in classes])
        keep = np.ones(len(data), bool)
        starts = np.cumsum(lengths + 2) - lengths - 2
        keep[starts] = keep[starts + 1] = False
        at = np.flatnonzero(keep)
        a, b, c = data[at - 2], data[at - 1], data[at]
        pairs, place = np.unique(a * CLASSES + b, return_inverse=True)
        found = np.empty(len(at))
        for first in range(0, len(pairs), 4096):  # bounded rows per matrix product
            block = pairs[first:first + 4096]
            logs = self.network.log_probabilities(block // CLASSES, block % CLASSES)
            mine = np.flatnonzero((place >= first) & (place < first + 4096)) if len(pairs) > 4096 \
                else np.arange(len(at))
            found[mine] = logs[place[mine] - first, c[mine]]
        found = found / math.log(10) - self.log_total[c]
        return np.add.reduceat(found, np.cumsum(lengths) - lengths)


def learn(training: DataFrame, text_column: str = "text") -> tuple[Model, DataFrame]:
    """The model and the written counts of all training tokens."""
    texts = training.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    counts = count_tokens(texts)
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    head = frequent(counts, HEAD)
    top = sorted(head.items(), key=lambda x: (-x[1], x[0]))[:SINGLE]
    single = {token: i for i, (token, _) in enumerate(top)}
    shared = counts.sparkSession.sparkContext.broadcast(single)

    def by_class(batches):
        own, held = ClassOf(shared.value), np.zeros(CLASSES)
        for b in batches:
            at = [own[bytes(t)] for t in b.column(0).to_pylist()]
            held += np.bincount(at, b.column(1).to_numpy() + 1.0, CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int64()),
                                          pa.array(held.astype(np.int64))], names=["trigram", "n"])

    totals = np.zeros(CLASSES)
    for r in counts.mapInArrow(by_class, "trigram long, n long").groupBy("trigram").agg(
            F.sum("n").alias("n")).collect():
        totals[r.trigram] = r.n

    def trigrams(batches):
        own, held = ClassOf(shared.value), np.zeros(CLASSES**3, np.int64)
        end = own[END]
        for b in batches:
            texts = _texts(b)
            stream = []
            for text in texts:
                stream += [end, end, *map(own.__getitem__, text), end]
            c = np.array(stream, np.int64)
            keep = np.ones(len(c), bool)
            lengths = np.array([len(t) + 3 for t in texts], np.int64)
            starts = np.cumsum(lengths) - lengths
            keep[starts] = keep[starts + 1] = False
            at = np.flatnonzero(keep)
            held += np.bincount((c[at - 2] * CLASSES + c[at - 1]) * CLASSES + c[at], minlength=CLASSES**3)
        some = np.flatnonzero(held)
        for first in range(0, len(some), 1 << 16):
            block = some[first:first + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(held[block])], schema=TRIGRAM_ARROW)

    seen = texts.mapInArrow(trigrams, "trigram long, n long").groupBy("trigram").agg(
        F.sum("n").alias("n")).toArrow()  # a row per trigram of classes at most
    keys, n = (seen.column(x).to_numpy() for x in ("trigram", "n"))
    order = np.argsort(keys)
    steps = max(STEPS, (total.n or 0) // STEP_TOKENS)
    network = LogBilinear().train(keys[order], n[order].astype(float), steps)
    return Model(head, single, totals, total.n or 0, total.v, network), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, held_out: tuple[int, int] = (7, 2),
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        (remainder(f"`{id_column}`", held_out[0]) == held_out[1]).alias("held_out"),
                        F.col(f"`{text_column}`").cast("string").alias("text"))

    def scored(batches):
        m = shared.value
        own, row = ClassOf(m.single), TaskContext.get().partitionId() << 40
        logs = {t: math.log10(c + 1) for t, c in m.head.items()}

        def found():
            nonlocal row
            for b in batches:
                tokens = [[*t, END] for t in _texts(b)]
                if not tokens:
                    continue
                classes = [np.fromiter(map(own.__getitem__, t), np.int64, len(t)) for t in tokens]
                scores = m.class_scores(classes).tolist()
                for doc_id, out, text, of_classes in zip(
                        b.column(0).to_pylist(), b.column(1).to_pylist(), tokens, scores, strict=True):
                    log, tail = list(map(logs.get, text)), {}
                    if None in log:
                        tail = Counter(t for t, x in zip(text, log, strict=True) if x is None)
                        log = [x for x in log if x is not None]
                    row += 1
                    head_log = math.fsum(log)
                    yield (row, doc_id, out, len(text), len(log), head_log, of_classes + head_log,
                           [{"token": t, "n": n} for t, n in tail.items()])
        yield from in_batches(found(), PARTIAL_ARROW, size=512)

    # written, so that the numbers of rows stay the same for the join below
    partial = materialise(given.mapInArrow(scored, PARTIAL), "lm-partial")
    rare = partial.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.n")
    rare = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("known"))
    space = math.log10(model.train_tokens + model.distinct + 1)
    log = F.coalesce("log", F.lit(0.0))
    return partial.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + log - F.col("n_tokens") * F.lit(space)).alias("base_score"),
        (F.col("score") + log).alias("score"))


@query("op2_lm_scores")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model of those outside the held-out part."""
    docs = table(spark, sf_dir, "documents")
    model, counts = learn(docs.where(remainder("doc_id", 7) != 2))
    return score(docs, model, counts)
