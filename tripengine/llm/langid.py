"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ``ORDER`` bytes long, with
counts of the bytes that followed. A byte that was seen after a context costs
its share there; one that was not costs an escape and is coded in the next
shorter context, in the end with eight bits (escape method C: an escape counts
once for each different byte; no exclusion). The counts are frozen, so every
text has an exact code length in each language, and the shortest wins.

The trees are fitted on a bounded sample of labelled rows: ``SAMPLE_BYTES``
over all languages in equal parts, drawn by a hash of the id from texts of at
most ``LONGEST_SAMPLE`` bytes. The tables that tasks receive are bounded by
that. Prediction reads whole texts, and nothing but the text.

All languages share one table of grams per order: a gram seen in any language
has its ready cost in every language, so that most bytes need one look-up.

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is everything if no labelled row exists. The score is the share of
the best language if each language's weight is two to the minus code length.
Equal lengths go to the language that is first by name. Null ids count as an
empty id; repeated rows are predicted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import fresh_name, in_batches, query, remainder, table, with_column

ORDER = 4
SAMPLE_BYTES, LONGEST_SAMPLE = 2 << 20, 64 << 10
UNDETERMINED = "und"
#: What stands before the first byte of a text.
START = b"\n" * ORDER

PREDICTION = "doc_id long, held_out boolean, lang_pred string, score double"
PREDICTION_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()),
                              ("lang_pred", pa.string()), ("score", pa.float64())])
COUNT_ARROW = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.int64()),
                         ("n", pa.int64())])


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """For each byte from ``ORDER`` on, the ``size`` bytes that end with it, as a number."""
    found = np.zeros(len(data) - ORDER, np.int64)
    for back in range(size - 1, -1, -1):
        found = found << 8 | data[ORDER - back:len(data) - back]
    return found


def as_bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class GramTable:
    """Rows of costs by gram: open addressing, many look-ups at once."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows = keys, rows
        self.slots = np.full(1 << bits, -1, np.int32)
        at, waiting = self._home(keys), np.arange(len(keys), dtype=np.int32)
        while len(waiting):
            free = self.slots[at] < 0
            self.slots[at[free]] = waiting[free]  # of several the last one stays
            lost = self.slots[at] != waiting
            waiting, at = waiting[lost], (at[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        at = self._home(keys)
        found = self.slots[at]
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            found[open_] = self.slots[at[open_]]
            there = found[open_]
            open_ = open_[(there >= 0) & (self.keys[there] != keys[open_])]
        return found


class ContextTrees:
    """Frozen counts of all languages, as costs in bits."""

    def __init__(self, languages: list[str], counts: list[dict[str, tuple[np.ndarray, np.ndarray]]]):
        """``counts[k][lang]``: sorted grams of k + 1 bytes, and how often each was seen."""
        self.languages = languages
        width = max(1, len(languages))
        self.costs: list[GramTable] = []
        self.escapes: list[GramTable] = []
        for k in range(ORDER + 1):
            keys = np.unique(np.concatenate([counts[k][x][0] for x in languages] or [np.array([], np.int64)]))
            contexts, context_of = np.unique(keys >> 8, return_inverse=True)
            cost = np.full((len(keys), width), 8.0)
            if k and len(keys):  # the next shorter gram ends with the same byte, so it is known
                lower = self.costs[k - 1]
                cost = lower.rows[lower.find(keys & ((1 << 8 * k) - 1))].astype(np.float64)
            escape = np.zeros((len(contexts), width))
            for j, lang in enumerate(languages):
                mine, n = counts[k][lang]
                at = np.searchsorted(keys, mine)
                total = np.bincount(context_of[at], n, len(contexts))
                kinds = np.bincount(context_of[at], minlength=len(contexts))
                seen = kinds > 0
                escape[seen, j] = np.log2((total + kinds)[seen] / kinds[seen])
                cost[:, j] += escape[context_of, j]
                cost[at, j] = np.log2((total + kinds)[context_of[at]] / n)
            self.costs.append(GramTable(keys, cost.astype(np.float32)))
            self.escapes.append(GramTable(contexts, escape.astype(np.float32)))

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language."""
        sums = np.zeros((len(texts), len(self.languages)))
        # a block holds so many bytes; a longer text is cut into pieces that overlap
        most = max(4096, (1 << 21) // len(self.languages))
        block, owners, held = [], [], 0
        for i, text in enumerate(texts):
            for first in range(0, len(text), most):
                before = START if not first else text[first - ORDER:first]
                piece = before + text[first:first + most]
                block.append(piece)
                owners.append(i)
                held += len(piece)
                if held >= most:
                    self._add(sums, block, owners)
                    block, owners, held = [], [], 0
        if block:
            self._add(sums, block, owners)
        return sums

    def _add(self, sums: np.ndarray, pieces: list[bytes], owners: list[int]) -> None:
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths)
        full = grams(data, ORDER + 1)
        own = np.ones(len(full), bool)  # without the places whose bytes only stand before a piece
        for start in (ends - lengths)[1:]:
            own[start - ORDER:start] = False
        full = full[own]
        cost = np.zeros((len(full), len(self.languages)), np.float32)
        open_ = np.arange(len(full))
        for k in range(ORDER, -1, -1):
            gram = full[open_] & ((1 << 8 * (k + 1)) - 1)
            found = self.costs[k].find(gram)
            hit = found >= 0
            cost[open_[hit]] += self.costs[k].rows[found[hit]]
            open_, gram = open_[~hit], gram[~hit]
            if not len(open_):
                break
            context = self.escapes[k].find(gram >> 8)
            known = context >= 0
            cost[open_[known]] += self.escapes[k].rows[context[known]]
        cost[open_] += 8
        inside = lengths - ORDER
        some = inside > 0
        starts = (np.cumsum(inside) - inside)[some]
        np.add.at(sums, np.array(owners)[some], np.add.reduceat(cost, starts, axis=0, dtype=np.float64))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        results = [(UNDETERMINED, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not known or not self.languages:
            return results
        bits = self.bits([as_bytes(texts[i]) for i in known])
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
        for i, b, s in zip(known, best, share, strict=True):
            results[i] = self.languages[b], float(s)
        return results


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        lang_column: str = "lang", sample_bytes: int = SAMPLE_BYTES) -> ContextTrees:
    """Trees of a bounded sample of rows that have a language."""
    rows = labelled.select(F.col(f"`{id_column}`").cast("string").alias("id"),
                           F.col(f"`{text_column}`").cast("string").alias("text"),
                           F.col(f"`{lang_column}`").cast("string").alias("lang")) \
        .where("lang IS NOT NULL AND text IS NOT NULL") \
        .withColumns({"bytes": F.octet_length("text"), "draw": F.pmod(F.xxhash64("id"), F.lit(1 << 20)),
                      "own": F.xxhash64("id", "text")})
    short = F.col("bytes") <= LONGEST_SAMPLE
    about = rows.groupBy("lang").agg(
        F.coalesce(F.sum(F.when(short, F.col("bytes"))), F.lit(0)).alias("b"),
        F.min(F.when(short, F.col("draw"))).alias("least"),
        F.min(F.struct("bytes", "own")).alias("shortest")).collect()
    sizes = {r.lang: r.b for r in about}
    languages = sorted(sizes)
    each = sample_bytes / max(1, len(languages))
    share = F.create_map(*(F.lit(x) for lang in languages
                           for x in (lang, min(1.0, each / max(1, sizes[lang]))))) if languages else None
    if share is None:
        return ContextTrees([], [{} for _ in range(ORDER + 1)])
    # a language of which nothing would be drawn is known by its shortest text
    lost = [r.shortest.own for r in about
            if r.least is None or r.least >= min(1.0, each / max(1, sizes[r.lang])) * (1 << 20)]
    drawn = rows.where((short & (F.col("draw") < share[F.col("lang")] * (1 << 20))) | F.col("own").isin(lost))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, list[bytes]] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(START + as_bytes(text))

        def found():
            for lang, own in texts.items():
                for size in range(1, ORDER + 2):
                    parts = [grams(np.frombuffer(t, np.uint8).astype(np.int64), size) for t in own]
                    keys, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield from ((lang, size, k, c) for k, c in zip(keys.tolist(), n.tolist(), strict=True))
        yield from in_batches(found(), COUNT_ARROW, size=1 << 16)

    counts = drawn.select("text", "lang").mapInArrow(counted, "lang string, size int, gram long, n long") \
        .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # bounded by the sample
    lang_of = np.array(found.column("lang").to_pylist(), object)
    size_of, gram, n = (found.column(c).to_numpy() for c in ("size", "gram", "n"))
    tables = []
    for size in range(1, ORDER + 2):
        tables.append({})
        for lang in languages:
            mine = np.flatnonzero((size_of == size) & (lang_of == lang))
            mine = mine[np.argsort(gram[mine])]
            tables[-1][lang] = gram[mine].astype(np.int64), n[mine].astype(np.float64)
    seen = [x for x in languages if len(tables[0][x][0])]
    return ContextTrees(seen, tables)


def predict(docs: DataFrame, trees: ContextTrees, id_column: str = "doc_id", text_column: str = "text",
            held_out: tuple[int, int] = (4, 2)) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    given = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        (remainder(f"`{id_column}`", held_out[0]) == held_out[1]).alias("held_out"),
                        F.col(f"`{text_column}`").cast("string").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            found = model.predict(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], schema=PREDICTION_ARROW)

    return given.mapInArrow(rows, PREDICTION)


def known_language(docs: DataFrame, trees: ContextTrees, text_column: str = "text") -> DataFrame:
    """The rows whose text has a language, any with a letter if no language was learned; all columns stay."""
    if not trees.languages:
        return docs.where(F.col(f"`{text_column}`").cast("string").rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    name = fresh_name("lang_pred", docs.columns)

    def work():
        return lambda texts: [lang for lang, _ in shared.value.predict(texts)]

    told = with_column(docs, text_column, name, "string", pa.string(), work)
    return told.where(F.col(name) != UNDETERMINED).drop(name)


def training_rows(docs: DataFrame, held_out: tuple[int, int] = (4, 2), id_column: str = "doc_id") -> DataFrame:
    return docs.where(remainder(id_column, held_out[0]) != held_out[1])


@query("op6_language_id")
def op6(spark, sf_dir):
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(training_rows(docs)))
