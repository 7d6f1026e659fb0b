"""Vector codes: integer codebooks per part, nearest entries by sliced bitmasks.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts.
Each part has a codebook of at most 64 entries, which starts as that part of
the vectors with the smallest ids and is moved to the floored means of what it
attracts, a few rounds long.

The nearest entry of a part is found exactly, without comparing all entries:

1. In each dimension the entries are sorted by their coordinate, and the bits
   of the first 0, 1, 2, ... of them are kept as uint64 masks.
2. The distance to the entry whose first coordinates are nearest is the
   initial radius. Only entries within it in every dimension can be as near, so
   a range of sorted coordinates is cut out per dimension: two look-ups, and
   the difference of their prefix masks.
3. The masks of all dimensions are ANDed. What is left contains the nearest
   entry, and its few bits are compared in full, in the order of their indices.

Tasks hold one batch of vectors and the codebooks (at most 64 vectors), which
are the only thing the driver gathers; sums and counts per entry are added up
in each task first, then by a shuffle. No vector is sampled.

Defined results: vectors that are null, empty, or hold null or non-finite
components are dropped, and so are those whose length differs from that of the
smallest id's vector. Components beyond 2^27 (after scaling) count as 2^27, so
that every sum fits a long. A length that the parts do not divide is filled up
with zeros. With fewer than 64 vectors the codebooks are smaller. Rows with one
id are all kept, ordered by their vectors where the first 64 are drawn; null
ids come last. Null labels count as one label. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import materialise, query, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 27

SUM_ARROW = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("at", pa.int32()), ("total", pa.int64())])
CODE_ARROW = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()),
                        ("error", pa.int64())])


class Codebook:
    """Entries of one part, and what finds the nearest of them: masks by sorted coordinate."""

    def __init__(self, entries: np.ndarray):
        if not 0 < len(entries) <= 64:
            raise ValueError("a codebook has 1 to 64 entries, one for each bit of a mask")
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        bits = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.zeros((len(entries) + 1, entries.shape[1]), np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=self.prefix[1:])
        self.first = order[:, 0]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry (the lower one of equals), and its squared distance."""
        distinct, back = np.unique(points[:, 0], return_inverse=True)
        near = np.searchsorted(self.sorted[:, 0], distinct).clip(0, len(self.entries) - 1)[back]
        known = np.minimum(self.distance(points, self.first[near]),
                           self.distance(points, self.first[np.maximum(near - 1, 0)]))
        # a whole number not below the root, whatever the root's last digit does
        radius = np.sqrt(known.astype(np.float64)).astype(np.int64) + 1
        masks = np.full(len(points), np.iinfo(np.uint64).max, np.uint64)
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - radius, side="left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + radius, side="right")
            masks &= self.prefix[high, d] & ~self.prefix[low, d]
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.zeros(len(points), np.int64)
        left = np.arange(len(points))
        while len(left):
            lowest = masks[left] & (~masks[left] + np.uint64(1))
            entry = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
            found = self.distance(points[left], entry)
            nearer = found < best[left]
            best[left[nearer]], index[left[nearer]] = found[nearer], entry[nearer]
            masks[left] ^= lowest
            left = left[masks[left] != 0]
        return index, best

    def distance(self, points: np.ndarray, entry: np.ndarray) -> np.ndarray:
        gap = points - self.entries[entry]
        return (gap * gap).sum(axis=1)


def kept(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
         label_column: str = "label") -> DataFrame:
    """vec_id, label (as text) and vector (doubles) of the rows that can be coded."""
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("string").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
    ).where(F.size("vector") > 0).where(whole)


def integers(flat: np.ndarray, width: int, scale: int, parts: int) -> np.ndarray:
    """Vectors one after another as floored integers, a row each, filled up to whole parts."""
    whole = np.clip(np.floor(flat.reshape(-1, width) * scale), -LARGEST, LARGEST).astype(np.int64)
    return np.pad(whole, ((0, 0), (0, -width % parts)))


def first_codebooks(rows: DataFrame, parts: int, entries: int, scale: int) -> tuple[np.ndarray | None, int]:
    """Codebooks (part, entry, coordinate) of the smallest ids, and the vectors' length."""
    first = [r.vector for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).collect()]
    if not first:
        return None, 0
    width = len(first[0])
    drawn = rows.where(F.size("vector") == width).orderBy(F.col("vec_id").asc_nulls_last(), "vector") \
        .limit(entries).collect()
    whole = integers(np.concatenate([np.array(r.vector) for r in drawn]), width, scale, parts)
    return whole.reshape(len(drawn), parts, -1).swapaxes(0, 1), width


def _blocks(batches: Iterator[pa.RecordBatch], width: int, scale: int, parts: int):
    """Batches with their vectors as integers (row, part, coordinate)."""
    for b in batches:
        if b.num_rows:
            flat = b.column(b.schema.get_field_index("vector")).flatten().to_numpy()
            yield b, integers(flat, width, scale, parts).reshape(b.num_rows, parts, -1)


def moved(rows: DataFrame, codebooks: np.ndarray, width: int, scale: int) -> np.ndarray:
    """The codebooks after one round: floored means of the parts each entry attracts."""
    parts, entries, size = codebooks.shape
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in shared.value]
        totals = np.zeros((parts, entries, size + 1), np.int64)  # the last place counts
        for _, points in _blocks(batches, width, scale, parts):
            for part, book in enumerate(books):
                index, _ = book.nearest(points[:, part])
                np.add.at(totals[part, :, :size], index, points[:, part])
                totals[part, :, size] += np.bincount(index, minlength=entries)
        part, entry, at = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()),
             pa.array(totals[part, entry, at])], schema=SUM_ARROW)

    found = rows.select("vector").mapInArrow(summed, "part int, entry int, at int, total long") \
        .groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).toArrow()
    totals = np.zeros((parts, entries, size + 1), np.int64)
    totals[tuple(found.column(c).to_numpy() for c in ("part", "entry", "at"))] = found.column("total").to_numpy()
    counts = totals[:, :, size:]
    return np.where(counts > 0, totals[:, :, :size] // np.maximum(counts, 1), codebooks)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: int = SCALE) -> tuple[np.ndarray | None, int]:
    """Codebooks after the given rounds over all rows of ``kept``, and the vectors' length."""
    codebooks, width = first_codebooks(rows, parts, entries, scale)
    if codebooks is not None:
        rows = rows.where(F.size("vector") == width)
        for _ in range(rounds):
            codebooks = moved(rows, codebooks, width, scale)
    return codebooks, width


def coded(rows: DataFrame, codebooks: np.ndarray, width: int, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every row of ``kept``."""
    parts = len(codebooks)
    shared = rows.sparkSession.sparkContext.broadcast(codebooks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in shared.value]
        for b, points in _blocks(batches, width, scale, parts):
            code = np.empty((b.num_rows, parts), np.uint8)
            error = np.zeros(b.num_rows, np.int64)
            for part, book in enumerate(books):
                index, found = book.nearest(points[:, part])
                code[:, part] = index
                error += found
            text = code.tobytes().hex()
            codes = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(codes, pa.string()), pa.array(error)], schema=CODE_ARROW)

    return rows.where(F.size("vector") == width).mapInArrow(
        work, "vec_id long, label string, code string, error long")


def compress(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
             label_column: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """The coded rows (vec_id, label, code, error) and the codebooks (part, entry, coordinate)."""
    rows = kept(vectors, id_column, vector_column, label_column)
    codebooks, width = fit(rows, parts, entries, rounds, scale)
    if codebooks is None:
        empty = vectors.sparkSession.createDataFrame([], "vec_id long, label string, code string, error long")
        return empty, np.zeros((parts, 0, 0), np.int64)
    return coded(rows, codebooks, width, scale), codebooks


def decode(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The integers that a code stands for."""
    return np.concatenate([book[i] for book, i in zip(codebooks, bytes.fromhex(code), strict=True)])


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """The rows with the summed error of their label; null is a label.

    Rows are counted up before the shuffle. The sums are written, so that Spark
    broadcasts them if they are small, and splits hot labels in the join if not.
    """
    written = materialise(codes, "codes")
    sums = materialise(written.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    return written.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def _round(before: str, after: str) -> str:
    return f"""
{after}_of AS (
  SELECT vec_id, p.part, p.v, arg_min(c.entry, ({_GAP}) * 64 + c.entry) AS entry
  FROM points p JOIN {before} c ON p.part = c.part GROUP BY ALL),
{after}_sum AS (
  SELECT part, entry, {', '.join(f'floor(sum(v[{i}])::HUGEINT / count(*))::BIGINT AS m{i}' for i in range(1, 5))}
  FROM {after}_of GROUP BY part, entry),
{after} AS (
  SELECT c.part, c.entry, CASE WHEN m1 IS NULL THEN c.v ELSE [m1, m2, m3, m4] END AS v
  FROM {before} c LEFT JOIN {after}_sum s ON c.part = s.part AND c.entry = s.entry)"""


_GAP = " + ".join(f"(p.v[{i}] - c.v[{i}]) * (p.v[{i}] - c.v[{i}])" for i in range(1, 5))

OP13_SQL = f"""
WITH whole AS (
  SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
points AS (
  SELECT vec_id, label, part, v[4 * part + 1:4 * part + 4] AS v FROM whole, (SELECT unnest(range(16)) AS part)),
book0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v
  FROM points WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT 64)),
{_round('book0', 'book1')},
{_round('book1', 'book2')},
final AS (
  SELECT vec_id, label, p.part, min(({_GAP}) * 64 + c.entry) AS best
  FROM points p JOIN book2 c ON p.part = c.part GROUP BY ALL),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code,
         sum(best // 64)::BIGINT AS error
  FROM final GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book2) AS codebooks_sha256
FROM coded
"""


@query("op13_vector_codes", OP13_SQL)
def op13(spark, sf_dir):
    """Code and error of every vector that can be coded."""
    codes, codebooks = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
