"""Exact deduplication by Grace hashing.

Texts are equal when they are the same after each run of ASCII blanks became
one space; a null text counts as empty. Of equal texts the row with the
smallest id stays.

1. Every task folds the equal texts it has read into one entry (an
   open-addressing table that compares whole contents), so a text that a third
   of all rows share leaves each task once.
2. Entries are dealt out by content digest: the first level of partitions.
3. Each partition is deduplicated in a table of bounded size. Beyond the
   bound its entries go to spill files by the next bits of the digest, and
   every file is treated the same way until it fits.
4. Rows find their group by digest. That join carries no text, and adaptive
   execution splits a digest with very many rows over several tasks.

Defined results: an empty table gives no rows. Rows that repeat the smallest
id of a group are all marked kept by ``assign_groups``; ``deduplicate`` keeps
one of them. Null ids come after all others; a group of null ids only has a
null ``keep_id`` and keeps those rows (``deduplicate``: one). Other columns,
whatever their names, are handed through by ``deduplicate``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import BLANKS, SharedFiles, in_batches, query, scratch, table, whole

#: Content bytes a task holds before it spills (or, while folding, hands on).
TABLE_BYTES = 96 << 20
#: Spill files of one level.
FAN_OUT = 16
LAST = (1 << 63) - 1  # stands for a null id in the comparison only

ENTRY = "digest binary, content string, keep_id long, n long, ties long"
GROUP = "digest binary, keep_id long, n long, ties long"
ENTRY_ARROW = pa.schema([("digest", pa.binary()), ("content", pa.string()), ("keep_id", pa.int64()),
                         ("n", pa.int64()), ("ties", pa.int64())])
GROUP_ARROW = pa.schema([f for f in ENTRY_ARROW if f.name != "content"])
HEAD = struct.Struct("<32s?qqqI")


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = np.full(slots, -1, np.int64)
        self.entries: list[list] = []  # digest, content, keep_id, n, ties
        self.held = 0

    def _place(self, digest: bytes, content: bytes) -> tuple[int, int]:
        """The slot, and the entry in it or -1."""
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (entry := int(self.slots[at])) >= 0:
            known = self.entries[entry]
            if known[0] == digest and known[1] == content:
                return at, entry
            at = (at + 1) & mask
        return at, -1

    def add(self, digest: bytes, content: bytes, keep_id: int | None, n: int, ties: int) -> None:
        at, entry = self._place(digest, content)
        if entry < 0:
            self.slots[at] = len(self.entries)
            self.entries.append([digest, content, keep_id, n, ties])
            self.held += len(content) + 200
            if 2 * len(self.entries) > len(self.slots):
                self._grow()
            return
        known = self.entries[entry]
        known[3] += n
        old, new = (LAST if x is None else x for x in (known[2], keep_id))
        if new < old:
            known[2], known[4] = keep_id, ties
        elif new == old:
            known[4] += ties

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for i, (digest, *_) in enumerate(self.entries):
            at = int.from_bytes(digest[-8:], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def fold(rows: Iterator[tuple], limit: int) -> Iterator[list]:
    """Equal contents met within ``limit`` bytes of table as one entry each."""
    found = ContentTable()
    for row in rows:
        found.add(*row)
        if found.held > limit:
            yield from found.entries
            found = ContentTable()
    yield from found.entries


def grace(rows: Iterator[tuple], spill: SharedFiles, limit: int, level: int = 0) -> Iterator[list]:
    """One entry for each content among ``rows``, through spill files where needed."""
    found, names, files = ContentTable(), [], []
    try:
        for row in rows:
            if files:
                _put(files[_bucket(row[0], level)], row)
                continue
            found.add(*row)
            if found.held > limit and len(found.entries) > 1:
                names = [spill.fresh(f"level{level}-{b}") for b in range(FAN_OUT)]
                files = [spill.store.open_output_stream(name, buffer_size=1 << 18) for name in names]
                for entry in found.entries:
                    _put(files[_bucket(entry[0], level)], entry)
                found = None
        for file in files:
            file.close()
        if not files:
            yield from found.entries
        while names:
            yield from grace(_spilled(spill, names[0]), spill, limit, level + 1)
            spill.drop(names.pop(0))
    finally:
        for file in files:
            if not file.closed:
                file.close()
        for name in names:
            spill.drop(name)


def _bucket(digest: bytes, level: int) -> int:
    """Each level takes another half byte; all 64 differ only for equal digests."""
    byte = digest[(level // 2) % 32]
    return byte >> 4 if level % 2 == 0 else byte & 15


def _put(file, row) -> None:
    digest, content, keep_id, n, ties = row
    file.write(HEAD.pack(digest, keep_id is None, keep_id or 0, n, ties, len(content)))
    file.write(content)


def _spilled(spill: SharedFiles, name: str) -> Iterator[tuple]:
    with spill.streaming(name) as file:
        while head := file.read(HEAD.size):
            digest, no_id, keep_id, n, ties, size = HEAD.unpack(head)
            yield digest, file.read(size), None if no_id else keep_id, n, ties


def with_digest(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, content (blanks as one space) and its SHA-256 for every row."""
    content = F.regexp_replace(whole(text_column), BLANKS, " ")
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), content.alias("content")) \
        .withColumn("digest", F.unhex(F.sha2("content", 256)))


def groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           table_bytes: int = TABLE_BYTES) -> DataFrame:
    """A row per distinct content: digest, keep_id, n (rows), ties (rows with keep_id)."""
    folder = scratch(docs.sparkSession, "grace")

    def read(batches):
        for b in batches:
            for digest, content, doc_id in zip(*(b.column(n).to_pylist() for n in
                                                 ("digest", "content", "doc_id")), strict=True):
                yield digest, content.encode("utf-8", "surrogatepass"), doc_id, 1, 1

    def folded(batches):
        rows = ((d, c.decode("utf-8", "surrogatepass"), k, n, t)
                for d, c, k, n, t in fold(read(batches), table_bytes))
        yield from in_batches(rows, ENTRY_ARROW)

    def reduced(batches):
        def entries():
            for b in batches:
                for d, c, k, n, t in zip(*(x.to_pylist() for x in b.columns), strict=True):
                    yield d, c.encode("utf-8", "surrogatepass"), k, n, t

        rows = ((d, k, n, t) for d, _, k, n, t in grace(entries(), SharedFiles(folder), table_bytes))
        yield from in_batches(rows, GROUP_ARROW)

    entries = with_digest(docs, id_column, text_column).mapInArrow(folded, ENTRY)
    return entries.repartition("digest").mapInArrow(reduced, GROUP)


def assign_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  table_bytes: int = TABLE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row."""
    rows = with_digest(docs, id_column, text_column).select("doc_id", "digest")
    found = groups(docs, id_column, text_column, table_bytes)
    return rows.join(found, "digest", "left").select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows are matched on id and digest, so no hot digest gathers texts. Only
    rows that repeat both are compared once more.
    """
    names = docs.columns
    own = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.regexp_replace(whole(text_column), BLANKS, " "), 256)).alias("digest"))
    found = groups(docs, id_column, text_column, table_bytes).select(
        F.col("digest").alias("of"), "keep_id", "ties")
    kept = own.join(found, (F.col("digest") == F.col("of"))
                    & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    once = kept.where("ties = 1").select("row")
    again = kept.where("ties > 1").dropDuplicates(["digest"]).select("row")
    return once.unionByName(again).select(*(F.col("row").getField(c).alias(c) for c in names))


OP8_SQL = r"""
WITH own AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
found AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM own GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM own JOIN found USING (text_sha256)
"""


@query("op8_exact_dedup", OP8_SQL)
def op8(spark, sf_dir):
    """The group of every document, dropped ones included."""
    return assign_groups(table(spark, sf_dir, "documents"))
