"""What the operators share: tables, whole texts, words, shared files, row batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine.session import add_input, begin_sizing, materialise, prepare, scratch  # noqa: F401

#: ASCII white space, the only separator of words.
BLANKS = r"[\x20\x09-\x0D]+"
#: Texts run to 100 KB and more, so that a batch for Python holds few rows, and few bytes where they are longer.
BATCH_ROWS, BATCH_BYTES = "500", "64m"


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register ``f(spark, sf_dir) -> DataFrame`` among the queries of this folder."""
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            begin(spark, sf_dir)
            return f(spark, sf_dir)

        QUERIES[name] = Query(run, oracle)
        return f
    return register


def ready(spark: SparkSession) -> SparkSession:
    """The library's settings, and batches that hold long texts in bounded memory."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def begin(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    """A new query or stage: its settings, and shuffles that start with partitions for ``tables``.

    What an earlier one counted is forgotten; tables read later are added.
    """
    begin_sizing(ready(spark))
    add_input(spark, *(f"{sf_dir}/{name}.parquet" for name in tables))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    add_input(spark, path)
    return spark.read.parquet(path)


def whole(column: str) -> Column:
    """A text column as it is, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(column: str, of: int) -> Column:
    """crc32 of an id's text, modulo ``of``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(of)


def words(text: str) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case. Bytes know ASCII letters and blanks only."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096,
               most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, bounded in rows and in bytes of their longest values."""
    block, held = [], 0
    for row in rows:
        block.append(row)
        held += sum(len(v) for v in row if isinstance(v, (bytes, str, list)))
        if len(block) >= size or held >= most_bytes:
            yield _batch(block, schema)
            block, held = [], 0
    if block:
        yield _batch(block, schema)


def _batch(block: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*block, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema
    )


def fresh_name(name: str, taken: list[str]) -> str:
    """A column name none of ``taken`` clashes with, in any case."""
    while name.lower() in (t.lower() for t in taken):
        name += "_"
    return name


def with_column(frame: DataFrame, source: str, name: str, kind: str, arrow: pa.DataType,
                 work: Callable[[], Callable]) -> DataFrame:
    """The frame with a column that ``work()`` makes of ``source``, batch by batch."""
    kept = [c for c in frame.columns if c.lower() != name.lower()]
    copy = fresh_name("source", kept)
    # the column is read under a name of its own, as it may be the one replaced
    given = frame.select(*(f"`{c}`" for c in kept), frame[f"`{source}`"].alias(copy))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = work()
        for b in batches:
            made = pa.array(f(b.column(len(kept)).to_pylist()), arrow)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], made], names=[*kept, name])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1]),
                        f"`{name}` {kind}"])
    return given.mapInArrow(rows, schema)


class SharedFiles:
    """Files of tasks below a folder all executors reach, whatever store it is in.

    Names hold a random part, so that a repeated task never meets the files of
    the attempt before it.
    """

    def __init__(self, folder: str):
        self.store, self.folder = fs.FileSystem.from_uri(folder)

    def fresh(self, name: str) -> str:
        self.store.create_dir(self.folder, recursive=True)
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    @contextmanager
    def writing(self, path: str):
        with self.store.open_output_stream(path, buffer_size=1 << 20) as out:
            yield out

    def reading(self, path: str):
        return self.store.open_input_file(path)

    def streaming(self, path: str):
        return self.store.open_input_stream(path, buffer_size=1 << 20)

    def drop(self, path: str) -> None:
        self.store.delete_file(path)
