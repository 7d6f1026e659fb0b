"""WARC archives with an index: written first, read by coalesced byte ranges.

* Records with equal payloads of at least ``LEAST_SHARED`` bytes: the one with
  the smallest id is a ``response``, the others are ``revisit`` records that
  refer to it. Smaller payloads are all responses.
* Every task writes archives of its own to the shared folder, a compressed
  member per record, and hands on an index row per record: archive, offset,
  length, URL, digest. The index is a Parquet table, so it names the files of
  those attempts only that ended well, and nothing is written anew when an
  executor is lost.
* Reading takes any part of the index. Records are dealt out by archive and
  stretch of the archive, sorted by offset, and neighbours are fetched with
  one read of bounded size. Type, digest and length come from the record; the
  digest of a payload is worked out again and compared.

Defined results: a null payload counts as empty, an empty table gives an empty
index. Rows that repeat an id and its payload are all responses. A null id is
never referred to: it comes after all others, and payloads of null ids only
stay responses. A null URL leaves out its header; blanks in one are escaped.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine.llm.common import SharedFiles, in_batches, materialise, query, scratch, table, whole

LEAST_SHARED = 100
#: Bytes of one archive, of one read, and between two records that one read still covers.
ARCHIVE_BYTES, READ_BYTES, GAP_BYTES = 256 << 20, 4 << 20, 64 << 10
DATE = "1970-01-01T00:00:00Z"
#: Fixed value of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "archive string, offset long, length long, page_id long, url string, digest string"
INDEX_ARROW = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                         ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string())])
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")
RECORD_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                          ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                          ("payload_digest", pa.string()), ("payload", pa.binary())])


def record(page_id: int | None, url: str | None, digest: str, payload: bytes,
           refers_to: int | None, date: str = DATE) -> bytes:
    """One record, not yet compressed. A revisit holds the headers without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" \
        + b"Content-Length: %d\r\n\r\n" % len(payload)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", date), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        escaped = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(("WARC-Target-URI", escaped))
    if refers_to is None:
        block += payload
    else:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass")
    return b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header fields, the payload's length by its HTTP header, and the payload held here."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    length = int(re.search(rb"(?im)^content-length: *([0-9]+)", http)[1])
    return fields, length, payload


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


class Archives:
    """Writes records one after the other and begins a new archive beyond the bound."""

    def __init__(self, files: SharedFiles, most_bytes: int):
        self.files, self.most = files, most_bytes
        self.out, self.name, self.at = None, "", 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at + len(data) > self.most and self.at:
            self.close()
            path = self.files.fresh("archive") + ".warc.gz"
            self.out = self.files.store.open_output_stream(path, buffer_size=1 << 20, compression=None)
            self.name, self.at = path.rsplit("/", 1)[1], 0
        self.out.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def packed(data: bytes) -> bytes:
    """A gzip member of its own, so that a record can be read alone."""
    maker = zlib.compressobj(6, zlib.DEFLATED, 31)
    return maker.compress(data) + maker.flush()


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url",
                   payload_column: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives below ``folder``; gives their index, a written table with a row per record."""
    given = pages.select(F.col(f"`{id_column}`").cast("long").alias("page_id"),
                         F.col(f"`{url_column}`").cast("string").alias("url"),
                         whole(f"`{payload_column}`").alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256))
    # folded in each task first; texts are not part of it
    shared = given.where(F.octet_length("payload") >= LEAST_SHARED).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    # adaptive execution splits a digest with very many rows over several tasks
    decided = given.join(shared, "digest", "left").select(
        "page_id", "url", "digest", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = Archives(SharedFiles(folder), archive_bytes)

        def rows():
            for b in batches:
                for page_id, url, digest, payload, refers_to in zip(
                        *(c.to_pylist() for c in b.columns), strict=True):
                    data = record(page_id, url, digest, payload.encode("utf-8", "surrogatepass"), refers_to)
                    yield *archives.add(packed(data)), page_id, url, digest

        try:
            yield from in_batches(rows(), INDEX_ARROW)
        finally:
            archives.close()

    return materialise(decided.mapInArrow(written, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str, read_bytes: int = READ_BYTES,
                 gap_bytes: int = GAP_BYTES, payloads: bool = True) -> DataFrame:
    """The records of any rows of an index. Revisits have no payload of their own."""
    wanted = index.select("archive", "offset", "length", "page_id", "url", "digest")
    dealt = wanted.withColumn("stretch", F.floor(F.col("offset") / F.lit(read_bytes))) \
        .repartition("archive", "stretch").drop("stretch").sortWithinPartitions("archive", "offset")

    def ranges(batches) -> Iterator[list[tuple]]:
        """Rows whose bytes one read fetches."""
        block: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block and (row[0] != block[0][0]
                              or row[1] - (block[-1][1] + block[-1][2]) > gap_bytes
                              or row[1] + row[2] - block[0][1] > read_bytes):
                    yield block
                    block = []
                block.append(row)
        if block:
            yield block

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, opened, name = SharedFiles(folder), None, ""

        def rows():
            nonlocal opened, name
            for block in ranges(batches):
                if block[0][0] != name:
                    if opened is not None:
                        opened.close()
                    name = block[0][0]
                    opened = files.reading(f"{files.folder}/{name}")
                start = block[0][1]
                data = opened.read_at(block[-1][1] + block[-1][2] - start, start)
                for _, offset, length, page_id, url, digest in block:
                    member = data[offset - start:offset - start + length]
                    fields, size, payload = parsed(zlib.decompress(member, 31))
                    kind, found = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response":
                        found = hashlib.sha256(payload).hexdigest()
                        if len(payload) != size:
                            raise ValueError(f"payload cut off in {name} at {offset}")
                    if found != digest or _page(fields["warc-record-id"]) != page_id:
                        raise ValueError(f"record in {name} at {offset} is not the index's")
                    yield (page_id, url, kind, _page(fields.get("warc-refers-to")), size, found,
                           payload if payloads and kind == "response" else None)

        try:
            yield from in_batches(rows(), RECORD_ARROW)
        finally:
            if opened is not None:
                opened.close()

    return dealt.mapInArrow(read, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    folder = scratch(spark, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = f"""
WITH own AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
found AS (
  SELECT payload_digest, min(page_id) AS first_id FROM own
  WHERE payload_bytes >= {LEAST_SHARED} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM own LEFT JOIN found USING (payload_digest)
"""


@query("op5_warc", OP5_SQL)
def op5(spark, sf_dir):
    """Every page written to archives and read back."""
    return round_trip(spark, table(spark, sf_dir, "pages"))
