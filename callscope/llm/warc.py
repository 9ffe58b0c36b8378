"""WARC archives, compressed record by record with a dictionary of their own.

A Zstandard dictionary is trained on a bounded sample of the payloads and stored in a skippable
frame at the head of every archive; after it comes one frame for each record, so that a record
can be read alone from its offset, and any archive can be read without outside files.

Records: of equal payloads of at least `MIN_REVISIT` bytes the one with the smallest page_id is
a `response`, the others are `revisit` records that name it; all smaller ones are responses.
Rows that share the smallest page_id and payload are all responses. A null page_id comes after
every other one; where all ids of a payload are null, all are responses.

Scale: payloads cross the network once, by digest, in a join that adaptive execution splits
where one digest is hot. A task writes archives of `ARCHIVE_BYTES` each, streaming. A task that
runs again writes new files under new names; only files named in the manifest, which the
finished tasks return, are part of the result. The folder must be one that all executors and
pyarrow reach, as `spark.checkpoint.dir` is.

Cases: a null payload is empty; a null url leaves the target header out; line ends and other
control characters in a url are percent-encoded; an empty table gives no archives and no rows;
repeated rows are records of their own; extra columns are ignored. A sample too small to
train on becomes the dictionary as it is, an empty one gives archives without a dictionary.
"""

import hashlib
import io
import os
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import materialise, read_table, shuffle_partitions
from callscope.llm.registry import register
from callscope.session import scratch_dir

MIN_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
#: The dictionary's size, and what it is trained on at most: payloads, and bytes of each.
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 1500
SAMPLE_PAYLOAD = 32 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

#: Fixed values of the formats: magic numbers of a skippable frame and of a data frame.
SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528

MANIFEST = "path string, records long, bytes long"
READ_BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Plain paths and `file:` in all their spellings are local; the rest is pyarrow's to open."""
    local = re.sub(r"^file:/*", "/", path)
    if "://" not in local:
        return pafs.LocalFileSystem(), local
    return pafs.FileSystem.from_uri(path)


def train_dictionary(payloads: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Trained on `payloads`; too few of them are the dictionary themselves, none gives none."""
    payloads = [p for p in payloads if p]
    try:
        return zstandard.train_dictionary(size, payloads).as_bytes() if len(payloads) > 7 else b"".join(payloads)[:size]
    except zstandard.ZstdError:
        return b"".join(payloads)[:size]


def dictionary_of(pages: DataFrame) -> bytes:
    """Of the distinct payloads with the smallest hashes, trained in one task on a bounded sample.

    The hashes alone are ordered; payloads are read for those that are in the sample.
    """
    usable = pages.select("payload", F.xxhash64("payload").alias("h")).filter(F.length("payload").between(1, SAMPLE_PAYLOAD))
    last = usable.select("h").distinct().orderBy("h").limit(SAMPLE_RECORDS).agg(F.max("h").alias("h")).first().h
    if last is None:
        return b""
    sample = usable.filter(F.col("h") <= last).groupBy("h").agg(F.min("payload").alias("payload")).select("payload")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted(p for b in batches for p in b.column(0).to_pylist())
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([train_dictionary(held)], pa.binary())})

    row = sample.coalesce(1).mapInArrow(train, "dictionary binary").first()
    return bytes(row.dictionary) if row else b""


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record; `refers_to` makes it a revisit without a body."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """One archive: the dictionary's frame, then a frame for each record."""

    def __init__(self, sink, dictionary: bytes):
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=True)
        self._sink, self.bytes, self.records = sink, 0, 0
        self._put(struct.pack("<II", SKIPPABLE, len(packed)) + packed)

    def _put(self, data: bytes) -> None:
        self._sink.write(data)
        self.bytes += len(data)

    def add(self, text: bytes) -> None:
        self._put(self._compressor.compress(text))
        self.records += 1


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open archive, one record in memory at a time."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the head of the archive")
    packed = source.read(size)
    dictionary = zstandard.ZstdDecompressor().decompress(packed) if packed else b""
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=held)
    with decompressor.stream_reader(source, read_across_frames=True, closefd=False) as stream:
        lines = io.BufferedReader(stream, 1 << 16)
        while version := lines.readline():
            if version != b"WARC/1.1\r\n":
                raise ValueError(f"not a WARC record: {version[:40]!r}")
            headers = {}
            while (line := lines.readline()) != b"\r\n":
                name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
                headers[name] = value.strip()
            block = lines.read(int(headers["Content-Length"]))
            if lines.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield headers, block


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of `pages` (page_id, url, html) below `folder`; their manifest, one row each."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    dictionary = spark.sparkContext.broadcast(dictionary_of(rows))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.length("payload") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    linked = rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")), F.col("first_id")).alias("refers_to"),
    )
    system, root = _filesystem(folder)
    system.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        done, sink, out = [], None, None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.zst"
                    sink = system.open_output_stream(path)
                    out = ArchiveWriter(sink, dictionary.value)
                out.add(record(*(x.as_py() for x in row)))
                if out.bytes >= archive_bytes:
                    sink.close()
                    done.append((path, out.records, out.bytes))
                    out = None
        if out is not None:
            sink.close()
            done.append((path, out.records, out.bytes))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return materialise(linked.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """One row for each record of the archives: what a reader finds, payload digests checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = []
                with system.open_input_stream(path) as source:
                    for headers, block in read_records(source):
                        found.append(_read_back(headers, block))
                        if len(found) == 5000:
                            yield _rows(found)
                            found = []
                yield _rows(found)

    each = manifest.select("path").repartition(shuffle_partitions(spark), "path")
    return each.mapInArrow(read, READ_BACK)


def _read_back(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is not what was written")
    page, to = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id")
    return page and int(page), size, digest, kind, to and int(to)


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], list(names))


def target_uri(headers: dict[str, str]) -> str | None:
    """The url as it was, control characters decoded."""
    uri = headers.get("WARC-Target-URI")
    return uri if uri is None else unquote_to_bytes(uri).decode("utf-8", "surrogatepass")


_SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM f"""


@register("op10_warc_dictionary", _SQL)
def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    folder = os.path.join(scratch_dir(spark, "warc"))
    return read_archives(spark, write_archives(pages, folder), folder)
