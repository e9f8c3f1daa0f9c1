"""WARC archives, compressed record by record with a shared Zstandard dictionary.

A file starts with a skippable frame that holds the dictionary; each record is
one Zstandard frame after it.  The dictionary is built from a bounded sample
of the records to archive.  Equal payloads are stored once: the row with the
largest page_id is the response, the others are revisit records that name it.
Tasks write files of their own under names that no other attempt uses; the
written manifest names the files that count, so an attempt that is lost or
run twice leaves files that nobody reads.
"""
from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid.llm.textbatch import slices
from citegrid.session import materialize, ship_package

#: Skippable frame that holds a dictionary.
MAGIC = 0x184D2A5D
#: Records that the dictionary is built from at most, and bytes read of them and kept in it.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1500, 16 << 20, 64 << 10
#: A file that has reached so many bytes is closed and the next begun.
FILE_BYTES = 64 << 20
LEVEL = 3


def header(record_type: str, page_id: int | None, url: str | None, digest: str, n_payload: int, length: int,
           refers_to: int | None = None) -> bytes:
    """WARC/1.1 header of a record; the date is fixed so that reruns agree."""
    name = "null" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{name}>",
             "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {_one_line(url)}",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n_payload}"]
    if record_type == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _one_line(url: str | None) -> str:
    return "" if url is None else "".join(c if c >= " " else "%%%02X" % ord(c) for c in url)


def record(record_type: str, page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    body = b"" if record_type == "revisit" else payload
    return header(record_type, page_id, url, digest, len(payload), len(body), refers_to) + body + b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_dictionary(pages: DataFrame) -> bytes:
    """Dictionary from a sample of the records, taken by hash of the payload
    over the whole table; empty where the records are too few to build one."""
    n = pages.count()
    if not n:
        return b""
    share = min(1.0, 2 * SAMPLE_RECORDS / n)
    got = (pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
           .where(F.pmod(F.xxhash64("html", "page_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
           .limit(SAMPLE_RECORDS).select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES // SAMPLE_RECORDS).alias("html")).collect())
    samples = [record("response", r.page_id, r.url, r.html.encode(), payload_digest(r.html.encode())) for r in got]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Archive:
    """Writer of one file."""

    def __init__(self, uri: str, dictionary: bytes):
        self.uri, self.records, self.bytes = uri, 0, 0
        fs, path = _filesystem(uri)
        self.out = fs.open_output_stream(path, compression=None)      # the name ends in .zst; frames are made here
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None,
            write_content_size=True, write_checksum=True)
        self._put(struct.pack("<II", MAGIC, len(dictionary)) + dictionary)

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.bytes += len(raw)

    def add(self, raw: bytes) -> None:
        self._put(self.compressor.compress(raw))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.uri, self.records, self.bytes


def read_records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of each record, streaming."""
    fs, path = _filesystem(uri)
    with fs.open_input_stream(path, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != MAGIC:
            raise ValueError(f"{uri}: no dictionary frame")
        dictionary = source.read(size)
        reader = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        ).stream_reader(source, read_across_frames=True)
        held = bytearray()

        def need(n: int) -> bool:
            while len(held) < n:
                more = reader.read(1 << 18)
                if not more:
                    return False
                held.extend(more)
            return True

        while need(1):
            end = held.find(b"\r\n\r\n")
            while end < 0:
                if not need(len(held) + 1):
                    raise ValueError(f"{uri}: cut short")
                end = held.find(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                          for line in held[:end].decode().split("\r\n")[1:])
            length = int(fields["Content-Length"])
            if not need(end + 4 + length + 4):
                raise ValueError(f"{uri}: cut short")
            body = bytes(held[end + 4:end + 4 + length])
            del held[:end + 4 + length + 4]
            yield fields, body


def _write(folder: str, dictionary, file_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, archive, done = TaskContext.get().partitionId(), None, []
        attempt = uuid.uuid4().hex[:12]
        for batch in batches:
            for rows in slices(batch, "html"):
                for page_id, url, html, top, shared in zip(*(rows.column(c).to_pylist() for c in ("page_id", "url", "html", "top", "shared"))):
                    payload = html.encode()
                    revisit = bool(shared) and top is not None and page_id != top
                    if archive is None:
                        archive = Archive(f"{folder}/{task:06d}-{attempt}-{len(done):04d}.warc.zst", dictionary.value)
                    archive.add(record("revisit" if revisit else "response", page_id, url, payload, payload_digest(payload), top if revisit else None))
                    if archive.bytes >= file_bytes:
                        done.append(archive.close())
                        archive = None
        if archive is not None:
            done.append(archive.close())
        yield pa.record_batch([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                               pa.array([d[2] for d in done], pa.int64())], ["uri", "records", "bytes"])
    return run


def write(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives all rows of ``pages`` (page_id, url, html); returns the manifest
    (uri, records, bytes), a written table.

    Null html is empty, null url empty.  Of equal payloads of at least
    ``least_bytes``, the row with the largest page_id is the response and the
    others revisit it; rows that repeat that page_id are responses too, and
    so is every row where all ids are null.  An empty table gives no files.
    """
    spark = pages.sparkSession
    ship_package(spark)
    dictionary = spark.sparkContext.broadcast(build_dictionary(pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sha = F.unhex(F.sha1(F.encode("html", "UTF-8")))
    # payloads seen more than once only: a narrow table, whose size Spark knows when it picks the join
    shared = materialize(
        rows.where(F.octet_length("html") >= least_bytes).groupBy(sha.alias("sha"))
        .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("sha", "top", F.lit(True).alias("shared")), "warc-shared")
    marked = rows.withColumn("sha", sha).join(shared, "sha", "left")
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    return materialize(marked.select("page_id", "url", "html", "top", "shared")
                       .mapInArrow(_write(folder, dictionary, file_bytes), "uri string, records long, bytes long"), "warc-manifest")


def _page(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "null" else int(text)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, expected in zip(batch.column("uri").to_pylist(), batch.column("records").to_pylist()):
            out, total = [], 0
            for fields, body in read_records(uri):
                total += 1
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and payload_digest(body) != digest:
                    raise ValueError(f"{uri}: payload and digest differ")
                refers = _page(fields["WARC-Refers-To"]) if kind == "revisit" else None
                n = len(body) if kind == "response" else int(fields["X-Payload-Length"])
                out.append((_page(fields["WARC-Record-ID"]), n, digest, kind, refers))
                if len(out) == 4096:
                    yield _batch(out)
                    out = []
            if total != expected:
                raise ValueError(f"{uri}: {total} records, written {expected}")
            if out:
                yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                           ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per record of the archives of the manifest: page_id, payload_bytes,
    payload_digest, record_type, refers_to; payloads are checked against their digests."""
    ship_package(spark)
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(tasks, "uri").mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
