"""Dictionary-compressed WARC archives of pages.

A page becomes one record, its payload the html in UTF-8. Of records with equal payloads of ``least`` bytes or more,
the one with the smallest page_id is a response and the others are revisits that name it; all others are responses.
Pages are told apart by the SHA-256 of the payload.

Each task writes its pages to archives of ``ARCHIVE`` bytes of records. An archive starts with a skippable frame that
holds a Zstandard dictionary, built from records spread evenly over that archive (``SAMPLE`` bytes at most; it only
affects the size). Every record then is a frame of its own, compressed with the dictionary, so that one can be read
by its offset. The first record describes the archive.

Archives are files in a folder that all executors share. Every attempt of a task writes files of its own and returns
their names, and only the names that Spark commits with the list of archives are read back: what a lost executor or a
second attempt has left is never read.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.llm.tables import saved, sent_if_small
from provwatch.sources.sinks import work_folder

ARCHIVE = 32 << 20
SAMPLE = 4 << 20
DICTIONARY = 64 << 10
LEVEL = 6

# Fixed values of the formats: the dictionary's skippable frame, Zstandard's frame, the profile of a revisit.
_SKIPPABLE = 0x184D2A5D
_FRAME = b"\x28\xb5\x2f\xfd"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = b"WARC/1.1\r\n"

_PORTION = 1 << 18
_CONTROL = re.compile(rb"[\x00-\x20\x7f%]")


def _header_value(text: str) -> bytes:
    """UTF-8 with blanks, control characters and per cent signs escaped, so that a value is one line and can be undone."""
    return _CONTROL.sub(lambda m: b"%%%02X" % m[0][0], text.encode())


def _header_text(value: bytes) -> str:
    return re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), value).decode()


def record_id(page_id: int | None, digest: str) -> str:
    """The same page always has the same record id."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest}'.encode()).digest()[:16], version=5)}>"


def record(kind: str, headers: list[tuple[str, bytes]], block: bytes) -> bytes:
    lines = [(b"WARC-Type", kind.encode()), *((k.encode(), v) for k, v in headers), (b"Content-Length", b"%d" % len(block))]
    return b"".join([_VERSION, *(k + b": " + v + b"\r\n" for k, v in lines), b"\r\n", block, b"\r\n\r\n"])


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response with the whole payload or, with ``refers_to``, a revisit that keeps only the HTTP header."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [("WARC-Record-ID", record_id(page_id, digest).encode()), ("WARC-Date", date.encode())]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_value(url)))
    if page_id is not None:
        headers.append(("X-Page-ID", b"%d" % page_id))
    headers += [("WARC-Payload-Digest", b"sha256:" + digest.encode()), ("Content-Type", b"application/http; msgtype=response")]
    if refers_to is None:
        return record("response", headers, http + payload)
    headers += [
        ("WARC-Refers-To", record_id(refers_to, digest).encode()),
        ("X-Refers-To-Page-ID", b"%d" % refers_to),
        ("WARC-Profile", _PROFILE.encode()),
    ]
    return record("revisit", headers, http)


def dictionary_of(records: list[bytes], sample: int = SAMPLE, size: int = DICTIONARY) -> bytes:
    """A dictionary from parts of records spread over the archive; of too few records, their bytes as they are."""
    each = max(256, sample // max(1, len(records)))
    step = max(1, len(records) * each // sample)
    parts = [r[:each] for r in records[::step]]
    try:
        return zstandard.train_dictionary(size, parts, d=8, k=256, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:]


class ArchiveWriter:
    """Buffers records up to ``limit`` bytes and writes each lot as an archive of its own."""

    def __init__(self, file_system: pyarrow.fs.FileSystem, path: str, date: str, limit: int = ARCHIVE):
        self.files, self.path, self.date, self.limit = file_system, path, date, limit
        self.records: list[bytes] = []
        self.bytes = self.written = 0

    def add(self, one: bytes) -> Iterator[tuple[str, int, int]]:
        self.records.append(one)
        self.bytes += len(one)
        if self.bytes >= self.limit:
            yield self.close()

    def close(self) -> tuple[str, int, int]:
        """Write what is buffered: file name, records, bytes of the file."""
        name = f"{self.path}-{self.written:05d}.warc.zst"
        about = record(
            "warcinfo",
            [("WARC-Record-ID", record_id(None, name).encode()), ("WARC-Date", self.date.encode())]
            + [("Content-Type", b"application/warc-fields")],
            b"format: WARC File Format 1.1\r\n",
        )
        dictionary = dictionary_of(self.records)
        tool = zstandard.ZstdCompressor(LEVEL, zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        packed = zstandard.ZstdCompressor(LEVEL).compress(dictionary)
        with self.files.open_output_stream(name, compression=None) as out:
            out.write(struct.pack("<II", _SKIPPABLE, len(packed)) + packed)
            for one in (about, *self.records):
                out.write(tool.compress(one))
            size = out.tell()
        done = name.rsplit("/", 1)[-1], len(self.records), size
        self.records, self.bytes, self.written = [], 0, self.written + 1
        return done


def read_records(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of each record of an archive, which is read in portions."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != _SKIPPABLE:
        raise ValueError("not an archive with a leading dictionary")
    dictionary = zstandard.ZstdDecompressor().decompress(stream.read(size))
    tool = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(dictionary))
    offset, rest = 8 + size, stream.read(_PORTION)
    while rest:
        frame, out, used = tool.decompressobj(), io.BytesIO(), 0
        while not frame.eof:
            if not rest and not (rest := stream.read(_PORTION)):
                raise ValueError("the archive ends inside a record")
            out.write(frame.decompress(rest))
            used += len(rest) - len(frame.unused_data)
            rest = frame.unused_data
        yield offset, out.getvalue()
        offset += used
        rest = rest or stream.read(_PORTION)


def parsed(one: bytes) -> tuple[dict[str, bytes], bytes]:
    """Headers by lower-case name, and the block."""
    if not one.startswith(_VERSION):
        raise ValueError("not a WARC record")
    head, rest = one[len(_VERSION) :].split(b"\r\n\r\n", 1)
    pairs = (line.split(b": ", 1) for line in head.split(b"\r\n"))
    headers = {k.decode().lower(): v for k, v in pairs}
    return headers, rest[: int(headers["content-length"])]


_PAGE = [
    ("page_id", pa.int64(), "long"),
    ("url", pa.string(), "string"),
    ("payload_bytes", pa.int64(), "long"),
    ("payload_digest", pa.string(), "string"),
    ("record_type", pa.string(), "string"),
    ("refers_to", pa.int64(), "long"),
    ("archive", pa.string(), "string"),
    ("offset", pa.int64(), "long"),
    ("payload", pa.binary(), "binary"),
]
_LISTED = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("n_records", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
    ]
)


def _page_row(one: bytes, archive: str, offset: int, payloads: bool) -> tuple | None:
    headers, block = parsed(one)
    kind = headers["warc-type"].decode()
    if kind not in ("response", "revisit"):
        return None
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = headers["warc-payload-digest"].decode().removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload at {offset} of {archive} differs from its digest")
    page, url, refers = (headers.get(k) for k in ("x-page-id", "warc-target-uri", "x-refers-to-page-id"))
    return (
        None if page is None else int(page),
        None if url is None else _header_text(url),
        size,
        digest,
        kind,
        None if refers is None else int(refers),
        archive,
        offset,
        payload if payloads and kind == "response" else None,
    )


def with_revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """Rows with payload (html, empty for null), payload_digest and refers_to (null for responses).

    Only digests that occur more than once take part in the join, and they are sent to all tasks while there are few:
    then no page is shuffled. The smallest page_id counts without nulls; rows that repeat it are responses, too, and so
    is a group without any page_id.
    """
    folder = work_folder(pages.sparkSession, "revisits")
    payload = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    long_enough = pages.where(F.octet_length("payload") >= least)
    groups = long_enough.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    groups = groups.where("n > 1 and first_id is not null").select(F.unhex("payload_digest").alias("digest"), "first_id")
    groups = sent_if_small(saved(groups, f"{folder}/groups"))
    joined = pages.join(groups, F.unhex("payload_digest") == F.col("digest"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = 100, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write every row of ``pages`` (page_id long, url, html) as a record and return the archives: archive, n_records, n_bytes.

    ``folder`` is a URI of a new folder that all executors reach. A null html counts as empty, a null url or page_id
    leaves out its header, repeated rows are each a record, further columns are ignored. ``date`` is given to all
    records, as the table has none. A page of any length is held once; a longer one than ``ARCHIVE`` ends its archive.
    """
    spark = pages.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pyarrow.fs.FileSystem.from_uri(f"{folder}/archives")
        files.create_dir(path, recursive=True)
        task = TaskContext.get()
        writer = ArchiveWriter(files, f"{path}/{task.partitionId():05d}-{task.taskAttemptId()}", date)
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, refers = (c[i].as_py() for c in batch.columns)
                done += writer.add(page_record(page, url, payload, digest, refers, date))
        if writer.records:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else ([],) * 3, (pa.string(), pa.int64(), pa.int64()), strict=True)],
            names=_LISTED.names,
        )

    rows = with_revisits(pages, least)
    rows = rows.withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers_to", F.col("refers_to").cast("long"))
    rows = rows.withColumn("payload", F.col("payload").cast("binary"))
    rows.mapInArrow(run, _LISTED).write.mode("errorifexists").parquet(f"{folder}/list")
    return listed_archives(spark, folder)


def listed_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The archives that were written to their end."""
    return spark.read.schema(_LISTED).parquet(f"{folder}/list")


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of the listed archives of ``folder``, one task for each few archives.

    page_id, url, payload_bytes and payload_digest (both of the full payload, also for a revisit), record_type,
    refers_to, archive, offset, and with ``payloads`` the payload of responses. The payload of each response is
    compared with its digest; a damaged archive ends the query.
    """
    fields = _PAGE if payloads else _PAGE[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = pyarrow.fs.FileSystem.from_uri(f"{folder}/archives")
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{path}/{archive}", compression=None) as stream:
                    for offset, one in read_records(stream):
                        if row := _page_row(one, archive, offset, payloads):
                            rows.append(row)
                            held += len(row[-1] or b"") if payloads else 0
                        if len(rows) >= 4096 or held > 4 << 20:
                            yield _page_batch(rows, fields)
                            rows, held = [], 0
                if rows:
                    yield _page_batch(rows, fields)

    archives = listed_archives(spark, folder)
    spread = archives.select("archive").repartition(spark.sparkContext.defaultParallelism * 2, "archive")
    return spread.mapInArrow(run, ", ".join(f"{name} {kind}" for name, _, kind in fields))


def _page_batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, (_, kind, _) in enumerate(fields)], names=[f[0] for f in fields]
    )
