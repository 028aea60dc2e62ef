from __future__ import annotations

import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.errors import PythonException

from provwatch.llm import warc_archives as wa
from provwatch.sources.sinks import work_folder

LONG = "<p>copy</p>" * 30

PAGES = [
    (1, "http://a.example/x y%20\n?ü", "<html>" + "a" * 200, "k"),
    (2, None, None, "k"),
    (3, "http://b.example/", "", None),
    (9, "http://c.example/", LONG, None),
    (4, "http://c.example/4", LONG, None),
    (5, "http://c.example/5", LONG, None),
    (5, "http://c.example/5", LONG, None),
    (4, "http://c.example/4", LONG, None),
    (None, "http://c.example/n", LONG, None),
    (6, "u", "short", None),
    (7, "u", "short", None),
    (8, "u", "é\r\n\r\nWARC/1.1\r\n" * 40, None),
    (10, "u", "x" * 3_000_000, None),
    (None, "only", "y" * 100, None),
    (None, "only", "y" * 100, None),
    (11, "u", "z" * 99, None),
    (12, "u", "z" * 99, None),
    (13, "u", "é" * 50, None),
    (14, "u", "é" * 50, None),
]


@pytest.fixture
def pages(spark):
    rows = [(*r, 1, "c") for r in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, n int, archive string").repartition(3)


def test_round_trip_of_every_page(spark, pages):
    folder = work_folder(spark, "warc")
    written = wa.write_archives(pages, folder).collect()
    assert sum(r.n_records for r in written) == len(PAGES)
    got = wa.read_archives(spark, folder, payloads=True).collect()
    assert len(got) == len(PAGES)
    text = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    back = sorted(((r.page_id, r.url, text[r.payload_digest].decode()) for r in got), key=repr)
    assert back == sorted(((p, u, h or "") for p, u, h, _ in PAGES), key=repr)
    for r in got:
        assert hashlib.sha256(text[r.payload_digest]).hexdigest() == r.payload_digest
        assert r.payload_bytes == len(text[r.payload_digest])
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id is None or r.record_type == "revisit"), key=repr)
    assert kinds == sorted(
        [
            (5, "revisit", 4),
            (5, "revisit", 4),
            (9, "revisit", 4),
            (14, "revisit", 13),
            (None, "revisit", 4),
            (None, "response", None),
            (None, "response", None),
        ],
        key=repr,
    )


def test_shuffled_join_gives_the_same(spark, pages, rows, monkeypatch):
    plain = rows(wa.with_revisits(pages), "page_id", "payload_digest", "refers_to")
    monkeypatch.setattr("provwatch.llm.tables.BROADCAST_IDS", 0)
    assert rows(wa.with_revisits(pages), "page_id", "payload_digest", "refers_to") == plain


def test_records_are_frames_of_their_own(spark, pages):
    """The dictionary lies in a leading skippable frame, and one record can be read by its offset."""
    folder = work_folder(spark, "warc")
    wa.write_archives(pages, folder)
    for r in wa.read_archives(spark, folder, payloads=True).collect():
        with open(f"{folder.removeprefix('file:')}/archives/{r.archive}", "rb") as file:
            magic, size = struct.unpack("<II", file.read(8))
            assert magic == 0x184D2A5D
            dictionary = zstandard.ZstdDecompressor().decompress(file.read(size))
            file.seek(r.offset)
            tool = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(dictionary))
            headers, block = wa.parsed(tool.decompressobj().decompress(file.read()))
            assert headers["warc-type"].decode() == r.record_type
            assert int(headers["content-length"]) == len(block)
            if r.record_type == "response":
                assert block.endswith(bytes(r.payload))


def test_dictionary_helps_and_is_trained():
    records = [f"<html><head><title>{i}</title></head><body class='page'><p>{i * 7919}</p></body></html>".encode() * 2 for i in range(3000)]
    dictionary = wa.dictionary_of(records)
    assert dictionary[:4] == b"\x37\xa4\x30\xec"
    packed = zstandard.ZstdCompressor(6, zstandard.ZstdCompressionDict(dictionary))
    assert sum(len(packed.compress(r)) for r in records) * 2 < sum(len(zstandard.ZstdCompressor(6).compress(r)) for r in records)


def test_unlisted_files_are_not_read(spark, pages):
    """What an attempt that was never committed has left, whole or broken."""
    folder = work_folder(spark, "warc")
    wa.write_archives(pages, folder)
    with open(f"{folder.removeprefix('file:')}/archives/00000-99-00000.warc.zst", "wb") as file:
        file.write(b"torn")
    assert wa.read_archives(spark, folder).count() == len(PAGES)


def test_damage_ends_the_query(spark, pages):
    folder = work_folder(spark, "warc")
    name = wa.write_archives(pages, folder).first().archive
    path = f"{folder.removeprefix('file:')}/archives/{name}"
    with open(path, "rb") as file:
        content = file.read()
    with open(path, "wb") as file:
        file.write(content[:-5])
    with pytest.raises(PythonException):
        wa.read_archives(spark, folder).collect()


def test_archives_are_cut_by_size(monkeypatch):
    import pyarrow.fs

    class Kept(io.BytesIO):
        def close(self):
            pass

    class Files:
        made: dict = {}

        def open_output_stream(self, name, compression):
            assert compression is None
            self.made[name] = Kept()
            return self.made[name]

    files = Files()
    writer = wa.ArchiveWriter(files, "f", "2000-01-01T00:00:00Z", limit=1000)
    done = [d for i in range(10) for d in writer.add(b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 400\r\n\r\n" + b"%d" % i * 400 + b"\r\n\r\n")]
    done.append(writer.close()) if writer.records else None
    assert [d[1] for d in done] == [3, 3, 3, 1]
    assert sum(len(list(wa.read_records(io.BytesIO(f.getvalue())))) for f in files.made.values()) == 10 + len(done)


def test_nothing(spark):
    folder = work_folder(spark, "warc")
    wa.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert wa.read_archives(spark, folder).count() == 0
