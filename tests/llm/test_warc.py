"""Archives: round trips, ranges, damaged files and archives stored inside records."""

import gzip
import hashlib
import io
import random
import zlib

import pyarrow as pa
import pytest

from skylag.llm import warc
from skylag.llm.common import on_workers

LONG = "<p>" + "content " * 40
PAGES = [
    (5, "http://a.example/\r\nX: y", LONG, "x"), (2, "http://b.example/é ü", LONG, "y"), (9, None, LONG, "z"), (2, "http://b.example/", LONG, "y"),
    (None, "http://n.example/", LONG, "n"), (3, "http://c.example/", "short", "p"), (4, "http://d.example/", "short", "q"),
    (6, "", None, "r"), (7, "http://e.example/", "", "s"), (None, None, "alone " * 50, "t"), (8, "http://f.example/", "né日\x1f\x8b\x08" * 50_000, "u"),
]


@pytest.fixture(scope="module")
def pages(spark):
    on_workers(spark)
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, content string").repartition(3)


def test_pages_come_back(spark, pages, tmp_path):
    files = warc.write_archives(pages, str(tmp_path / "w"))
    want = sorted((i, (t or "").encode(), u is not None) for i, u, t, _ in PAGES if i is not None)
    whole = warc.archives(spark, str(tmp_path / "w"))
    assert sorted(r.size for r in whole.collect()) == sorted(r.size for r in files.collect())
    for size in (1 << 24, 1000, 37):
        records = warc.outermost(warc.read_archives(whole, range_bytes=size))
        rows = [r for r in warc.resolved(records).collect() if "null" not in r.record_id]
        got = sorted((int(r.record_id.split(":")[2]), bytes(r.content), r.uri is not None) for r in rows)
        assert got == want, size
        for r in rows:
            assert r.digest == "sha256:" + hashlib.sha256(bytes(r.content)).hexdigest() and r.content_bytes == len(r.content)
        kinds = sorted((r.record_id.split(":")[2], r.type) for r in records.collect() if r.type != "warcinfo" and r.digest.endswith(hashlib.sha256(LONG.encode()).hexdigest()))
        assert kinds == [("2", "response"), ("2", "response"), ("5", "revisit"), ("9", "revisit"), ("null", "revisit")]
        assert {r.refers_to for r in records.collect() if r.type == "revisit"} == {warc.record_id(2, hashlib.sha256(LONG.encode()).hexdigest())}
    uris = {r.uri for r in records.collect()}
    assert "http://a.example/%0D%0AX:%20y" in uris and "http://b.example/%C3%A9%20%C3%BC" in uris


def test_archives_are_gzip_that_others_read(pages, tmp_path):
    files = warc.write_archives(pages, str(tmp_path / "w"), file_bytes=500).collect()
    assert sum(f.records for f in files) == len(PAGES) and len(files) > 3
    for f in files:
        with gzip.open(f.path) as whole:
            assert whole.read().count(b"WARC/1.1\r\n") == f.records + 1


def _member(name: str, block: bytes, level: int = 6) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:{name}>\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def test_a_record_belongs_to_the_range_it_starts_in():
    noise = random.Random(1)
    members = [_member(str(i), noise.randbytes(noise.choice((0, 5, 700, 3000)))) for i in range(60)]
    data = b"\x1f\x8b\x08junk" + b"".join(members[:30]) + b"\x1f\x8b\x08\xff\x00" + b"".join(members[30:]) + _member("cut", b"x" * 500)[:-9]
    for size in (1, 2, 3, 64, 1000, len(data)):
        found = []
        for start in range(0, len(data), size):
            with pa.PythonFile(io.BytesIO(data), mode="r") as stream:
                found += [(o, n, f["warc-record-id"]) for o, n, f, _ in warc.records_of(stream, start, min(start + size, len(data)))]
        assert [name for _, _, name in found] == [f"<urn:{i}>" for i in range(60)]
        assert [data[o : o + n] for o, n, _ in found] == members


def test_an_archive_stored_in_a_record_is_no_record(spark, tmp_path):
    on_workers(spark)
    inner = b"".join(_member(f"in{i}", b"inner" * 50) for i in range(20))
    data = b"".join([_member("a", b"x"), _member("holder", inner, level=0), _member("b", b"y"), _member("c", b"z")])
    (tmp_path / "one.warc.gz").write_bytes(data)
    files = warc.archives(spark, str(tmp_path))
    for size in (50, 700, 1 << 20):
        records = warc.read_archives(files, range_bytes=size)
        assert [r.record_id for r in sorted(warc.outermost(records).collect(), key=lambda r: r.offset)] == ["<urn:a>", "<urn:holder>", "<urn:b>", "<urn:c>"]
    assert warc.read_archives(files, range_bytes=50).count() > 4


def test_empty_tables(spark, pages, tmp_path):
    files = warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert files.count() == 0 and warc.read_archives(files).count() == 0
