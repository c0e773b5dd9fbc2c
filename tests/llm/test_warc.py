"""Archives: round trips, revisits, and what a broken archive does."""

import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hazardmarts.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string"
BIG, SMALL = "é" * 700, "small"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


ROWS = [
    (1, "http://a/", BIG), (2, "http://b/ü x\r\nWARC-Type: fake", BIG), (9, None, BIG), (3, "http://c/", SMALL), (4, "http://d/", SMALL),
    (5, "http://e/", None), (6, "", ""), (None, "http://f/", BIG), (7, "http://g/", "x" * 3_000_000), (8, "http://h/", "WARC/1.0\r\n\r\n"),
    (10, "u", "y" * 2000), (10, "u", "y" * 2000), (None, "n", "z" * 2000), (None, "n", "z" * 2000),
]


def wanted(rows):
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        refers = max(same) if len(data) >= 1000 and same and page != max(same) else None
        out.append((page, url, "response" if refers is None else "revisit", refers, len(data), hashlib.sha1(data).hexdigest(),
                    data if refers is None else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("roll", [1, 1 << 20])
def test_round_trip(spark, tmp_path, roll):
    manifest = warc.write_archives(pages(spark, ROWS), f"file://{tmp_path}/out", roll_bytes=roll)
    assert sum(r.records for r in manifest.collect()) == len(ROWS)
    got = sorted(((*r[:6], bytes(r[6]) if r[6] is not None else None) for r in warc.read_archives(manifest).collect()), key=str)
    assert got == wanted(ROWS)


def test_files_are_plain_gzip_members(spark, tmp_path):
    manifest = warc.write_archives(pages(spark, ROWS).coalesce(1), f"file://{tmp_path}/out").collect()
    for row in manifest:
        data, members = open(row.path.removeprefix("file://"), "rb").read(), 0
        text = gzip.decompress(data)
        while data:
            unpack = zlib.decompressobj(31)
            assert unpack.decompress(data).startswith(b"WARC/1.0\r\n")
            data, members = unpack.unused_data, members + 1
        assert members == row.records and text.count(b"WARC-Record-ID: ") == row.records


def test_small_pieces_read_the_same(spark, tmp_path):
    manifest = warc.write_archives(pages(spark, ROWS), f"file://{tmp_path}/out").collect()
    for row in manifest:
        assert list(warc.read_archive(row.path, piece=7 if row.bytes < 5000 else 1000)) == list(warc.read_archive(row.path))


@pytest.mark.parametrize("spoil", [lambda d: d.replace(b"payload-data", b"payload-dada"), lambda d: d.replace(b"WARC/1.0", b"WARC/9.9"),
                                   lambda d: d.replace(b"Content-Length: 9", b"Content-Length: 8", 1), lambda d: d[:-2]])
def test_broken_records_raise(spoil):
    data = b"payload-data"
    record = warc.build_record(1, "http://a/", data, hashlib.sha1(data).hexdigest(), None)
    assert warc.read_record(iter([record]))[-1] == data
    assert spoil(record) != record
    with pytest.raises(warc.BrokenArchive):
        warc.read_record(iter([spoil(record)]))


def test_cut_archive_raises(spark, tmp_path):
    path = tmp_path / "cut.warc.gz"
    data = b"x" * 100
    path.write_bytes(warc._member(warc.build_record(1, "u", data, hashlib.sha1(data).hexdigest(), None))[:-5])
    with pytest.raises(warc.BrokenArchive):
        list(warc.read_archive(f"file://{path}"))


def test_empty(spark, tmp_path):
    manifest = warc.write_archives(pages(spark, []), f"file://{tmp_path}/none")
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def test_archives_are_read_by_as_many_tasks(spark, tmp_path):
    many = [(i, f"http://h/{i}", f"{i} " * 900) for i in range(40)]
    manifest = warc.write_archives(pages(spark, many).repartition(8), str(tmp_path / "out"), roll_bytes=1)
    archives = manifest.count()
    assert archives == 40 and manifest.first().path.startswith("file:///")
    tasks = warc.read_archives(manifest, with_payload=False).select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks >= 32
    assert warc.read_archives(manifest.limit(0)).count() == 0


def test_a_store_that_arrow_cannot_open_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)viewfs"):
        warc.located(spark, "viewfs://none/out")
