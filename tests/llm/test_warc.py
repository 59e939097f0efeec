import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from termloom.llm import queries, warc

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, error string"


def test_odd_pages(spark, tables):
    rows = [
        (1, "http://a/", "same", "x"), (2, None, "same", "x"), (3, "http://a/ b\r\nc", None, None),
        (4, "é", "", None), (5, "u", "é" * 300_000, None), (None, "u", "same", None), (None, "u", "alone", None),
        (2, "again", "same", None),
    ]
    out = queries.op1_warc(spark, tables(pages=spark.createDataFrame(rows, PAGES)))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[1][3:] == ("revisit", 2) and by_id[1][1] == 4
    assert by_id[2][3:] == ("response", None)
    assert by_id[3] == (3, 0, warc.base32_sha1(b""), "revisit", 4)
    assert by_id[4][3] == "response" and by_id[5][1] == 600_000
    assert sorted(r[3:] for r in got if r[0] is None) == [("response", None), ("revisit", 2)]


def test_empty_table(spark, tables):
    assert queries.op1_warc(spark, tables(pages=spark.createDataFrame([], PAGES))).count() == 0


def test_min_bytes(spark):
    pages = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "abcd"), (4, "abcd")], "k bigint, html string")
    marked = {r["k"]: r["refers_to"] for r in warc.mark_revisits(pages, "k", "html", min_bytes=3).collect()}
    assert marked == {1: None, 2: None, 3: 4, 4: None}


def test_layout_is_readable_by_any_decoder(spark, tmp_path):
    rows = [(f"urn:x:{i}", "http://a/", None, bytearray(b"<p>page %d</p>" % i * 40)) for i in range(200)]
    records = spark.createDataFrame(rows, "record_id string, uri string, refers_to_id string, payload binary")
    warc.write_archives(records.coalesce(1), str(tmp_path / "w"))
    (file,) = [p for p in (tmp_path / "w").iterdir() if p.name.startswith("part")]
    raw = file.read_bytes()
    magic, size = struct.unpack_from("<II", raw)
    assert magic == warc.DICTIONARY_MAGIC
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
    whole = decoder.stream_reader(raw, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 200


@pytest.fixture
def archive(tmp_path):
    def write(*frames, dictionary=None, packed=False):
        front = b""
        if dictionary:
            kept = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
            front = struct.pack("<II", warc.DICTIONARY_MAGIC, len(kept)) + kept
        (tmp_path / "a.warc.zst").write_bytes(front + b"".join(frames))
        return str(tmp_path / "a.warc.zst")

    return write


def _frame(record, dictionary=None):
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(**options).compress(record)


GOOD = warc._record("response", "urn:x:1", "http://a/", None, b"body")


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_plain_or_packed(spark, archive, packed):
    words = b"some words of a dictionary, WARC-Type: response " * 30
    path = archive(_frame(GOOD, words), dictionary=words, packed=packed)
    (row,) = warc.read_archives(spark, path).collect()
    assert row["error"] is None and bytes(row["payload"]) == b"body"


@pytest.mark.parametrize(
    ("record", "error"),
    [
        (GOOD.replace(b"WARC/1.1", b"WARC/9.9"), "no WARC header"),
        (GOOD.replace(b"WARC-Date: 1970-01-01T00:00:00Z\r\n", b""), "no warc-date"),
        (GOOD.replace(b"WARC-Type: ", b"WARC Type  "), "bad header line"),
        (GOOD + b"x", "wrong length"),
        (GOOD.replace(b"body", b"b0dy"), "wrong block digest"),
    ],
)
def test_faults(spark, archive, record, error):
    (row,) = warc.read_archives(spark, archive(_frame(record))).collect()
    assert row["error"] == error


def test_a_broken_frame_keeps_what_came_before(spark, archive):
    path = archive(_frame(GOOD), _frame(GOOD)[:-3])
    assert [r["error"] for r in warc.read_archives(spark, path).collect()] == [None, "cut off"]
    path = archive(_frame(GOOD), b"rubbish that is no frame")
    assert [r["error"] for r in warc.read_archives(spark, path).collect()] == [None, "no frame"]


def test_payloads_come_back_whole(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    from termloom.session import scratch_path

    path = scratch_path(spark, "archives")
    records = pages.select(
        F.col("page_id").cast("string").alias("record_id"), F.col("url").alias("uri"),
        F.lit(None).cast("string").alias("refers_to_id"), F.encode("html", "UTF-8").alias("payload"),
    )
    warc.write_archives(records, path)
    back = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, path).collect()}
    assert back == {str(r["page_id"]): r["html"] for r in pages.collect()}
