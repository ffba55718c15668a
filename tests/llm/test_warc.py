import base64
import hashlib
import io

import pytest
import zstandard
from helpers import plain
from hypothesis import given, settings
from hypothesis import strategies as st

from aferir.llm import queries, warc

SCHEMA = "page_id long, url string, html string, hex string, first long, value string"


def records(n=50, size=400):
    payloads = [f"<p>{i}</p>".encode() * size for i in range(n)]
    return [warc.page_record(str(i), f"http://h/{i}", p, warc.digest(p), None) for i, p in enumerate(payloads)]


def round_trip(spark, pages, tmp_path, least=0):
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder, least)
    return folder, warc.read_archives(warc.archive_files(spark, folder))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=30), st.integers(1, 4000))
def test_archives_hold_their_records(payloads, limit):
    before = warc.ARCHIVE_BYTES, warc.SAMPLE_BYTES
    warc.ARCHIVE_BYTES, warc.SAMPLE_BYTES = limit, limit // 2
    try:
        made = [warc.page_record(str(i), "u", p, warc.digest(p), None) for i, p in enumerate(payloads)]
        found = [data for archive in warc.archives(made) for _, data in warc.frames(archive + warc.EMPTY_FRAME.encode())]
        assert found == made
        assert [warc.checked(*warc.parse_record(data)) for data in found] == payloads
    finally:
        warc.ARCHIVE_BYTES, warc.SAMPLE_BYTES = before


def test_dictionary_leads_and_every_reader_can_read():
    (archive,) = warc.archives(records())
    magic, body = warc.skippable(memoryview(archive), 0)
    assert magic == warc.DICTIONARY_MAGIC
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(bytes(body), max_output_size=1 << 20))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(archive[8 + len(body) :]), read_across_frames=True)
    assert reader.read() == b"".join(records())
    # A dictionary that is not compressed is as good.
    plain_dictionary = dictionary.as_bytes()
    again = warc.struct.pack("<II", warc.DICTIONARY_MAGIC, len(plain_dictionary)) + plain_dictionary + archive[8 + len(body) :]
    assert [data for _, data in warc.frames(again)] == records()
    with pytest.raises((warc.BadRecord, zstandard.ZstdError)):
        list(warc.frames(archive[8 + len(body) :]))


def test_dictionary_saves_space():
    made = [warc.page_record(str(i), f"http://host/{i}", b"<html><head><title>News of the day</title></head><p>%d" % i, "X", None) for i in range(500)]
    (with_one,) = warc.archives(made)
    without = sum(len(zstandard.ZstdCompressor(write_checksum=True).compress(r)) for r in made)
    assert len(with_one) < without / 2


@pytest.mark.parametrize(
    "change, reason",
    [
        (lambda r: r.replace(b"WARC/1.1", b"WORC/1.1"), "version"),
        (lambda r: r.replace(b"WARC-Date: ", b"X-Date: "), "no WARC-Date"),
        (lambda r: r.replace(b"Content-Type: app", b"Content-Type app", 1), "without a name"),
        (lambda r: r.replace(b"WARC-Date: ", b"WARC-Type: x\r\nWARC-Date: "), "twice"),
        (lambda r: r[:-4], "Content-Length"),
        (lambda r: r[:-5] + b"\r\n\r\n", "Content-Length"),
        (lambda r: r + b"more", "Content-Length"),
        (lambda r: r.replace(b"page text", b"page tent"), "digest"),
        (lambda r: b"", "version"),
    ],
)
def test_bad_records_are_told(spark, change, reason):
    payload = b"page text" * 20
    good = warc.page_record("1", "http://h/", payload, warc.digest(payload), None)
    bad = zstandard.ZstdCompressor().compress(change(good))
    content = bad + zstandard.ZstdCompressor().compress(good)
    files = spark.createDataFrame([("a", bytearray(content))], "path string, content binary")
    first, second = warc.read_archives(files).orderBy("offset").collect()
    assert reason in first.problem and second.problem is None and bytes(second.payload) == payload


def test_cut_off_archives_are_told(spark):
    (archive,) = warc.archives(records(20))
    files = spark.createDataFrame([("a", bytearray(archive[:-9])), ("b", bytearray(archive[:100])), ("c", bytearray())], "path string, content binary")
    found = warc.read_archives(files, payloads=False)
    assert found.where("problem is null").count() == 19
    assert {r.path for r in found.where("problem like '%cut off'").collect()} == {"a", "b"}


def test_odd_rows(spark, tmp_path):
    rows = [
        (3, "http://a/1", "same", "h", 9, "v"), (1, None, "same", "h", 9, "v"), (None, "http://a\r\nX: y", "same", None, 9, "v"),
        (7, "u", None, "h", 9, "v"), (8, "u", "", "h", 9, "v"), (9, "u", "alone\x00é" * 40000, "h", 9, "v"),
        (5, "u", "twice", "h", 9, "v"), (5, "u", "twice", "h", 9, "v"), (None, "u", "nobody", "h", 9, "v"), (None, "u", "nobody", "h", 9, "v"),
    ]
    pages = spark.createDataFrame(rows, SCHEMA)
    folder, found = round_trip(spark, pages, tmp_path)
    report = plain(warc.page_report(found).select("page_id", "payload_bytes", "record_type", "refers_to"))
    assert report == sorted(
        [
            (3, 4, "revisit", 1), (1, 4, "response", None), (None, 4, "revisit", 1), (7, 0, "response", None), (8, 0, "revisit", 7),
            (9, 320000, "response", None), (5, 5, "response", None), (5, 5, "response", None),
            (None, 6, "response", None), (None, 6, "response", None),
        ], key=repr,
    )
    texts = {bytes(r.payload).decode() for r in found.where("warc_type = 'response'").collect()}
    assert texts == {"same", "", "alone\x00é" * 40000, "twice", "nobody"}
    assert found.where("target like '%\n%'").count() == 0 and found.where("problem is not null").count() == 0


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * (3 + i % 2), "", 0, "") for i in range(6)], SCHEMA)
    _, found = round_trip(spark, pages, tmp_path, least=4)
    report = warc.page_report(found)
    assert report.where("record_type = 'response'").count() == 4 and report.where("refers_to = 1").count() == 2


def test_empty_table(spark, tmp_path):
    _, found = round_trip(spark, spark.createDataFrame([], SCHEMA), tmp_path)
    assert warc.page_report(found).collect() == []


def test_lost_response_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x", "", 0, ""), (2, "u", "x", "", 0, "")], SCHEMA)
    _, found = round_trip(spark, pages, tmp_path)
    with pytest.raises(Exception, match="no response for revisit"):
        warc.page_report(found.where("warc_type = 'revisit'")).collect()


def test_query_against_hashlib(spark):
    folder = "/root/testdata/sf0.001"
    found = {r.page_id: r for r in queries.QUERIES["op12_warc_zstd"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    first = {}
    for page in pages:
        first[page.html] = min(page.page_id, first.get(page.html, page.page_id))
    assert len(found) == len(pages)
    for page in pages:
        data, row = page.html.encode(), found[page.page_id]
        sha1 = base64.b32encode(hashlib.sha1(data).digest()).decode()
        refers = None if first[page.html] == page.page_id else first[page.html]
        assert tuple(row) == (page.page_id, len(data), sha1, "response" if refers is None else "revisit", refers)
