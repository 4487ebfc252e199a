"""ARC and WARC archives: exact round trips."""

import gzip
import hashlib
import zlib
from collections import defaultdict

import pytest
from llm_helpers import pages
from pyspark.sql import functions as F

from placeframe.llm import warc
from placeframe.session import fresh_dir


def expected(rows):
    first = defaultdict(lambda: None)
    for page, html in rows:
        if page is not None and (first[html] is None or page > first[html]):
            first[html] = page
    out = []
    for page, html in rows:
        raw = html.encode()
        revisit = len(raw) >= 1000 and page != first[html]
        out.append((str(page), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    df = pages(spark)
    got = warc.convert_pages(df, version).collect()
    want = expected([(r.page_id, r.html or "") for r in df.select("page_id", "html").collect()])
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want
    assert warc.convert_pages(df.limit(0), version).collect() == []


def test_a_join_when_many_payloads_repeat(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    df = spark.range(60).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat((F.col("id") % 7).cast("string"), 1000 + F.col("id").cast("int") % 7).alias("html"))
    got = warc.convert_pages(df).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected([(r.page_id, r.html) for r in df.collect()])


def test_written_archives(spark):
    df = pages(spark)
    arc, out = fresh_dir(spark, "t-arc"), fresh_dir(spark, "t-warc")
    warc.convert(spark, warc.write_arc(df, arc), out)
    records = [r for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out).collect() for r in warc.read_warc(gzip.decompress(f.content))]
    pages_in = [h for h, _ in records if h["warc-type"] != "warcinfo"]
    assert len(pages_in) == df.count()
    ids = {h["warc-record-id"] for h in pages_in if h["warc-type"] == "response"}
    for head in pages_in:
        assert head["warc-date"] == "2024-01-01T00:00:00Z" and " " not in head["warc-target-uri"]
        if head["warc-type"] == "revisit":
            assert head["warc-refers-to"] in ids and head["content-length"] == "0"


def members(raw):
    """(offset in the file, content) of each gzip member."""
    at, out = 0, []
    while at < len(raw):
        d = zlib.decompressobj(31)
        out.append((at, d.decompress(raw[at:]) + d.flush()))
        assert d.eof
        at = len(raw) - len(d.unused_data)
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_ids_are_unique_and_records_stand_alone(spark, version, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    df = pages(spark).union(pages(spark)).repartition(3)  # every page at least twice
    arc, out = fresh_dir(spark, "u-arc"), fresh_dir(spark, "u-warc")
    warc.convert(spark, warc.write_arc(df, arc, version), out)
    files = lambda path: [bytes(f.content) for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    heads = []
    for raw in files(out):
        *own, last = members(raw)
        assert last[1] == b""
        for at, content in own:  # each member is one whole record
            ((head, _),) = warc.read_warc(zlib.decompressobj(31).decompress(raw[at:]))
            assert content.endswith(warc.WARC_END)
            heads.append(head)
    ids = [h["warc-record-id"] for h in heads]
    assert len(set(ids)) == len(ids) and sum(h["warc-type"] == "warcinfo" for h in heads) == len(files(out)) > 2
    responses = {h["warc-record-id"] for h in heads if h["warc-type"] == "response"}
    assert {h["warc-refers-to"] for h in heads if h["warc-type"] == "revisit"} <= responses
    assert all(("x-arc-offset" in h) == (version == 2) for h in heads if h["warc-type"] != "warcinfo")
    assert out and sorted(ids) == sorted(h["warc-record-id"] for raw in files(warc.convert(spark, arc, fresh_dir(spark, "u-again"))) for h, _ in warc.read_warc(gzip.decompress(raw)))
    if version == 2:
        for raw in files(arc):
            whole = gzip.decompress(raw)
            for r in warc.read_arc(whole):
                code, checksum, location, offset, name = r.more
                assert (code, location, name) == ("200", "-", warc.ARC_NAME) and checksum == hashlib.md5(r.payload).hexdigest()
                assert whole[int(offset) :].startswith(r.url.encode() + b" ")


def test_members_of_any_size_are_unpacked():
    parts = [b"", b"a", b"x" * 100_000, hashlib.sha512(b"").digest() * 999, b"\0\0"]
    raw = b"".join(gzip.compress(p) for p in parts)
    assert warc.unpacked(raw) == b"".join(parts) and warc.unpacked(b"") == b""
    with pytest.raises(warc.ArchiveError, match="within a gzip member"):
        warc.unpacked(raw[:-5])


def test_arc_versions_and_broken_archives():
    for version in (1, 2):
        data = warc.arc_version_block(version, "a.arc") + b"\n" + warc.arc_record(version, "http://a", b"x\ny\n\n") + b"\n" + warc.arc_record(version, "http://b", b"") + b"\n"
        got = list(warc.read_arc(data))
        assert [(r.url, r.payload, r.date, r.mime) for r in got] == [("http://a", b"x\ny\n\n", "20240101000000", "text/html"), ("http://b", b"", "20240101000000", "text/html")]
        for broken in (data[:-4], data.replace(b"http://a 0", b"http://a 0 0"), data[5:], data.replace(b" 5\n", b" 500\n"), data.replace(f"{version} 0 placeframe".encode(), b"9 0 placeframe")):
            if broken != data:
                with pytest.raises(warc.ArchiveError):
                    list(warc.read_arc(broken))
    assert warc.warc_date("1997") == "1997-01-01T00:00:00Z" and warc.warc_date("199703") == "1997-03-01T00:00:00Z"
    wrong = warc.arc_version_block(2, "a.arc") + b"\n" + warc.arc_record(2, "http://a", b"x\ny\n\n").replace(b"x\ny", b"x\nz") + b"\n"
    with pytest.raises(warc.ArchiveError, match="checksum"):
        list(warc.read_arc(wrong))
    with pytest.raises(warc.ArchiveError):
        list(warc.read_warc(b"WARC/1.0\r\nContent-Length: 5\r\n\r\nab\r\n\r\n"))
