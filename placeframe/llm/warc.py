"""Legacy archives: ARC files are read by their version's header lines and
declared lengths, and converted to WARC files.

An ARC file begins with a version block (``filedesc://...``), whose second
line names the version and whose third line the fields of the records' header
lines. Version 1 has URL, IP address, date, content type and length; version 2
adds result code, checksum, location, offset and file name. The declared
length alone tells where a record's content ends.

For each ARC record the converter synthesises a WARC record: an id from the
record's URL, date, digest and place (archive and number in it; these are written by
then, so a retried task gives the same id, and no two records share one), the
date in WARC's form, the payload's SHA-1 as digest, and the type. What version 2
declares besides (result code, checksum, location, offset, file name) is carried in
header fields of its own; a checksum that the content doesn't have is an error. Of the
records with equal payloads of at least ``REVISIT_BYTES`` the one with the
largest key is the ``response``; the others are ``revisit`` records that name
it and have no block.

Archives are written by Spark's text sink: a row is a whole archive of about
``ARCHIVE_BYTES``, the line separator is what ends a record, and the sink's
commit protocol makes lost tasks harmless. Each record is a gzip member of its own, so
one can be read from its offset alone; the sink's separator completes an empty last
member. (A page is a row, and an archive is one: 2 GB bounds both.) The
``page_id`` travels in the ARC URL's fragment and in a WARC header field.

Edge cases: a null html is an empty payload; a null or odd URL (spaces, line
ends) is percent-encoded in the header lines; a null page id stays null and
counts as smallest; pages that repeat are records of their own, and when ids
tie too the one that is a response is shared; an empty table gives empty archives.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeframe.llm.common import prepare, stored
from placeframe.session import fresh_dir

#: Payloads of so many bytes at least are stored once.
REVISIT_BYTES = 1000
#: Bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
#: Compression of a record, and bytes that are fed to its decompression at a time.
LEVEL, PIECE = 3, 4096
#: Digest groups up to which the table of revisited payloads is broadcast.
BROADCAST_ROWS = 200_000

#: The header fields of the two ARC versions.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
#: Fields of version 2 that WARC has no field for.
MORE = ["Result-code", "Checksum", "Location", "Offset", "Filename"]
ARC_DATE = "20240101000000"
ARC_NAME = "pages.arc"
ARC_END = b"\n"
WARC_END = b"\r\n\r\n"
_PAGE = re.compile(r"#pf-page=(-?\d*)$")


class ArchiveError(ValueError):
    """An archive that doesn't hold what its header lines declare."""


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    mime: str
    payload: bytes
    #: Result code, checksum, location, offset and file name, as version 2 declares them.
    more: tuple[str, ...] = ()


def arc_version_block(version: int, name: str) -> bytes:
    """The block that begins an ARC file, without the line end that follows it."""
    body = f"{version} 0 placeframe\n{' '.join(ARC_FIELDS[version])}\n".encode()
    tail = "" if version == 1 else "200 - - 0 " + name + " "
    return f"filedesc://{name} 0.0.0.0 {ARC_DATE} text/plain {tail}{len(body)}\n".encode() + body


def arc_record(version: int, url: str, payload: bytes, name: str = "-", offset: int = 0) -> bytes:
    """A record in a version's form, without the line end that follows it."""
    tail = "" if version == 1 else f"200 {hashlib.md5(payload).hexdigest()} - {offset} {name} "
    return f"{url} 0.0.0.0 {ARC_DATE} text/html {tail}{len(payload)}\n".encode() + payload


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file of either version, without the version block."""
    view, at, end = memoryview(data), 0, len(data)
    fields: list[str] | None = None
    while at < end:
        while data[at : at + 1] == ARC_END:  # what ends a record; some writers add more
            at += 1
        if at >= end:
            break
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ArchiveError(f"unfinished header line at byte {at}")
        values = data[at:stop].decode("utf-8").rstrip("\r").split(" ")
        if fields is None:
            if not values[0].startswith("filedesc://"):
                raise ArchiveError("no version block")
        elif len(values) != len(fields):
            raise ArchiveError(f"{len(values)} header fields instead of {len(fields)} at byte {at}")
        if not values[-1].isdigit():
            raise ArchiveError(f"no length at byte {at}")
        low, at = stop + 1, stop + 1 + int(values[-1])
        if at > end:
            raise ArchiveError(f"content of {values[-1]} bytes ends after the file")
        if fields is None:
            lines = bytes(view[low:at]).decode("utf-8").split("\n")
            version = lines[0].split(" ")[0]
            if version not in ("1", "2") or len(lines) < 2:
                raise ArchiveError(f"unknown version {version!r}")
            fields = lines[1].split(" ")
            if fields != ARC_FIELDS[int(version)]:
                raise ArchiveError(f"unknown fields {lines[1]!r}")
            continue
        by = dict(zip(fields, values))
        payload = bytes(view[low:at])
        if by.get("Checksum", "-") not in ("-", hashlib.md5(payload).hexdigest()):
            raise ArchiveError(f"the content before byte {at} doesn't have its declared checksum")
        yield ArcRecord(by["URL"], by["IP-address"], by["Archive-date"], by["Content-type"], payload, tuple(by[f] for f in MORE if f in by))


def warc_date(arc_date: str) -> str:
    """An ARC date (14 digits, or fewer from the left) in WARC's form."""
    full = (arc_date + "00000101000000"[len(arc_date) :]) if len(arc_date) < 14 else arc_date[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(url: str, date: str, digest: str, place: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest} {place}')}>"


def warc_record(record: ArcRecord, url: str, page: str, digest: str, place: str, refers: tuple[str, str] | None = None) -> bytes:
    """A WARC record without the two line ends that follow it. ``place`` tells apart records
    that are equal; with ``refers`` (the id and page of the response with the same
    payload) it is a revisit record."""
    date = warc_date(record.date)
    block = b"" if refers else record.payload
    head = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if refers else 'response'}",
        f"WARC-Record-ID: {record_id(record.url, date, digest, place)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}",
        f"WARC-IP-Address: {record.ip}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {page}",
        f"X-Payload-Length: {len(record.payload)}",
    ]
    if refers:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: {refers[0]}", f"X-Refers-To-Page: {refers[1]}"]
    head += [f"X-ARC-{name}: {value}" for name, value in zip(MORE, record.more)]
    head += [f"Content-Type: {record.mime}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def warc_info(first: bytes) -> bytes:
    """The record that begins a WARC file whose first other record is ``first``, without the two line ends
    that follow it. Records are unique, so its id is."""
    body = b"software: placeframe\r\nformat: WARC File Format 1.0\r\n"
    head = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id('warcinfo', ARC_DATE, hashlib.sha1(first).hexdigest(), '')}\r\nWARC-Date: {warc_date(ARC_DATE)}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a WARC file."""
    at, end = 0, len(data)
    while at < end:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/1.", at):
            raise ArchiveError(f"no record at byte {at}")
        lines = data[at:stop].decode("utf-8").split("\r\n")
        head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        low = stop + 4
        at = low + int(head["content-length"])
        if data[at : at + 4] != WARC_END:
            raise ArchiveError(f"the record before byte {at} doesn't end there")
        yield head, data[low:at]
        at += 4


def _files(records: Iterable[Callable[[int], bytes]], begin: Callable[[bytes], bytes], end: bytes, most: int = ARCHIVE_BYTES) -> Iterator[pa.RecordBatch]:
    """Whole archives of about ``most`` bytes. A record is made from its offset in the uncompressed
    archive; ``begin`` gives what an archive with this first record begins with."""

    def whole(members: list[bytes]) -> pa.RecordBatch:
        last = gzip.compress(b"", mtime=0)  # ends with a byte 0, which the sink adds
        return pa.RecordBatch.from_arrays([pa.array([b"".join([*members, last[:-1]])], pa.binary())], names=["value"])

    members: list[bytes] = []
    size = held = 0
    for record in records:
        if not members:
            head = begin(record(0)) + end
            members, size = [gzip.compress(head, LEVEL, mtime=0)], len(head)
            held = size
        row = record(size) + end
        members.append(gzip.compress(row, LEVEL, mtime=0))
        size += len(row)
        held += len(row)
        if held >= most:
            yield whole(members)
            members = []
    if members:
        yield whole(members)


def _write(archives: DataFrame, path: str) -> None:
    # the sink writes the bytes of a row as they are, then the separator: the last byte of a gzip member
    text = archives.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _archives(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content", F.regexp_extract("path", "[^/]*$", 0).alias("name"))


def unpacked(raw: bytes | pa.Buffer) -> bytes:
    """The content of all gzip members. Each is fed in small pieces, so that finding where one
    ends doesn't copy what follows it."""
    view, at, out = memoryview(raw), 0, []
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof:
            piece = view[at : at + PIECE]
            if not len(piece):
                raise ArchiveError("the archive ends within a gzip member")
            out.append(member.decompress(piece))
            at += len(piece)
        at -= len(member.unused_data)
    return b"".join(out)


def header_url(url: str | None, page: int | None) -> str:
    """A URL without spaces and line ends, with the page's id as its fragment's end."""
    return quote(url or "", safe="%/:=&?~#+!$,;'@()*[]._-") + f"#pf-page={'' if page is None else page}"


def write_arc(pages: DataFrame, path: str, version: int = 1, key: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Writes the pages as ARC archives of a version under ``path``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Callable[[int], bytes]]:
            for batch in batches:
                for page, link, payload in zip(*(c.to_pylist() for c in batch.columns)):
                    yield partial(arc_record, version, header_url(link, page), payload or b"", ARC_NAME)

        return _files(records(), lambda _: arc_version_block(version, ARC_NAME), ARC_END)

    prepare(pages.sparkSession)
    thin = pages.select(pages[key].cast("long").alias("k"), pages[url].cast("string").alias("u"), pages[html].cast("binary").alias("p"))
    _write(thin.mapInArrow(run, "value binary"), path)
    return path


def read_records(spark, path: str) -> DataFrame:
    """(page_id, url, date, ip, mime, payload, more, place, digest) of the ARC archives under ``path``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, name in zip(batch.column(0), batch.column(1).to_pylist()):
                held, size = [], 0
                for i, r in enumerate(read_arc(unpacked(content.as_buffer()))):
                    found = _PAGE.search(r.url)
                    page = int(found[1]) if found and found[1] else None
                    held.append((page, r.url, r.date, r.ip, r.mime, r.payload, list(r.more), f"{name} {i}"))
                    size += len(r.payload)
                    if size >= 4 << 20:
                        yield _record_batch(held)
                        held, size = [], 0
                if held:
                    yield _record_batch(held)

    prepare(spark)
    found = _archives(spark, path).mapInArrow(run, "page_id long, url string, date string, ip string, mime string, payload binary, more array<string>, place string")
    return found.withColumn("digest", F.sha1("payload"))


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.string()]
    names = ["page_id", "url", "date", "ip", "mime", "payload", "more", "place"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def convert(spark, arc_path: str, warc_path: str, tag: str = "warc") -> str:
    """Converts the ARC archives under a path to WARC archives under another.

    Digests are grouped first (combined before the shuffle, so that a payload
    that a third of the pages have is no hot spot); only digests that repeat are
    joined to the records, by broadcast if they are few, else by a join that
    splits skewed keys.
    """
    records = read_records(spark, arc_path)
    thin = records.select("digest", "page_id", "url", "date", "place", F.octet_length("payload").alias("n"))
    repeated = stored(
        thin.filter(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url", "date", "place")).alias("first")).filter("n > 1").drop("n"),
        f"{tag}-repeated",
    )
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    known = records.join(repeated, "digest", "left")
    kind = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id")), "revisit").otherwise("response")
    columns = known.select("page_id", "url", "date", "ip", "mime", "payload", "digest", kind.alias("kind"), F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url"), F.col("first.date").alias("first_date"), "more", "place", F.col("first.place").alias("first_place"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Callable[[int], bytes]]:
            for batch in batches:
                for page, url, date, ip, mime, payload, digest, kind, first, first_url, first_date, more, place, first_place in zip(*(c.to_pylist() for c in batch.columns)):
                    record = ArcRecord(url, ip, date, mime, payload, tuple(more))
                    refers = (record_id(first_url, warc_date(first_date), digest, first_place), str(first)) if kind == "revisit" else None
                    made = warc_record(record, _PAGE.sub("", url), "" if page is None else str(page), digest, place, refers)
                    yield lambda _, made=made: made

        return _files(rows(), warc_info, WARC_END)

    _write(columns.mapInArrow(run, "value binary"), warc_path)
    return warc_path


def read_back(spark, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the page
    records of the WARC archives under ``path``. A response's size and digest are
    those of the block that was read; a revisit's are the declared ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for head, block in read_warc(unpacked(content.as_buffer())):
                    kind = head["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
                    if kind == "response":
                        if hashlib.sha1(block).hexdigest() != digest:
                            raise ArchiveError("a block doesn't have the digest that its record declares")
                        size = len(block)
                    refers = int(head["x-refers-to-page"]) if kind == "revisit" else None
                    out.append((int(head["x-page-id"]) if head.get("x-page-id") else None, size, digest, kind, refers))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    prepare(spark)
    return _archives(spark, path).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def convert_pages(pages: DataFrame, version: int = 1, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the pages as ARC archives, converts those to WARC and reads the WARC archives back."""
    spark = pages.sparkSession
    arc, warc = fresh_dir(spark, "arc"), fresh_dir(spark, "warc")
    write_arc(pages, arc, version, key, url, html)
    return read_back(spark, convert(spark, arc, warc))
