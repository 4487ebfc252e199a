"""Token ids in binary files of compressed byte or bit planes.

The ids of documents, in ascending order of their document's id, are cut into
blocks of a fixed number of ids. A block is transposed into planes (all lowest
bytes, then all next ones, ...; or the same by bits), and each plane is compressed
with zstandard by itself: planes of high bytes hold next to nothing. A file holds
the blocks of whole documents, an index of its blocks and documents, and a trailer,
so that any range of ids is read by way of the blocks it touches (``TokenFile``).

    block     the planes of up to ``block`` ids, compressed, one after another
    ...       every block ends with a line feed that no length counts
    index     compressed: a header (planes, bits of a plane, blocks, documents), for
              each block its offset, ids, CRC-32 of the ids and lengths of the planes,
              for each document its id, whether it is null, and its number of ids
    trailer   length and CRC-32 of the index, the magic word; a line feed

Spark writes the files (one for each range of document ids; the line feeds are what
its text writer ends a record with), so that a lost task's file is never seen, and
reads them as binary files. A task holds a block and some texts while it writes, and
one file, about ``file_bytes`` of text or its largest document, while it reads.

Edge cases: a null or empty text has no ids but the end id; null document ids come
first, equal ones go by a hash of their text; document ids must be whole numbers;
an empty table gives no files and reads as an empty table; a text of any length is
encoded whole; other columns are left out.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placeframe.llm.bpe_codec import gather
from placeframe.llm.common import in_batches, prepare, ranges, stored, text_batches
from placeframe.llm.pieces import byte_letters, distinct_pieces, parts_of

MAGIC = b"IDPLANE1"
#: Ids in a block, and bytes of text in a file, unless asked otherwise.
BLOCK, FILE_BYTES = 1 << 16, 32 << 20
#: Ids of distinct pieces that a task's worker keeps; when full it starts anew.
CACHED = 150_000
#: Files up to which their first ids are broadcast.
BROADCAST_ROWS = 200_000
_HEAD, _TRAILER = struct.Struct("<IIQQ"), struct.Struct("<QI8s")


class Encoder:
    """Ids as the tokenizers library gives them. For a plain byte-level vocabulary the texts are cut
    into pieces here, and the library merges each distinct piece once; for others it takes whole texts."""

    def __init__(self, raw: bytes, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(raw.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.cached, self.known = cached, {}
        self.special = plain_specials(json.loads(raw))
        if self.special is not None:
            letter = {b: c for c, b in byte_letters().items()}
            self.letters = [letter[b] for b in range(256)]

    def piece(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            letters = self.letters
            ids = [t.id for t in self.library.model.tokenize("".join([letters[b] for b in piece.encode()]))]
            if len(self.known) >= self.cached:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts end to end and the bounds of each text's."""
        if self.special is None:
            lists = [self.library.encode(t or "", add_special_tokens=False).ids for t in texts]
            return np.fromiter(chain.from_iterable(lists), np.uint32), np.cumsum([0, *map(len, lists)], dtype=np.int64)
        parts = parts_of(texts, self.special)
        flat, sizes = [], np.zeros(len(parts.texts), np.int64)
        for low, high in text_batches(parts.texts):
            pieces, inverse, cuts = distinct_pieces(parts.texts[low:high])
            own = [self.piece(p) for p in pieces]
            lengths = np.fromiter(map(len, own), np.int64, len(own))
            ids = gather(np.fromiter(chain.from_iterable(own), np.uint32), (np.cumsum(lengths) - lengths)[inverse], lengths[inverse])
            total = np.concatenate([[0], np.cumsum(lengths[inverse])])
            sizes[low:high] = total[cuts[1:]] - total[cuts[:-1]]
            special = parts.special[low:high]
            at = np.flatnonzero(special >= 0)
            if len(at):
                ids = np.insert(ids, total[cuts[:-1]][at], special[at].astype(np.uint32))
                sizes[low:high][at] = 1
            flat.append(ids)
        count = np.zeros(len(texts), np.int64)
        np.add.at(count, parts.owner, sizes)
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(count)])


def plain_specials(data: dict) -> dict[str, int] | None:
    """The special strings of a plain byte-level vocabulary; None where texts are changed or cut in another way."""
    model, cut = data.get("model") or {}, data.get("pre_tokenizer") or {}
    odd_model = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    plain = model.get("type", "BPE") == "BPE" and not odd_model and not data.get("normalizer")
    plain = plain and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    added = data.get("added_tokens") or []
    if not plain or any(x.get(k) for x in added for k in ("single_word", "lstrip", "rstrip")):
        return None
    return {x["content"]: x["id"] for x in added}


@lru_cache(maxsize=2)
def _encoder(raw: bytes) -> Encoder:
    return Encoder(raw)


def shuffled(ids: np.ndarray, bits: int) -> np.ndarray:
    """The planes (rows) of some 32-bit ids: of each id's bytes, or of its bits."""
    by_byte = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return np.ascontiguousarray(by_byte.T)
    return np.packbits(np.unpackbits(by_byte, axis=1, bitorder="little").T, axis=1, bitorder="little")


def restored(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    """The ids of which ``planes`` are the planes."""
    if bits == 8:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
    rows = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(rows, axis=1, bitorder="little").reshape(-1).view("<u4")


class FileWriter:
    """Makes the records of one file."""

    def __init__(self, block: int = BLOCK, bits: int = 8, level: int = 3):
        if bits not in (1, 8) or block < 1:
            raise ValueError("planes are of 1 or 8 bits, blocks of one id at least")
        self.size, self.bits, self.press = block, bits, zstandard.ZstdCompressor(level=level)
        self.held: list[np.ndarray] = []
        self.open = self.at = 0
        self.blocks: list[tuple] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc_ids: list[int | None], flat: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
        """Some documents' ids end to end; gives the blocks that are full."""
        null = np.array([i is None for i in doc_ids], np.uint8)
        self.docs.append((np.array([i or 0 for i in doc_ids], "<i8"), null, np.diff(bounds).astype("<u8")))
        while len(flat):
            part, flat = flat[: self.size - self.open], flat[self.size - self.open :]
            self.held.append(part)
            self.open += len(part)
            if self.open == self.size:
                yield self._block()

    def _block(self) -> bytes:
        ids = np.concatenate(self.held).astype("<u4")
        self.held, self.open = [], 0
        planes = [self.press.compress(p.tobytes()) for p in shuffled(ids, self.bits)]
        self.blocks.append((self.at, len(ids), zlib.crc32(ids.tobytes()), *map(len, planes)))
        raw = b"".join(planes)
        self.at += len(raw) + 1
        return raw

    def end(self) -> Iterator[bytes]:
        """The last block, the index and the trailer."""
        if self.open:
            yield self._block()
        planes = 32 // self.bits
        table = np.array(self.blocks, "<u8").reshape(len(self.blocks), 3 + planes)
        ids, null, sizes = (np.concatenate([d[k] for d in self.docs]) if self.docs else np.zeros(0, t) for k, t in enumerate(("<i8", np.uint8, "<u8")))
        index = self.press.compress(_HEAD.pack(planes, self.bits, len(table), len(ids)) + table.tobytes() + ids.tobytes() + null.tobytes() + sizes.tobytes())
        yield index + _TRAILER.pack(len(index), zlib.crc32(index), MAGIC)


class TokenFile:
    """A file's documents and ids. Blocks are unpacked when they are asked for."""

    def __init__(self, raw: bytes | memoryview, name: str = "file"):
        self.raw, self.name, end = memoryview(raw), name, len(raw) - 1
        if end < _TRAILER.size:
            raise ValueError(f"{name} is no token file")
        size, crc, magic = _TRAILER.unpack(self.raw[end - _TRAILER.size : end])
        index = self.raw[end - _TRAILER.size - size : end - _TRAILER.size]
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"{name} is no token file, or its index is damaged")
        self.unpack = zstandard.ZstdDecompressor()
        body = self.unpack.decompress(index)
        planes, self.bits, blocks, docs = _HEAD.unpack_from(body)
        at, width = _HEAD.size, 3 + planes
        self.blocks = np.frombuffer(body, "<u8", blocks * width, at).reshape(blocks, width).astype(np.int64)
        at += 8 * blocks * width
        self.doc_ids, self.null = np.frombuffer(body, "<i8", docs, at), np.frombuffer(body, np.uint8, docs, at + 8 * docs)
        self.bounds = np.concatenate([[0], np.cumsum(np.frombuffer(body, "<u8", docs, at + 9 * docs).astype(np.int64))])
        self.firsts = np.concatenate([[0], np.cumsum(self.blocks[:, 1])])

    def block(self, k: int) -> np.ndarray:
        offset, n, crc, *sizes = self.blocks[k].tolist()
        ends = np.cumsum([offset, *sizes]).tolist()
        ids = restored([self.unpack.decompress(self.raw[a:b]) for a, b in zip(ends, ends[1:])], n, self.bits)
        if len(ids) != n or zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {k} of {self.name} is damaged")
        return ids

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``, from the blocks that hold them alone."""
        low, high = np.searchsorted(self.firsts, [start, stop], "right").tolist()
        found = [self.block(k) for k in range(low - 1, min(high, len(self.blocks)))] if start < stop else []
        whole = np.concatenate(found) if found else np.zeros(0, "<u4")
        return whole[start - int(self.firsts[low - 1]) : stop - int(self.firsts[low - 1])] if found else whole

    def documents(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(document, its ids in parts) one after another; each block is unpacked once."""
        k, have = -1, np.zeros(0, "<u4")
        for i, n in enumerate(np.diff(self.bounds).tolist()):
            parts = []
            while n:
                if not len(have):
                    k += 1
                    have = self.block(k)
                parts.append(have[:n])
                n -= len(parts[-1])
                have = have[len(parts[-1]) :]
            yield i, parts


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary_path: str,
    end: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    bits: int = 8,
    block: int = BLOCK,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Writes the ids of every whole text, with the id ``end`` after each document's if given."""
    spark = prepare(docs.sparkSession)
    with open(vocabulary_path, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())  # a vocabulary file: some MB
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # ranges of ids; equal ids are dealt to several ranges, so a much repeated one is no hot spot
    keys = ["doc", "tie", "salt"]
    dealt = own.withColumn("tie", F.xxhash64("text")).withColumn("salt", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(size // file_bytes + 1, *keys).sortWithinPartitions(*keys).select("doc", "text")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give = lambda x: pa.RecordBatch.from_arrays([pa.array([x], pa.binary())], names=["record"])
        writer, encoder, any_row = FileWriter(block, bits), None, False
        for batch in batches:
            encoder = encoder or _encoder(raw.value)
            numbers, texts = batch.column("doc").to_pylist(), batch.column("text")
            any_row = any_row or bool(numbers)
            for low, high in ranges(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                flat, bounds = encoder.encode(texts.slice(low, high - low).to_pylist())
                if end is not None:
                    flat = np.insert(flat, bounds[1:], np.uint32(end))
                    bounds = bounds + np.arange(len(bounds))
                yield from map(give, writer.add(numbers[low:high], flat, bounds))
        if any_row:
            yield from map(give, writer.end())

    # the text writer writes a string's bytes as they are
    dealt.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(path)
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content): the files that aren't empty, by their number in the order of ids."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0")
    return found.select(F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long").alias("file"), "content")


_PLACE = "file long, doc_id long, start long, n_tokens long"


def _documents(spark: SparkSession, path: str, kind: str, value) -> DataFrame:
    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for number, content in zip(batch.column("file").to_pylist(), batch.column("content")):
            held = TokenFile(content.as_buffer(), f"file {number}")
            sizes, rows, weight = np.diff(held.bounds), [], 0

            def give(rows: list) -> pa.RecordBatch:
                at = np.array([i for i, _ in rows])
                ids = pa.array(held.doc_ids[at], mask=held.null[at].astype(bool))  # noqa: B023
                columns = [pa.array(np.full(len(at), number)), ids, pa.array(held.bounds[at]), pa.array(sizes[at]), value([v for _, v in rows])]  # noqa: B023
                return pa.RecordBatch.from_arrays(columns, names=["file", "doc_id", "start", "n_tokens", kind.split()[0]])

            for i, parts in held.documents():
                rows.append((i, parts))
                weight += int(sizes[i]) + 16
                if weight >= 1 << 20:
                    yield give(rows)
                    rows, weight = [], 0
            if rows:
                yield give(rows)

    return in_batches(_files(spark, path), read, f"{_PLACE}, {kind}")


def _placed(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Starts among all files' ids: a file's first id is the sum of the files before it (a row for each file)."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    if totals.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    return rows.join(firsts, "file").withColumn("start", F.col("start") + F.col("first")).drop("file", "first")


def _crc(parts: list[np.ndarray]) -> int:
    out = 0
    for p in parts:
        out = zlib.crc32(p.tobytes(), out)
    return out


def token_file_digests(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document in the files: doc_id, start, n_tokens, and the CRC-32 of its ids
    as little-endian 32-bit integers."""
    rows = stored(_documents(spark, path, "ids_crc32 long", lambda docs: pa.array([_crc(d) for d in docs], pa.int64())), "token-files-read")
    return _placed(rows, rows.groupBy("file").agg(F.sum("n_tokens").alias("ids")))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document in the files: doc_id, start, n_tokens, ids."""

    def lists(docs: list[list[np.ndarray]]) -> pa.Array:
        bounds = np.cumsum([0, *(sum(map(len, d)) for d in docs)])
        flat = np.concatenate([np.zeros(0, "<u4"), *chain.from_iterable(docs)]).astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))

    def ends(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [int(TokenFile(c.as_buffer()).bounds[-1]) for c in batch.column("content")]
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(found, pa.int64())], names=["file", "ids"])

    totals = stored(in_batches(_files(spark, path), ends, "file long, ids long"), "token-files-totals")
    return _placed(_documents(spark, path, "ids array<long>", lists), totals)
