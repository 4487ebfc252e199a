"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Frequent pieces of the corpus, counted by Spark over all documents, are
compiled into a minimal acyclic automaton whose words share suffixes as well
as prefixes. Each arc carries how many words lie before it, so a walk through
the automaton yields the word's number, and a table has the ids of each
number. The arrays are written as one file, sent to the executors as a
session file and memory-mapped there, so a machine's workers share one copy.
Pieces outside the lexicon are merged exactly, all distinct ones of a block of
texts together; the lexicon decides speed, never the result.

Edge cases: a null or empty text has no ids and decodes to an empty text;
special strings inside a text become their token; repeated rows and null ids
are encoded row by row; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from placeframe.llm.common import carried, in_batches, prepare, stored, text_batches
from placeframe.llm.pieces import Vocabulary, distinct_pieces, parse_vocabulary, parts_of

#: Words in the lexicon (the most frequent of the corpus).
LEXICON_WORDS = 50_000
#: Classes of counts for each doubling, in the histogram that bounds the lexicon.
STEPS = 32
#: Distinct pieces that a counting task holds before it passes them on.
HELD = 300_000


class Lexicon:
    """A minimal acyclic transducer from words to sequences of ids, in arrays."""

    FIELDS = ("keys", "targets", "skips", "finals", "offsets", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, entries: dict[bytes, list[int]]) -> Lexicon:
        """Compiles words in sorted order, sharing equal states as soon as no later
        word can change them."""
        words = sorted(w for w in entries if w)
        shared: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def close(final: bool, arcs: list[tuple[int, int]]) -> int:
            key = (final, tuple(arcs))
            if key not in shared:
                shared[key] = len(states)
                states.append(key)
            return shared[key]

        path: list[tuple[bool, list[tuple[int, int]]]] = [(False, [])]  # open states along the last word
        last = b""
        for word in words:
            common = len(os.path.commonprefix([word, last]))
            while len(path) - 1 > common:
                final, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], close(final, arcs)))
            path += [(False, []) for _ in range(len(word) - common)]
            path[-1] = (True, path[-1][1])
            last = word
        while len(path) > 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], close(final, arcs)))
        states.append((path[0][0], tuple(path[0][1])))  # the root is the last state
        below: list[int] = []  # words from each state on; children come first
        keys, targets, skips = [], [], []
        for state, (final, arcs) in enumerate(states):
            n = int(final)
            for byte, target in arcs:
                keys.append(state * 256 + byte)
                targets.append(target)
                skips.append(n)
                n += below[target]
            below.append(n)
        sequences = [entries[w] for w in words]
        return cls(
            {
                "keys": np.array(keys, np.int64),
                "targets": np.array(targets, np.int32),
                "skips": np.array(skips, np.int32),
                "finals": np.array([f for f, _ in states], np.uint8),
                "offsets": np.cumsum([0, *map(len, sequences)], dtype=np.int64),
                "ids": np.fromiter(chain.from_iterable(sequences), np.int32),
            }
        )

    @classmethod
    def of(cls, vocabulary: Vocabulary, words: list[bytes]) -> Lexicon:
        ids, sizes = vocabulary.encoded(words)
        ends = np.cumsum(sizes).tolist()
        return cls.build({w: ids[e - n : e].tolist() for w, n, e in zip(words, sizes.tolist(), ends)})

    def numbers(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of each word (bytes ``data[offsets[i]:offsets[i + 1]]``), or -1; all walk at once."""
        n = len(offsets) - 1
        out = np.full(n, -1, np.int64)
        length = np.diff(offsets)
        live = np.flatnonzero(length > 0)
        if not len(self.keys):
            return out
        state = np.full(n, len(self.finals) - 1, np.int64)
        number = np.zeros(n, np.int64)
        step = 0
        while len(live):
            key = state[live] * 256 + data[offsets[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            live, arc = live[ok], arc[ok]
            state[live] = self.targets[arc]
            number[live] += self.skips[arc]
            step += 1
            done = length[live] == step
            ended = live[done]
            ended = ended[self.finals[state[ended]] == 1]
            out[ended] = number[ended]
            live = live[~done]
        return out

    def save(self, path: str) -> None:
        with open(path, "wb") as f:
            for name in self.FIELDS:
                np.lib.format.write_array(f, np.ascontiguousarray(getattr(self, name)), version=(1, 0))

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        """Memory-maps a saved lexicon."""
        arrays, at = {}, 0
        with open(path, "rb") as f:
            for name in cls.FIELDS:
                np.lib.format.read_magic(f)
                shape, _, dtype = np.lib.format.read_array_header_1_0(f)
                at = f.tell()
                arrays[name] = np.memmap(path, dtype, "r", at, shape) if shape[0] else np.zeros(0, dtype)
                f.seek(at + dtype.itemsize * shape[0])
        return cls(arrays)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[starts[i]:starts[i] + lengths[i]]`` end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class Codec:
    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        by_id = {i: b for b, i in vocabulary.ids.items()} | {i: s.encode() for s, i in vocabulary.special.items()}
        symbols = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.sizes = np.array([len(s) for s in symbols], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(symbols), np.uint8)

    def _distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct pieces end to end, with begins and lengths."""
        raw = [p.encode() for p in pieces]
        offsets = np.cumsum([0, *map(len, raw)], dtype=np.int64)
        lex = self.lexicon
        number = lex.numbers(np.frombuffer(b"".join(raw), np.uint8), offsets)
        rest = np.flatnonzero(number < 0)
        found = np.where(number >= 0, number, 0)
        if len(lex.offsets) > 1:
            starts, lengths = lex.offsets[found], lex.offsets[found + 1] - lex.offsets[found]
        else:
            starts, lengths = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        own, sizes = self.vocabulary.encoded([raw[i] for i in rest.tolist()])
        lengths[rest] = sizes
        starts[rest] = len(lex.ids) + np.cumsum(sizes) - sizes
        return np.concatenate([lex.ids, own.astype(np.int32)]), starts, lengths

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the bounds of each text's."""
        parts = parts_of(texts, self.vocabulary.special)
        flat, sizes = [], np.zeros(len(parts.texts), np.int64)
        for low, high in text_batches(parts.texts):
            pieces, inverse, cuts = distinct_pieces(parts.texts[low:high])
            ids, starts, lengths = self._distinct(pieces)
            starts, lengths = starts[inverse], lengths[inverse]
            total = np.concatenate([[0], np.cumsum(lengths)])
            sizes[low:high] = total[cuts[1:]] - total[cuts[:-1]]
            special = parts.special[low:high]
            got = gather(ids, starts, lengths)
            if (special >= 0).any():
                at = np.flatnonzero(special >= 0)
                got = np.insert(got, total[cuts[:-1]][at], special[at])
                sizes[low:high][at] = 1
            flat.append(got)
        count = np.zeros(len(texts), np.int64)
        np.add.at(count, parts.owner, sizes)
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(count)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each range of ids; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.sizes[ids]
        raw = gather(self.bytes, self.begins[ids], sizes).tobytes()
        cuts = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


def piece_counts(docs: DataFrame, special: dict[str, int], text: str = "text") -> DataFrame:
    """(piece, n): how often each piece occurs in all the texts. Tasks sum what they meet before the shuffle."""

    def rows(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["piece", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            parts = parts_of(batch.column("__text").to_pylist(), special)
            for low, high in text_batches(parts.texts):
                pieces, inverse, _ = distinct_pieces(parts.texts[low:high])
                for piece, n in zip(pieces, np.bincount(inverse, minlength=len(pieces)).tolist()):
                    held[piece] = held.get(piece, 0) + n
                if len(held) >= HELD:
                    yield rows(held)
                    held = {}
        if held:
            yield rows(held)

    prepare(docs.sparkSession)
    found = docs.select(docs[text].alias("__text")).mapInArrow(run, "piece string, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def corpus_lexicon(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", words: int = LEXICON_WORDS) -> Lexicon:
    """The lexicon of the most frequent pieces of all the texts, ``words`` at most.

    A histogram of the counts (``STEPS`` classes for each doubling, so some
    hundred rows whatever the corpus) gives the count from which on the pieces
    are few enough; only those come to the driver.
    """
    counts = stored(piece_counts(docs, vocabulary.special, text), "piece-counts")
    level = F.floor(F.log2(F.col("n")) * STEPS)
    left, least = words, None
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pieces"), F.min("n").alias("least")).orderBy(F.desc("level")).collect():
        if r["pieces"] > left:
            break
        left, least = left - r["pieces"], r["least"]
    top = [] if least is None else counts.filter(F.col("n") >= least).select("piece").collect()
    return Lexicon.of(vocabulary, [r[0].encode() for r in top])


def ship_lexicon(docs: DataFrame, lexicon: Lexicon) -> str:
    """Saves the lexicon and adds it to the session's files; returns its name there."""
    folder = tempfile.mkdtemp(prefix="placeframe-lexicon-")  # read by the driver's file server alone
    plain = os.path.join(folder, "lexicon")
    lexicon.save(plain)
    with open(plain, "rb") as f:
        name = f"lexicon-{hashlib.sha256(f.read()).hexdigest()[:24]}-{os.path.basename(folder)[-8:]}"
    os.replace(plain, os.path.join(folder, name))
    docs.sparkSession.sparkContext.addFile(os.path.join(folder, name))
    return name


@lru_cache(maxsize=2)
def _codec(raw: bytes, name: str) -> Codec:
    return Codec(parse_vocabulary(raw), Lexicon.mapped(SparkFiles.get(name)))


@lru_cache(maxsize=2)
def _decoder(raw: bytes) -> Codec:
    return Codec(parse_vocabulary(raw), Lexicon.build({}))


def encode_documents(
    docs: DataFrame,
    vocabulary_path: str,
    text: str = "text",
    keep: list[str] | None = None,
    ids: str = "ids",
    decoded: str | None = None,
    words: int = LEXICON_WORDS,
) -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with the ids of each whole
    text in ``ids`` and, if ``decoded`` is given, the text that they decode to."""
    names = docs.columns if keep is None else keep
    rows, inner, fields = carried(docs, names, __text=text)
    with open(vocabulary_path, "rb") as f:
        raw = f.read()
    name = ship_lexicon(docs, corpus_lexicon(docs, parse_vocabulary(raw), text, words))
    shared = docs.sparkSession.sparkContext.broadcast(raw)  # a vocabulary file: some MB

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, name)
        texts = batch.column("__text").to_pylist()
        for low, high in text_batches(texts, 1 << 22):
            flat, bounds = codec.encode(texts[low:high])
            part = batch.slice(low, high - low)
            columns = [*(part.column(n) for n in inner), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))]
            if decoded:
                columns.append(pa.array(codec.decode(flat, bounds), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*inner, "__ids", *(["__decoded"] if decoded else [])])

    fields = [*fields, StructField("__ids", ArrayType(IntegerType())), *([StructField("__decoded", StringType())] if decoded else [])]
    return in_batches(rows, encode, StructType(fields)).toDF(*names, ids, *([decoded] if decoded else []))


def decode_documents(df: DataFrame, vocabulary_path: str, ids: str = "ids", keep: list[str] | None = None, out: str = "text") -> DataFrame:
    """``df`` (its columns ``keep``, by default all but the ids) with the text that the ids stand for; null ids give an empty text."""
    names = [n for n in df.columns if n != ids] if keep is None else keep
    rows, inner, fields = carried(df, names, __ids=ids)
    with open(vocabulary_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def decode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = [x or [] for x in batch.column("__ids").to_pylist()]
        bounds = np.cumsum([0, *map(len, lists)], dtype=np.int64)
        codec = _decoder(shared.value)
        texts = codec.decode(np.fromiter(chain.from_iterable(lists), np.int64, int(bounds[-1])), bounds)
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in inner), pa.array(texts, pa.string())], names=[*inner, "__out"])

    return in_batches(rows, decode, StructType([*fields, StructField("__out", StringType())])).toDF(*names, out)
