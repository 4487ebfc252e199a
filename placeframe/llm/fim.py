"""Fill-in-the-middle texts by displacement scatter.

A text is cut into units (white space with the signs after it; white space at the
end is a unit of its own) and, by a hash of its id, into prefix, middle and suffix.
It becomes ``<P>prefix<S>suffix<M>middle`` (psm), ``<S>suffix<P>prefix<M>middle``
(spm), or stays as it is (plain).

All texts of an Arrow batch are one array of bytes. A scan finds the ends of the
units; the cuts give, for each part of each text, how far its bytes move in the
output. Only where a part begins does that distance change, so a difference array
holds the changes, its running sum is each byte's shift, and one scatter writes the
bytes to their places. Restoring finds the three marks in an output, which gives
the same shifts, and gathers the bytes back.

Edge cases: a null text counts as empty, and an empty one stays plain with no units;
so does a text that holds one of the marks, as it could not be told apart; a null id
hashes as an empty string; equal rows give equal outputs; an empty table gives an
empty table; other columns named in ``keep`` pass through. A text of any length is
taken whole: shifts are made for ``SLICE`` bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from placeframe.llm.common import in_batches, ranges

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
PLAIN, PSM, SPM = range(3)
FORMS = ("plain", "psm", "spm")
#: Bytes that are moved at a time, and bytes of texts that are laid end to end.
SLICE, TOGETHER = 1 << 20, 4 << 20


def laid(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end, and the bounds; null counts as empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)]).cast(pa.string())


def unit_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where a unit ends, over all the texts. White space is one byte each in UTF-8, so bytes tell."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    last = np.zeros(len(data) + 1, bool)
    last[bounds] = True
    ends = ~space
    if len(data):
        ends[:-1] &= space[1:] | last[1:-1]
        ends |= last[1:] & space
    return np.flatnonzero(ends) + 1


def marks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of marks within one text, and their letters."""
    at = np.flatnonzero(data[:-2] == PREFIX[0]) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[(data[at + 2] == PREFIX[2]) & np.isin(data[at + 1], [m[1] for m in (PREFIX, SUFFIX, MIDDLE)])]
    at = at[np.searchsorted(bounds, at, "right") == np.searchsorted(bounds, at + 2, "right")]
    return at, data[at + 1]


def shifts(bounds: np.ndarray, outs: np.ndarray, form: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's parts begin and by how much the shift changes there. ``outs`` are
    the bounds of the outputs, ``first`` and ``second`` the ends of prefix and middle."""
    low, high = bounds[:-1], bounds[1:]
    prefix, middle, suffix = first - low, second - first, high - second
    base = outs[:-1] - low
    moved = form != PLAIN
    psm = form == PSM
    own = np.stack(
        [
            np.where(moved, np.where(psm, MARK, 2 * MARK + suffix), 0),
            np.where(moved, 3 * MARK + suffix, 0),
            np.where(moved, np.where(psm, 2 * MARK - middle, MARK - prefix - middle), 0),
        ],
        axis=1,
    )
    shift = (own + base[:, None]).reshape(-1)
    return np.stack([low, first, second], axis=1).reshape(-1), np.diff(shift, prepend=0)


def shift_slices(starts: np.ndarray, changes: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, place in the output of each byte): running sums of the difference array."""
    carry = 0
    for low in range(0, size, SLICE):
        high = min(low + SLICE, size)
        a, b = np.searchsorted(starts, [low, high])
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[a:b] - low, changes[a:b])
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = int(shift[-1])
        yield low, high, shift + np.arange(low, high)


def scatter(data: np.ndarray, bounds: np.ndarray, form: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs' bytes end to end, and their bounds."""
    moved = form != PLAIN
    outs = np.concatenate([[0], np.cumsum(np.diff(bounds) + np.where(moved, 3 * MARK, 0))])
    out = np.empty(int(outs[-1]), np.uint8)
    for low, high, place in shift_slices(*shifts(bounds, outs, form, first, second), len(data)):
        out[place] = data[low:high]
    begin, end = outs[:-1], outs[1:]
    spans = {PREFIX: first - bounds[:-1], MIDDLE: second - first, SUFFIX: bounds[1:] - second}
    psm = form == PSM
    places = {
        PREFIX: np.where(psm, begin, begin + MARK + spans[SUFFIX]),
        SUFFIX: np.where(psm, begin + MARK + spans[PREFIX], begin),
        MIDDLE: end - spans[MIDDLE] - MARK,
    }
    for mark, at in places.items():
        out[at[moved][:, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    return out, outs


def gather(out: np.ndarray, outs: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of which these are the outputs: their bytes end to end, and the bounds.
    An output whose marks aren't those of its form raises."""
    moved = form != PLAIN
    at, letter = marks(out, outs)
    owner = np.searchsorted(outs, at, "right") - 1
    at, letter, owner = at[moved[owner]], letter[moved[owner]], owner[moved[owner]]
    found = np.full((len(form), 3), -1, np.int64)
    for k, mark in enumerate((PREFIX, SUFFIX, MIDDLE)):
        found[owner[letter == mark[1]], k] = at[letter == mark[1]]
    p, s, m = found.T
    psm, spm = form == PSM, form == SPM
    right = (psm & (p == outs[:-1]) & (s > p) & (m > s)) | (spm & (s == outs[:-1]) & (p > s) & (m > p)) | ~moved
    if not right.all() or len(at) != 3 * moved.sum():
        raise ValueError("an output doesn't have the marks of its form")
    sizes = np.diff(outs) - np.where(moved, 3 * MARK, 0)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    prefix = np.where(moved, np.where(psm, s, m) - p - MARK, 0)
    middle = np.where(moved, outs[1:] - m - MARK, 0)
    first = bounds[:-1] + prefix
    data = np.empty(int(bounds[-1]), np.uint8)
    for low, high, place in shift_slices(*shifts(bounds, outs, form, first, first + middle), len(data)):
        data[low:high] = out[place]
    return data, bounds


def cut(data: np.ndarray, bounds: np.ndarray, draws: np.ndarray, rate: int, spm: int) -> tuple[np.ndarray, ...]:
    """Units, form, and ends of prefix and middle of each text. ``draws``: four whole numbers for each."""
    ends = unit_ends(data, bounds)
    cuts = np.searchsorted(ends, bounds, "right")  # of each text's units among all
    n = np.diff(cuts)
    marked = np.zeros(len(n), bool)
    marked[np.searchsorted(bounds, marks(data, bounds)[0], "right") - 1] = True
    plain = (n == 0) | marked | (draws[:, 2] % 100 >= rate)
    form = np.where(plain, PLAIN, np.where(draws[:, 3] % 100 < spm, SPM, PSM))
    a, b = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1).T
    edges = np.concatenate([ends, [0]])  # the last one stands in where a text has no unit
    after = lambda k: np.where(k == 0, bounds[:-1], edges[np.where(k == 0, -1, cuts[:-1] + k - 1)])
    return n, form, after(a), after(b)


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, seed: int = 42, rate: int = 50, spm: int = 80
) -> DataFrame:
    """``docs`` (its columns ``keep``, by default all but the text) with n (units), form, prefix_chars
    and middle_chars (code points; null if plain) and output. Of a hundred texts about ``rate`` are
    rearranged, and of a hundred of those ``spm`` begin with the suffix; which ones, and where they are
    cut, is decided by the SHA-256 of ``seed:id``."""
    names = [c for c in docs.columns if c != text] if keep is None else keep
    inner = [f"__{i}" for i in range(len(names))]
    word = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))

    def change(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = batch.column("hash").to_pylist()
        every = np.array([[int(h[i : i + 8], 16) for i in (0, 8, 16, 24)] for h in hashes], np.int64)
        texts = batch.column("text")
        sizes = texts.cast(pa.large_binary()).fill_null(b"")
        for low, high in ranges((len(x) for x in (s.as_buffer() for s in sizes)), TOGETHER):
            data, bounds = laid(texts.slice(low, high - low))
            n, form, first, second = cut(data, bounds, every[low:high], rate, spm)
            signs = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
            plain = form == PLAIN
            part = batch.slice(low, high - low)
            columns = [
                pa.array(n),
                pa.array([FORMS[f] for f in form.tolist()]),
                pa.array(signs[first] - signs[bounds[:-1]], mask=plain),
                pa.array(signs[second] - signs[first], mask=plain),
                strings(*scatter(data, bounds, form, first, second)),
            ]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in inner), *columns], names=[*inner, "n", "form", "prefix_chars", "middle_chars", "output"])

    own = [F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)]
    found = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()), StructField("output", StringType())]
    schema = StructType([*(StructField(i, docs.schema[c].dataType) for c, i in zip(names, inner)), *found])
    made = in_batches(docs.select(*own, F.sha2(word.cast("binary"), 256).alias("hash"), F.col(f"`{text}`").cast("string").alias("text")), change, schema)
    return made.toDF(*names, *(f.name for f in found))


def restore_middle(docs: DataFrame, form: str = "form", output: str = "output", keep: list[str] | None = None, out: str = "text") -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with the text that an output was made from.
    A null output counts as empty; an output that doesn't have the marks of its form, or an unknown
    form, fails the job."""
    names = docs.columns if keep is None else keep
    inner = [f"__{i}" for i in range(len(names))]

    def undo(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        outputs = batch.column("output")
        kinds = np.array([FORMS.index(f) for f in batch.column("form").to_pylist()], np.int64)
        sizes = outputs.cast(pa.large_binary()).fill_null(b"")
        for low, high in ranges((len(x) for x in (s.as_buffer() for s in sizes)), TOGETHER):
            part = batch.slice(low, high - low)
            texts = strings(*gather(*laid(outputs.slice(low, high - low)), kinds[low:high]))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in inner), texts], names=[*inner, "text"])

    own = [F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)]
    schema = StructType([*(StructField(i, docs.schema[c].dataType) for c, i in zip(names, inner)), StructField("text", StringType())])
    made = in_batches(docs.select(*own, F.col(f"`{form}`").alias("form"), F.col(f"`{output}`").cast("string").alias("output")), undo, schema)
    return made.toDF(*names, out)
