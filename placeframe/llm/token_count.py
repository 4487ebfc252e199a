"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a piece form a linked list; a heap holds the adjacent pairs by
rank. The lowest is popped again and again, checked against the list (a
neighbour may have been merged since) and merged. The count is the number of
bytes minus the number of merges; no identifiers are made.

Edge cases: a null or empty text has 0 tokens; a special string inside a text
is one token; repeated rows and null ids are counted row by row; an empty
table gives an empty table. Texts of any length are counted whole: long ones
are cut where a piece begins in any case.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from placeframe.llm.common import carried, in_batches, text_batches
from placeframe.llm.pieces import Vocabulary, distinct_pieces, parse_vocabulary, parts_of

#: Counts of distinct pieces that a task's worker keeps; when full it starts anew.
CACHED = 400_000


def merge_count(piece: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """How many merges byte-pair merging makes in a piece."""
    n = len(piece)
    symbols: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue
        both = symbols[i] = left + right
        symbols[j] = None
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            rank = ranks.get((both, symbols[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, both, symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], both))
            if rank is not None:
                heapq.heappush(heap, (rank, h, symbols[h], both))
    return merges


class Counter:
    """Counts tokens of texts; keeps the counts of pieces it has met."""

    def __init__(self, vocabulary: Vocabulary, cached: int = CACHED):
        self.vocabulary, self.cached, self.known = vocabulary, cached, {}

    def piece(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            raw = piece.encode()
            n = len(raw) - merge_count(raw, self.vocabulary.ranks)
            if len(self.known) >= self.cached:
                self.known.clear()
            self.known[piece] = n
        return n

    def counts(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts = parts_of(texts, self.vocabulary.special)
        np.add.at(out, parts.owner[parts.special >= 0], 1)
        for low, high in text_batches(parts.texts):
            pieces, inverse, cuts = distinct_pieces(parts.texts[low:high])
            if pieces:
                each = np.fromiter(map(self.piece, pieces), np.int64, len(pieces))[inverse]
                total = np.concatenate([[0], np.cumsum(each)])
                np.add.at(out, parts.owner[low:high], total[cuts[1:]] - total[cuts[:-1]])
        return out


@lru_cache(maxsize=2)
def _counter(raw: bytes) -> Counter:
    return Counter(parse_vocabulary(raw))


def count_tokens(docs: DataFrame, vocabulary_path: str, text: str = "text", out: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with the number of tokens of
    each whole text in the column ``out``."""
    names = docs.columns if keep is None else keep
    rows, inner, fields = carried(docs, names, __text=text)
    with open(vocabulary_path, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: some MB

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = _counter(raw.value).counts(batch.column("__text").to_pylist())
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in inner), pa.array(counts)], names=[*inner, "__out"])

    return in_batches(rows, count, StructType([*fields, StructField("__out", LongType())])).toDF(*names, out)
