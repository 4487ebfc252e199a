"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

A polytope's hash of a vector is the signed axis nearest to it after a fast
pseudo-rotation (three rounds of random signs and a Hadamard transform). A
table's bucket combines several polytopes, the last one over few dimensions,
as many as give about ``FINENESS`` buckets for each row of the input, so a
bucket holds few rows at any size. Every row is indexed in one bucket of each
of ``TABLES`` tables. A query probes the buckets whose axes together lie
nearest to it (by the sum of the squared gaps to its best axes);
their number grows with the rows to the power ``GROWTH``. The rows found are
ranked by their exact Euclidean distance on the original vectors in double
precision.

A group of ``GROUP`` consecutive buckets of a table (some thousand rows) is
compared in one place, so a query travels once for each group that it probes. Groups
are compared in blocks (``BASE_BLOCK`` rows with ``QUERY_BLOCK`` queries), so
a bucket with a third of all rows is dealt over many tasks; each block passes
on its best rows for each query only. A query for which the tables give fewer
rows than asked for is compared with all rows, in blocks.

Edge cases: vectors that are null, zero or hold null or non-finite components
take no part; rows equal in id and vector count once; equal distances go to
the smaller id; a query is compared with vectors of its own length; null ids
are no queries; query rows that share an id are one query, whose nearest rows
are those nearest to any of its vectors; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeframe.llm.common import in_batches, prepare, ranges, stored
from placeframe.llm.vectors import matrices, matrix, usable

TABLES = 16
#: Buckets of a table for each row of the input, about.
FINENESS = 2
#: Buckets of a table that a query probes: for 500 rows, and the power of the rows that they grow with.
PROBES, GROWTH = 24, 0.65
NEIGHBOURS = 10
TURNS = 3
SEED = 11
#: Polytopes of a table at most.
PARTS = 16
#: Buckets that are compared together.
GROUP = 8192
BASE_BLOCK, QUERY_BLOCK = 8192, 1024
#: Pairs and numbers that are held at once while candidates are compared or probes chosen.
PAIRS, NUMBERS = 1 << 16, 1 << 22


@cache
def signs(table: int, size: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, size]).choice([-1.0, 1.0], (TURNS, size))


def hadamard(m: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of each row, scaled to keep lengths."""
    n, size = m.shape
    step = 1
    while step < size:
        m = m.reshape(n, -1, 2, step)
        m = np.stack([m[:, :, 0] + m[:, :, 1], m[:, :, 0] - m[:, :, 1]], axis=2)
        step *= 2
    return m.reshape(n, size) / np.sqrt(size)


def rotated(m: np.ndarray, table: int) -> np.ndarray:
    """The pseudo-rotation of a table, of the rows' directions padded to a power of two."""
    size = 1 << max(1, (m.shape[1] - 1).bit_length())
    out = np.zeros((len(m), size))
    out[:, : m.shape[1]] = m / np.linalg.norm(m, axis=1, keepdims=True)
    for s in signs(table, size):
        out = hadamard(out * s)
    return out


def polytopes(rows: int, size: int) -> list[int]:
    """The dimensions of each polytope of a table for so many rows of (padded) length ``size``."""
    dims, buckets = [size], 2 * size
    while buckets * 4 <= FINENESS * rows and len(dims) < PARTS:
        more = FINENESS * rows // buckets  # 2 signed axes a dimension
        dims.append(min(size, 1 << (more // 2).bit_length() - 1))
        buckets *= 2 * dims[-1]
    return dims


def probe_count(rows: int) -> int:
    return ceil(PROBES * max(1.0, rows / 500) ** GROWTH)


def _parts(m: np.ndarray, table: int, rows: int) -> Iterator[np.ndarray]:
    size = 1 << max(1, (m.shape[1] - 1).bit_length())
    for i, dims in enumerate(polytopes(rows, size)):
        yield rotated(m, table * PARTS + i)[:, :dims]


def buckets(m: np.ndarray, table: int, rows: int) -> np.ndarray:
    """The bucket of each vector: its nearest signed axis (2 * axis, plus 1 if positive) in each polytope."""
    out = np.zeros(len(m), np.int64)
    for r in _parts(m, table, rows):
        axis = np.abs(r).argmax(axis=1)
        out = out * (2 * r.shape[1]) + 2 * axis + (np.take_along_axis(r, axis[:, None], axis=1)[:, 0] > 0)
    return out


def probes(m: np.ndarray, table: int, rows: int, count: int) -> np.ndarray:
    """The ``count`` buckets nearest to each vector (all, if fewer). The best of some
    polytopes' combinations are among the best of each part's, so parts are added one by one."""
    best, gap = np.zeros((len(m), 1), np.int64), np.zeros((len(m), 1))
    for r in _parts(m, table, rows):
        signed = np.stack([-r, r], axis=2).reshape(len(m), -1)
        own = (signed.max(axis=1, keepdims=True) - signed) ** 2
        axes = own.shape[1]
        gap = (gap[:, :, None] + own[:, None, :]).reshape(len(m), -1)
        best = (best[:, :, None] * axes + np.arange(axes)).reshape(len(m), -1)
        if gap.shape[1] > count:
            took = np.argpartition(gap, count - 1, axis=1)[:, :count]
            gap, best = np.take_along_axis(gap, took, axis=1), np.take_along_axis(best, took, axis=1)
    return best


def indexed(base: DataFrame, rows: int, tables: int) -> DataFrame:
    """(t, v, length, b, id, x) for each row and table; ``v`` is the group of the bucket ``b``."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for own, m in matrices(batch.column("x")):
            took = batch.take(pa.array(own))
            for t in range(tables):
                b = buckets(m, t, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), t, np.int32)), pa.array(b // GROUP), pa.array(np.full(len(own), m.shape[1], np.int32)), pa.array(b), took.column("id"), took.column("x")],
                    names=["t", "v", "length", "b", "id", "x"],
                )

    return in_batches(base, run, "t int, v long, length int, b long, id long, x array<double>")


def probing(queries: DataFrame, rows: int, tables: int, count: int) -> DataFrame:
    """(t, v, length, b, id, x) for each query, table and group that it probes; ``b`` are the buckets there."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for own, m in matrices(batch.column("x")):
            step = max(1, NUMBERS // (4 * count * m.shape[1]))
            for t in range(tables):
                for low in range(0, len(own), step):
                    b = np.sort(probes(m[low : low + step], t, rows, count), axis=1)
                    new = np.ones(b.shape, bool)
                    new[:, 1:] = b[:, 1:] // GROUP != b[:, :-1] // GROUP
                    first = np.flatnonzero(new.ravel())
                    took = batch.take(pa.array(own[low + first // b.shape[1]]))
                    lists_of = pa.ListArray.from_arrays(pa.array(np.append(first, b.size), pa.int32()), pa.array(b.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), t, np.int32)), pa.array(b.ravel()[first] // GROUP), pa.array(np.full(len(first), m.shape[1], np.int32)), lists_of, took.column("id"), took.column("x")],
                        names=["t", "v", "length", "b", "id", "x"],
                    )

    return in_batches(queries, run, "t int, v long, length int, b array<long>, id long, x array<double>")


def nearest(queries: pa.Table, base: pa.Table, count: int) -> pa.Table:
    """The nearest ``count`` base rows in the buckets that each query probes, by exact distance."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not queries.num_rows or not base.num_rows:
        return schema.empty_table()
    base = base.sort_by("b")
    q, x, b = matrix(queries.column("x")), matrix(base.column("x")), base.column("b").to_numpy()
    qid = queries.column("id").to_numpy()
    known = base.column("id").is_valid().to_numpy()
    ids = base.column("id").fill_null(0).to_numpy()
    probed = queries.column("b").combine_chunks()
    owner = np.repeat(np.arange(len(q)), np.diff(probed.offsets.to_numpy()))
    wanted = probed.flatten().to_numpy()
    first, n = np.searchsorted(b, wanted), np.searchsorted(b, wanted, side="right")
    n -= first
    found = []
    # a query's pairs lie together
    for low, high in ranges(np.bincount(owner, n, len(q)).astype(np.int64).tolist(), PAIRS):
        part = slice(*np.searchsorted(owner, [low, high]))
        size = n[part]
        whose = np.repeat(owner[part], size)
        row = np.arange(len(whose)) + np.repeat(first[part] - np.cumsum(size) + size, size)
        d = np.sqrt(((x[row] - q[whose]) ** 2).sum(axis=1))
        d[known[row] & (ids[row] == qid[whose])] = np.inf
        order = np.lexsort((ids[row], ~known[row], d, whose))
        start = np.searchsorted(whose[order], np.arange(low, high))
        place = np.arange(len(order)) - start[whose[order] - low]
        took = order[(place < count) & np.isfinite(d[order])]
        found.append((qid[whose[took]], row[took], d[took]))
    who, row, d = (np.concatenate(c) for c in zip(*found))
    return pa.table([pa.array(who), base.column("id").take(pa.array(row)), pa.array(d)], schema=schema)


def _blocked(queries: DataFrame, base: DataFrame, count: int) -> DataFrame:
    """Candidates of queries and base rows that share a group, compared block by block."""
    at = ["t", "v", "length"]
    n_base = base.groupBy(*at).agg(F.count(F.lit(1)).alias("nb"))
    n_query = queries.groupBy(*at).agg(F.count(F.lit(1)).alias("nq"))
    # written: broadcast if it is small (a row for each group that is probed), else the rows are split by size
    blocks = stored(
        n_base.join(n_query, at).select(*at, F.ceil(F.col("nb") / BASE_BLOCK).alias("cb"), F.ceil(F.col("nq") / QUERY_BLOCK).alias("cq")), "ann-blocks"
    )
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id", "x"), F.col(n))
    left = queries.join(blocks, at).select(*at, own("cq").alias("j"), every("cb").alias("i"), "b", "id", "x")
    right = base.join(blocks, at).select(*at, every("cq").alias("j"), own("cb").alias("i"), "b", "id", "x")
    by = [*at, "i", "j"]
    prepare(base.sparkSession)
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(lambda a, b: nearest(a, b, count), "query_id long, vec_id long, score double")


def _best(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", F.col("vec_id").asc_nulls_last())
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", count: int = NEIGHBOURS, tables: int = TABLES, probed: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found of each row that
    ``is_query`` (of the column ``id``) holds for."""
    spark = prepare(df.sparkSession)
    rows = stored(
        df.filter(usable(df[vector])).select(df[key].cast("long").alias("id"), df[vector].cast("array<double>").alias("x")).distinct(), "ann-rows"
    )
    queries = stored(rows.filter(F.col("id").isNotNull() & is_query), "ann-queries")
    n_rows = rows.count()
    probes_of = stored(probing(queries, n_rows, tables, probed or probe_count(n_rows)), "ann-probes")
    found = stored(_best(_blocked(probes_of, stored(indexed(rows, n_rows, tables), "ann-index"), count), count), "ann-found")
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)
    few = stored(queries.join(enough, F.col("id") == F.col("query_id"), "left_anti"), "ann-few")
    if not few.isEmpty():
        # the tables give too little for these: all rows, in blocks dealt by a hash
        n = max(1, -(-n_rows // BASE_BLOCK))
        length = F.size("x").cast("int").alias("length")
        dealt = rows.select(F.lit(0).alias("t"), F.pmod(F.xxhash64("id", "x"), F.lit(n)).alias("v"), length, F.lit(0).cast("long").alias("b"), "id", "x")
        asked = few.select(F.lit(0).alias("t"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("v"), length, F.array(F.lit(0).cast("long")).alias("b"), "id", "x")
        found = found.drop("rank").join(few.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").select("query_id", "vec_id", "score")
        found = _best(found.union(_blocked(asked, dealt, count)), count)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
