"""Near-duplicate vectors by spherical-cap filters with structured random product codes.

A filter is a direction that is the sum of one codeword for each half of a
randomly rotated vector, so ``codewords ** 2`` directions are made of two
small codes. A vector passes the filters whose direction it exceeds a
threshold on; list decoding finds them by taking each codeword of the first
half with the codewords of the second half that still reach the threshold.
Vectors that pass a common filter are compared exactly (cosine in double
precision). ``ROTATIONS`` independent codes make the filters' misses rare. The
codewords grow with the square root of the rows, so that a filter holds about
``HELD`` vectors at any size and the compared pairs grow with the rows, not
with their square (a large cluster of near copies apart: its links are counted).

Equal vectors are one node from the start, with their number. ``TOGETHER``
consecutive filters are compared in one place, so a vector travels once for those of
them that it passes. A place with many vectors is split into blocks of ``BLOCK`` by
``BLOCK``, dealt over tasks. A block passes on, for each vector, how many
others it links (each link is counted at the first filter that both vectors
pass) and edges to its components' smallest nodes in the block, never the pairs.

Edge cases: vectors that are null, zero or hold null or non-finite components
link with nothing (one row each, 0 links, a component of their own); repeated
rows are vectors that link; vectors of different lengths don't link; null ids
count as largest; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeframe.llm.common import connected, in_batches, prepare, stored
from placeframe.llm.vectors import matrices, matrix, usable

COSINE = 0.9
ROTATIONS = 2
#: Vectors that a filter holds, about, and the fewest codewords of a code.
HELD, FEWEST = 48, 16
#: Filters of a code that a vector passes, about.
PASSED = 42
#: How far below its best filter a vector still passes filters, in standard deviations.
MARGIN = 0.5
SEED = 3
#: Filters that are compared in one place.
TOGETHER = 64
BLOCK = 4096


class Code:
    """The filters of one rotation for vectors of a length."""

    def __init__(self, length: int, rotation: int, codewords: int):
        r = np.random.default_rng([SEED, rotation, length])
        self.codewords, self.half = codewords, max(1, length // 2)
        self.turn = np.linalg.qr(r.standard_normal((length, length)))[0]
        self.codes = []
        for size in (self.half, max(1, length - self.half)):
            c = r.standard_normal((codewords, size))
            self.codes.append(c / np.linalg.norm(c, axis=1, keepdims=True))
        # the sum of two unit codewords, on a random unit vector, varies by this
        spread = np.sqrt(2 / max(2, length))
        self.least, self.margin = NormalDist().inv_cdf(1 - min(0.5, PASSED / codewords**2)) * spread, MARGIN * spread

    def decode(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that each row's direction exceeds, by row and filter."""
        v = (m / np.linalg.norm(m, axis=1, keepdims=True)) @ self.turn
        first = v[:, : self.half] @ self.codes[0].T
        rest = v[:, self.half :] if v.shape[1] > self.half else np.zeros((len(v), self.codes[1].shape[1]))
        second = rest @ self.codes[1].T
        # a vector that exceeds few filters or none still passes those near its best
        best = second.max(axis=1, keepdims=True)
        least = np.minimum(self.least, first.max(axis=1, keepdims=True) + best - self.margin)
        rows, a = np.nonzero(first >= least - best)
        need = least[rows, 0] - first[rows, a]
        rows_out, filters = [], []
        for low in range(0, len(rows), 65_536):
            part = slice(low, low + 65_536)
            k, b = np.nonzero(second[rows[part]] >= need[part, None])
            rows_out.append(rows[part][k])
            filters.append(a[part][k] * self.codewords + b)
        return (np.concatenate(rows_out), np.concatenate(filters)) if rows_out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@cache
def code(length: int, rotation: int, codewords: int) -> Code:
    return Code(length, rotation, codewords)


def decoded(m: np.ndarray, codewords: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) over all the rotations; a rotation's filters follow those of the ones before."""
    found = [code(m.shape[1], r, codewords).decode(m) for r in range(ROTATIONS)]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] + r * codewords**2 for r, f in enumerate(found)])


def codewords_for(rows: int) -> int:
    return max(FEWEST, ceil(sqrt(PASSED * rows / HELD)))


def filters(nodes: DataFrame, codewords: int) -> DataFrame:
    """(v, length, f, node, n, x) for each place that a node has filters in; ``f`` are those filters."""
    kind = nodes.schema["x"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for own, m in matrices(batch.column("x")):
            for low in range(0, len(own), 512):
                rows, f = decoded(m[low : low + 512], codewords)
                order = np.lexsort((f, rows))
                rows, f = rows[order], f[order]
                first = np.flatnonzero(np.diff(rows, prepend=-1) | np.diff(f // TOGETHER, prepend=-1))
                took = batch.take(pa.array(own[low : low + 512][rows[first]]))
                passed = pa.ListArray.from_arrays(pa.array(np.append(first, len(f)), pa.int32()), pa.array(f.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[first].astype(np.int64) // TOGETHER), pa.array(np.full(len(first), m.shape[1], np.int32)), passed, took.column("node"), took.column("n"), took.column("x")],
                    names=["v", "length", "f", "node", "n", "x"],
                )

    return in_batches(nodes.select("node", "n", "x"), run, f"v long, length int, f array<long>, node long, n long, x {kind}")


def components(near: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component of a symmetric matrix of links."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(label)).min(axis=1))
        if (new == label).all():
            return label
        label = new


def block_links(block: pa.Table, least: float, codewords: int) -> pa.Table:
    """Links between rows of a block that pass a common filter: for each linked node the
    rows it links (counted at the pair's first filter), with the smallest node of its
    component in a filter. ``side`` splits the block: 0 and 1 are two parts of which
    only pairs across count; 2 marks a block of all pairs."""
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])
    block = block.sort_by("node")
    x = matrix(block.column("x"))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    side, nodes, number = (block.column(c).to_numpy() for c in ("side", "node", "n"))
    split = (side != 2).any()
    passed = block.column("f").combine_chunks()
    owner, f = np.repeat(np.arange(len(x)), np.diff(passed.offsets.to_numpy())), passed.flatten().to_numpy()
    order = np.lexsort((owner, f))
    owner, f = owner[order], f[order]
    known: dict[int, np.ndarray] = {}  # the filters of rows that link
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ends = np.flatnonzero(np.diff(f, append=-1)) + 1
    for low, high in zip(np.append(0, ends[:-1]), ends):
        if high - low < 2:
            continue
        held = owner[low:high]
        near = unit[held] @ unit[held].T >= least
        np.fill_diagonal(near, False)
        if split:
            near &= side[held][:, None] != side[held][None, :]
        linked = np.flatnonzero(near.any(axis=1))
        if not len(linked):
            continue
        near, held = near[np.ix_(linked, linked)], held[linked]
        new = np.array([r for r in held.tolist() if r not in known], np.int64)
        if len(new):
            rows, all_f = decoded(x[new], codewords)
            by_row = np.argsort(rows, kind="stable")
            known.update(zip(new.tolist(), np.split(all_f[by_row], np.cumsum(np.bincount(rows, minlength=len(new)))[:-1])))
        earlier = [known[r][known[r] < f[low]] for r in held.tolist()]
        _, column = np.unique(np.concatenate(earlier), return_inverse=True)
        member = np.zeros((len(held), int(column.max()) + 1 if len(column) else 1), np.float32)
        member[np.repeat(np.arange(len(held)), [len(e) for e in earlier]), column] = 1
        here = near & (member @ member.T == 0)  # pairs that pass no earlier filter together
        out.append((nodes[held], nodes[held][components(near)], here @ number[held]))
    if not out:
        return schema.empty_table()
    found = pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)
    return found.group_by(["node", "root"]).aggregate([("links", "sum")]).rename_columns(["node", "root", "links"]).cast(schema)


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = COSINE, codewords: int | None = None, tag: str = "caps") -> DataFrame:
    """(key, n_links, component_id, kept) of each row. Without given ``codewords`` their number follows from the rows."""
    prepare(df.sparkSession)
    rows = df.select(df[key].cast("long").alias("id"), df[vector].alias("x")).withColumn("ok", usable(F.col("x")))
    rows = rows.withColumn("h", F.when(F.col("ok"), F.md5(F.array_join(F.col("x").cast("array<string>"), ",").cast("binary"))))
    good = rows.filter("ok").select("id", "h", "x")
    nodes = good.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"), F.first("x").alias("x"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), f"{tag}-nodes")  # numbers are fixed once written
    words = codewords or codewords_for(nodes.count())
    passed = stored(filters(nodes, words), f"{tag}-filters")
    # places that one block can't hold; few, and written, so broadcast if small
    parts = F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts")
    large = stored(passed.groupBy("v", "length").agg(parts).filter("parts > 1"), f"{tag}-large")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = (
        passed.join(large, ["v", "length"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("side", F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1))
        .select("v", "length", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "f", "node", "n", "x", "side")
    )

    def links(block: pa.Table) -> pa.Table:
        return block_links(block, least, words)

    found = stored(dealt.groupBy("v", "length", "i", "j").applyInArrow(links, "node long, root long, links long"), f"{tag}-links")
    label = connected(found, "node", "root", tag)
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    # sides with one row for each key are written: broadcast if small, else a large key's rows are split
    full = (
        nodes.select("node", "h", "n", "id")
        .join(count, "node", "left")
        .join(label, "node", "left")
        .select("h", "id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    full = stored(full, f"{tag}-full")
    named = stored(full.groupBy("root").agg(F.min("id").alias("component_id")), f"{tag}-named")
    known = stored(full.join(named, "root").select("h", "n_links", "component_id"), f"{tag}-known")
    linked = good.select("id", "h").join(known, "h").select("id", "n_links", "component_id")
    alone = rows.filter(~F.col("ok")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
