"""Sharding and mixing."""

import math
import struct
import zlib
from collections import Counter, defaultdict
from itertools import cycle

import pytest
import xxhash
from llm_helpers import documents
from pyspark.sql import functions as F

from placeframe.llm import mixing
from placeframe.llm.mixing import derived_weights, mix_sources, mixed, period_schedule
from placeframe.llm.numbering import numbered
from placeframe.llm.sharding import ROUNDS, permuted, shard_documents, shard_rows, sides


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1023, 5000])
def test_permutation(spark, n):
    got = [r.p for r in spark.range(n).select(permuted(F.col("id"), n, 5).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    if n > 50:
        assert got != sorted(got)


def walked(x, n, seed):
    """The Feistel network and its walk, one number at a time."""
    a, b = sides(n)

    def mixed_with(side, i, below):
        h = 42
        for raw in (struct.pack("<q", side), struct.pack("<i", i), struct.pack("<i", seed)):
            h = xxhash.xxh64_intdigest(raw, seed=h)
        return (h - (1 << 64) if h >> 63 else h) % below

    while True:
        left, right = divmod(x, b)
        for i in range(ROUNDS):
            if i % 2:
                right = (right + mixed_with(left, i, b)) % b
            else:
                left = (left + mixed_with(right, i, a)) % a
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [7, 997, 3001])
def test_permutation_is_the_plain_walk(spark, n):
    got = {r.id: r.p for r in spark.range(n).select("id", permuted(F.col("id"), n, 5).alias("p")).collect()}
    assert got == {x: walked(x, n, 5) for x in range(n)}


def test_numbers_within_groups_with_a_hot_key(spark):
    rows = spark.range(900).select((F.col("id") % 3 == 0).alias("hot"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("__part2"))
    got = numbered(rows, ["k"], "t", group=["hot"]).collect()
    for hot in (True, False):
        own = [r for r in got if r.hot == hot]
        assert sorted(r["__n"] for r in own) == list(range(len(own)))
        ordered = [r.k for r in sorted(own, key=lambda r: r["__n"])]
        assert ordered == sorted(ordered)


def test_shards(spark):
    docs = documents(spark)
    rows = shard_documents(docs, shards=4).collect()
    n = docs.count()
    assert len(rows) == n
    counts = Counter(r.shard for r in rows)
    assert set(counts) == {0, 1, 2, 3} and max(counts.values()) - min(counts.values()) <= 1
    for shard, size in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            raw = (texts[r.doc_id] or "").encode()
            assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    again = shard_documents(docs.repartition(5), shards=4).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    whole = shard_rows(docs, ["doc_id"], 4)
    assert whole.columns[: len(docs.columns)] == docs.columns and whole.count() == n
    assert shard_documents(docs.limit(0)).collect() == []


def test_period_keeps_every_source_within_a_block():
    for weights in ([1], [1, 1], [3, 5, 2], [700, 1, 99, 200], [1] * 20, [13, 7, 5, 1, 1]):
        period = sum(weights)
        schedule = list(period_schedule(weights))
        assert [x[2] for x in schedule] == list(range(period))
        placed = [0] * len(weights)
        for i, j, slot, release, deadline in schedule:
            assert j == placed[i] and release <= slot < deadline
            placed[i] += 1
            for k, w in enumerate(weights):
                assert abs(placed[k] - (slot + 1) * w / period) < 1
        assert placed == weights


def test_mixture(spark):
    rows = [(i, "x" * (i % 5), "en", "hot" if i % 3 == 0 else f"s{i % 7}", i) for i in range(1000, 1600)]
    docs = documents(spark, rows)
    n = docs.count()
    got = mix_sources(docs, block=4).collect()
    seen = Counter((r.doc_id, r.source, r["__epoch"]) for r in got)
    assert {k[0] for k in seen} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert sum(1 for r in got if r["__epoch"] == 0) == n  # every row once before any again
    slots = defaultdict(set)
    for r in got:
        slots[r["__slot"]].add((r.source or "", r["__block"], r["__epoch"]))
        assert r["__release"] <= r["__slot"] < r["__deadline"]
    assert sorted(slots) == list(range(len(slots))) and all(len(s) == 1 for s in slots.values())
    sizes = Counter(r.source or "" for r in docs.select("source").collect())
    weights = derived_weights(dict(sizes), block=4)
    period, placed = sum(weights.values()), Counter()
    for slot in range(len(slots)):
        placed[next(iter(slots[slot]))[0]] += 1
        assert all(abs(placed[s] - (slot + 1) * w / period) < 1 for s, w in weights.items())
    out = mixed(docs, block=4)
    assert out.columns == docs.columns and out.count() == len(got)
    given = mix_sources(docs, {s: 1 for s in sizes}, block=4)
    assert given.filter("__epoch = 0").count() == n
    with pytest.raises(ValueError):
        mix_sources(docs, {s: 0 for s in sizes})
    assert mix_sources(docs.limit(0)).collect() == [] and mixed(docs.limit(0)).collect() == []


def test_a_tiny_source_has_its_real_share(spark, monkeypatch):
    for many in (200_000, 2_000_000, 20_000_000):
        blocks = many / 16
        weights = derived_weights({"tiny": 1, "big": many})
        assert weights["tiny"] == 1 and abs(weights["big"] - blocks**0.9) <= 1
        assert blocks / weights["big"] < 5  # times that the tiny one is placed
    assert derived_weights({"tiny": 1, "big": 10**12}) == {"tiny": 1, "big": mixing.MOST_SLOTS}
    docs = spark.range(30_001).selectExpr("id AS doc_id", "'t' AS text", "if(id = 77, 'tiny', 'big') AS source")
    got = mix_sources(docs, block=1)
    first = Counter(map(str, got.collect()))
    weights, placed = derived_weights({"big": 30_000, "tiny": 1}, block=1), Counter()
    for i, *_ in cycle(list(period_schedule(list(weights.values())))):
        placed[i] += 1
        if placed[0] >= 30_000 and placed[1]:
            break
    assert got.filter("source = 'tiny'").count() == placed[1] < 5 and math.gcd(*weights.values()) == 1
    assert got.filter("source = 'big' AND __epoch = 0").count() == 30_000 and got.filter("__slot < __release OR __slot >= __deadline").isEmpty()
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 10)  # the period is written and joined
    assert Counter(map(str, mix_sources(docs, block=1).collect())) == first


def test_bounds_of_the_mixture(spark, monkeypatch):
    docs = documents(spark)
    named = {r[0] or "" for r in docs.select("source").distinct().collect()}
    alike = [sorted(map(str, mix_sources(docs, {s: w for s in named}).collect())) for w in (1, 10**9)]
    assert alike[0] == alike[1]  # only the ratio counts
    with pytest.raises(ValueError, match="sum"):
        mix_sources(docs, {s: 10**9 + k for k, s in enumerate(sorted(named))})
    monkeypatch.setattr(mixing, "MOST_SOURCES", 1)
    with pytest.raises(ValueError, match="sources"):
        mix_sources(docs)
