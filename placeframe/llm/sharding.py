"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered in the order of a key; a keyed permutation of the numbers
shuffles them; position ``p`` lies in shard ``p mod shards`` at slot ``p div
shards``. So the shuffle is the same each time, shard and slot follow from the
number alone, and the shards' row counts differ by one at most, however rows
are distributed over keys, sources or copies.

The permutation is a Feistel network over pairs (left, right) of ranges whose
product is just above the row count; a value that falls outside goes through
the network again until it falls inside (at most as often as there are values
outside). Everything is DataFrame expressions.

Edge cases: a null text has size 16 and the checksum of the empty text; null
keys come first; rows that tie in the key go by a hash of the row; equal rows
are interchangeable; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeframe.llm.common import stored
from placeframe.llm.numbering import numbered

SHARDS = 40
SEED = 20_240_607
ROUNDS = 6
#: Walks that every row's expression has; the rare rows that need more go on in a branch of their own.
WALKS = 12


def sides(n: int) -> tuple[int, int]:
    """Two ranges whose product is at least ``n``, by less than the first."""
    a = max(1, isqrt(n))
    return a, max(1, -(-n // a))


def network(value: Column, n: int, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass of the Feistel network: a permutation of the numbers below the product of the sides."""
    a, b = sides(n)

    def turn(pair: Column, i: Column) -> Column:
        left, right = pair["l"], pair["r"]
        return F.when(i % 2 == 0, F.struct(((left + F.pmod(F.xxhash64(right, i, F.lit(seed)), F.lit(a))) % a).alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), ((right + F.pmod(F.xxhash64(left, i, F.lit(seed)), F.lit(b))) % b).alias("r"))
        )

    first = F.struct(F.call_function("div", value, F.lit(b).cast("long")).alias("l"), (value % b).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), first, turn, lambda p: p["l"] * b + p["r"])


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """The position below ``n`` of each row number below ``n``."""
    a, b = sides(n)
    outside = a * b - n

    def walk(value: Column, times: int) -> Column:
        if not times:
            return value
        return F.aggregate(F.sequence(F.lit(1), F.lit(times)), value, lambda v, _: F.when(v < n, v).otherwise(network(v, n, seed)))

    near = walk(network(number, n, seed), min(outside, WALKS))
    if outside <= WALKS:
        return near
    return F.aggregate(F.array(near), F.lit(0).cast("long"), lambda _, v: F.when(v < n, v).otherwise(walk(v, outside)))


def shard_rows(df: DataFrame, order: Sequence[str], shards: int = SHARDS, seed: int = SEED, tag: str = "shard") -> DataFrame:
    """``df`` with ``__position``, ``__shard`` and ``__slot`` of each row."""
    if shards < 1:
        raise ValueError("shards must be positive")
    rows = stored(df, f"{tag}-rows")  # so that what df computes is computed once
    n = rows.count()
    placed = numbered(rows, order, tag).withColumn("__position", permuted(F.col("__n"), max(1, n), seed)).drop("__n")
    return placed.withColumn("__shard", (F.col("__position") % shards).cast("int")).withColumn("__slot", F.expr(f"__position div {shards}"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Size, checksum, shard and slot of each document, under the law ``rows``."""
    raw = F.coalesce(docs[text].cast("binary"), F.lit("").cast("binary"))
    thin = docs.select(docs[key].alias("key"), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = shard_rows(thin, ["key", "text_crc32", "size"], shards, seed)
    return placed.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("__shard").alias("shard"),
        F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
