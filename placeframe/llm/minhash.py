"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its shingles of five words (runs of letters
or digits, without regard to case; a shorter document is one shingle). The
weight is ``(1 + ln tf) * (1 + IDF * idf)`` with idf from 0 (in every
document) to 1 (in one), in steps of 1/32. Idf has this small part on purpose:
with plain idf the shared text of a large group of copies weighs little just
because the copies are many, and their few edits would push them apart.
Document counts are kept in ``SLOTS`` hashed slots over all documents, so the
statistic has a fixed size however many shingles there are.

Each document gets consistent weighted samples: two documents have an equal
sample with the probability of their weighted Jaccard similarity. Documents
that agree in all samples of a band are in a bucket. Equal texts are one node
from the start. The members of a bucket are verified against its two leaders by
the exact weighted similarity. In buckets that then still hold several classes
the members outside the first leader's class are compared in blocks, by products of
the block's weight matrices, except blocks that the triangle inequality (1
minus the similarity is a metric) rules out by their distances to the leader.
A block passes on one link between two classes at most. So no pairs are listed
within a group of copies, and no link between candidates is lost. At a
similarity of 0.8 the bands miss 6 in 10,000 pairs, at 0.85 fewer than 1. A
class is a connected component of the links.

Edge cases: a text without a word (null and empty ones included) is a class of
its own, as is each row with one; null ids count as largest; repeated rows are
equal texts; an empty table gives an empty table. Very long texts are used
whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeframe.llm.common import connected, in_batches, prepare, ranges, stored, text_batches
from placeframe.llm.textblocks import lowered, mix, per_text, points, span_hashes, sums, words

SHINGLE = 5
SIMILARITY = 0.8
#: The most that idf adds to a weight.
IDF = 0.1
SLOTS = 1 << 18
#: Bands, and samples in each.
SHAPE = (14, 4)
#: Documents of each side of a block.
BLOCK = 512
STEPS = 32
#: Entries of the table of random draws (each of a gamma, a gamma and a uniform variable).
DRAWS_BITS = 15
SEED = 5


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text: hashes, counts, and bounds of each text's."""
    cps, bounds = points(texts)
    letters = lowered()[cps]
    starts, ends = words(cps, bounds, numbers=True)
    word = span_hashes(letters, starts, ends)
    cuts = per_text(starts, bounds)
    n = np.diff(cuts)
    many = np.maximum(n - SHINGLE + 1, np.minimum(n, 1))  # shingles of each text
    first = np.repeat(cuts[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
    stop = np.repeat(cuts[1:], many)
    total = np.zeros(len(first), np.uint64)
    padded = np.append(word, np.zeros(SHINGLE, np.uint64))
    factor = 1
    for k in range(SHINGLE):
        part = padded[first + k] * np.uint64(factor)
        part[first + k >= stop] = 0
        total += part
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    total = mix(total)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), many)
    _, at, count = np.unique(mix(total + owner * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    tf = np.zeros(len(total), np.int64)
    tf[at] = count
    once = tf > 0
    return total[once], tf[once], np.concatenate([[0], np.cumsum(sums(once.astype(np.int64), np.concatenate([[0], np.cumsum(many)])))])


def slot_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


@dataclass
class Weights:
    """Weights of shingles, in steps; ``idf`` has a value of 0 to 1 for each slot."""

    idf: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, documents: int) -> Weights:
        top = np.log(documents + 1.0) or 1.0
        return cls((np.clip(np.log((documents + 1.0) / (counts + 1.0)) / top, 0, 1)).astype(np.float32))

    def steps(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return np.rint(STEPS * (1 + np.log(tf)) * (1 + IDF * self.idf[slot_of(hashes)])).astype(np.int64)


@dataclass
class Sampler:
    """Consistent weighted samples. The draws of a shingle for a sample come from a
    table at a hashed place; what a draw gives for a weight is tabled by weight."""

    shape: tuple[int, int] = SHAPE  # bands and samples in each
    levels: dict[int, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 1 << DRAWS_BITS), np.uint64))

    def __post_init__(self):
        r = np.random.default_rng([SEED, *self.shape])
        n, samples = 1 << DRAWS_BITS, self.shape[0] * self.shape[1]
        self.r, self.log_c, self.beta = r.gamma(2.0, 1.0, n), np.log(r.gamma(2.0, 1.0, n)), r.random(n)
        self.flip = r.integers(0, 1 << 63, samples, dtype=np.uint64)
        self.odd = r.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def _rows(self, steps: np.ndarray) -> np.ndarray:
        found, index = np.unique(steps, return_inverse=True)
        fresh = [s for s in found.tolist() if s not in self.levels]
        if fresh:
            made = []
            for s in fresh:
                t = np.floor(np.log(s / STEPS) / self.r + self.beta)
                a = (self.log_c - self.r * (t - self.beta + 1)).astype(np.float32).view(np.uint32)
                ordered = np.where(a >> 31 == 1, ~a, a | np.uint32(1 << 31))
                self.levels[s] = len(self.table) + len(made)
                made.append(ordered.astype(np.uint64) << np.uint64(32))
            self.table = np.vstack([self.table, *made])
        return np.array([self.levels[s] for s in found.tolist()], np.uint64)[index] << np.uint64(DRAWS_BITS)

    def bands(self, hashes: np.ndarray, steps: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The band keys (texts, bands) of texts that all have a shingle."""
        count, rows = self.shape
        base = self._rows(steps)
        flat = self.table.ravel()
        low = hashes & np.uint64(0xFFFFFFFF)
        out = np.zeros((len(cuts) - 1, count), np.uint64)
        shift = np.uint64(64 - DRAWS_BITS)
        for k in range(count * rows):
            draw = (hashes ^ self.flip[k]) * self.odd[k]
            draw >>= shift
            draw += base
            value = flat[draw]
            value |= low
            sample = np.minimum.reduceat(value, cuts[:-1])
            out[:, k // rows] = out[:, k // rows] * np.uint64(0x9E3779B97F4A7C15) + mix(sample + np.uint64(k))
        return mix(out)


@lru_cache(maxsize=1)
def _sampler() -> Sampler:
    return Sampler()


def fit_weights(docs: DataFrame, text: str = "__text") -> Weights:
    """Document counts of the hashed shingles over all the documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for low, high in text_batches(texts):
                hashes, _, cuts = shingles(texts[low:high])
                held += np.bincount(slot_of(hashes), minlength=SLOTS)
                documents += int((np.diff(cuts) > 0).sum())
        if documents:
            slot = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(slot, -1)), pa.array(np.append(held[slot], documents))], names=["slot", "n"])

    prepare(docs.sparkSession)
    # SLOTS + 1 rows at most
    found = docs.select(text).mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slots, n = found.column("slot").to_numpy(), found.column("n").to_numpy()
    counts = np.zeros(SLOTS, np.int64)
    counts[slots[slots >= 0]] = n[slots >= 0]
    return Weights.of(counts, int(n[slots < 0].sum()))


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted sets (hashes, weights in steps)."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    total = int(x[1].sum() + y[1].sum())
    both = int(np.minimum(x[1][i], y[1][j]).sum())
    return both / (total - both) if total else 0.0


def _verify(pairs: DataFrame, texts: DataFrame, weights, tag: str) -> DataFrame:
    """``pairs`` (a, b) with their exact similarity ``s``, written."""
    left = texts.select(F.col("h").alias("a"), F.col("__text").alias("ta"))
    right = texts.select(F.col("h").alias("b"), F.col("__text").alias("tb"))

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        both = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
        out = []
        for low, high in ranges([len(p) + len(q) for p, q in zip(*both)]):
            sets = []
            for side in both:
                hashes, tf, cuts = shingles(side[low:high])
                steps = weights.value.steps(hashes, tf)
                sets.append([(hashes[p:q], steps[p:q]) for p, q in zip(cuts, cuts[1:])])
            out += [similarity(x, y) for x, y in zip(*sets)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "s"])

    return stored(in_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb"), measure, "a string, b string, s double"), tag)


def near_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", least: float = SIMILARITY, tag: str = "minhash") -> DataFrame:
    """A row for each row with a word: ``key``, the md5 ``h`` of its text, the
    ``component`` of its class and ``class_id``, the smallest key in the class."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(docs[key].alias("key"), docs[text].alias("__text")).filter(F.col("__text").isNotNull())
    weights = spark.sparkContext.broadcast(fit_weights(rows))  # SLOTS numbers

    hashed = rows.select("key", "__text", F.md5(F.col("__text").cast("binary")).alias("h"))
    sketch = stored(_sampled(hashed, ["key", "h"], weights), f"{tag}-sketch")
    nodes = stored(sketch.groupBy("h").agg(F.min("key").alias("key"), F.first("bands").alias("bands")), f"{tag}-nodes")
    bucket = _buckets(nodes, f"{tag}-buckets")
    # one row of each text that is in a bucket: by text and key, so that no text's rows meet in a task
    involved = bucket.select("h").distinct().join(nodes.select("h", "key"), "h").select(F.col("h").alias("ih"), F.col("key").alias("ikey"))
    texts = stored(
        hashed.join(involved, (F.col("h") == F.col("ih")) & F.col("key").eqNullSafe(F.col("ikey")), "left_semi")
        .groupBy("h")
        .agg(F.first("__text").alias("__text")),
        f"{tag}-texts",
    )
    label = texts.select(F.col("h").alias("node"), F.col("h").alias("root"))
    first = _verify(_star(bucket), texts, weights, f"{tag}-star")
    label = _merged(label, first.filter(F.col("s") >= least), f"{tag}-cc")
    apart = _apart(bucket, label, f"{tag}-apart")
    if apart.isEmpty():
        return _members(sketch, label, f"{tag}-members")
    return _members(sketch, _merged(label, _rest(apart, first, texts, weights, least, tag), f"{tag}-cc-last"), f"{tag}-members")


def _sampled(df: DataFrame, names: list[str], weights) -> DataFrame:
    """The columns ``names`` and the band keys of the rows of ``df`` whose ``__text`` has a word."""

    def sample(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column("__text").to_pylist()
        for low, high in text_batches(texts, 1 << 18):
            hashes, tf, cuts = shingles(texts[low:high])
            full = np.flatnonzero(np.diff(cuts) > 0)
            if len(full):
                keys = _sampler().bands(hashes, weights.value.steps(hashes, tf), np.append(cuts[:-1][full], cuts[-1]))
                took = pa.array(full + low)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * SHAPE[0], pa.int32()), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(n).take(took) for n in names), bands], names=[*names, "bands"])

    kinds = ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)
    return in_batches(df.select(*names, "__text"), sample, f"{kinds}, bands array<long>")


def _buckets(nodes: DataFrame, tag: str) -> DataFrame:
    """(bucket, h, leader, second) of the buckets with two nodes or more; the smallest
    and the greatest node (nodes are md5 sums, so any two) lead. (Here and below the side
    of a join that has one row for each key is written first: then it is broadcast if
    its files are small, and else both sides are shuffled for the join alone, so that
    a large key's rows on the other side are split among tasks.)"""
    member = nodes.select("h", F.posexplode("bands").alias("band", "value"))
    shared = member.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("leader"), F.max("h").alias("second")).filter("n > 1").drop("n")
    shared = stored(shared, f"{tag}-shared")
    return stored(member.join(shared, ["band", "value"]).select(F.xxhash64("band", "value", "leader").alias("bucket"), "h", "leader", "second"), tag)


def _star(bucket: DataFrame) -> DataFrame:
    """Each member with its bucket's two leaders, the greater one of a pair first."""
    both = bucket.select("h", F.explode(F.array("leader", "second")).alias("l")).filter("h <> l")
    return both.select(F.greatest("h", "l").alias("a"), F.least("h", "l").alias("b")).distinct()


def _merged(label: DataFrame, links: DataFrame, tag: str) -> DataFrame:
    """The classes (node, root) after more links. Only links between classes count:
    the components of those, not of all the nodes, are looked for."""
    a = label.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = label.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    between = links.join(a, "a").join(b, "b").filter("ra <> rb").select("ra", "rb")
    new = connected(between, "ra", "rb", tag).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return stored(label.join(new, "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"{tag}-label")


def _apart(bucket: DataFrame, label: DataFrame, tag: str) -> DataFrame:
    """The members of buckets whose members are not all in one class, with their class ``c`` and the leader's ``lc``."""
    own = label.select(F.col("node").alias("h"), F.col("root").alias("c"))
    lead = label.select(F.col("node").alias("leader"), F.col("root").alias("lc"))
    known = stored(bucket.join(own, "h").join(lead, "leader"), f"{tag}-known")
    # the leader is a member, so a bucket is apart if a member's class isn't the leader's
    mixed = stored(known.filter("c <> lc").select("bucket").distinct(), f"{tag}-mixed")
    return stored(known.join(mixed, "bucket", "left_semi"), tag)


def _rest(apart: DataFrame, first: DataFrame, texts: DataFrame, weights, least: float, tag: str) -> DataFrame:
    """Links (a, b) between what shares a bucket and no class. Members are put in
    bins by their distance to the leader; only members whose distances differ by
    ``1 - least`` at most can be linked, so only bins two apart at most are
    compared, in blocks of members outside the leader's class with all members."""
    far = first.select(F.col("a").alias("h"), F.col("b").alias("leader"), (1 - F.col("s")).alias("d"))
    bin_of = F.floor(F.col("d") / ((1 - least) / 2)).cast("int")
    here = stored(apart.join(far, ["h", "leader"]).select("bucket", "h", "c", (F.col("c") != F.col("lc")).alias("out"), bin_of.alias("bin")), f"{tag}-left")
    size = here.groupBy("bucket", "bin").agg(F.count(F.lit(1)).alias("n"), F.count_if("out").alias("n_out"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    x = size.filter("n_out > 0").select("bucket", F.col("bin").alias("bx"), blocks("n_out").alias("kx"))
    y = size.select("bucket", F.col("bin").alias("by"), blocks("n").alias("ky"))
    plan = stored(x.join(y, "bucket").filter(F.abs(F.col("bx") - F.col("by")) <= 2), f"{tag}-plan")
    own = lambda k: F.pmod(F.xxhash64("h"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    sides = [
        here.filter("out").withColumnRenamed("bin", "bx").join(plan, ["bucket", "bx"]).select("bucket", "bx", "by", own("kx").alias("i"), every("ky").alias("j"), "h", "c", F.lit(0).alias("side")),
        here.withColumnRenamed("bin", "by").join(plan, ["bucket", "by"]).select("bucket", "bx", "by", every("kx").alias("i"), own("ky").alias("j"), "h", "c", F.lit(1).alias("side")),
    ]
    dealt = sides[0].union(sides[1]).join(texts, "h")

    def compare(block: pa.Table) -> pa.Table:
        return block_links(block, weights.value, least)

    prepare(apart.sparkSession)
    return stored(dealt.groupBy("bucket", "bx", "by", "i", "j").applyInArrow(compare, "a string, b string"), f"{tag}-rest")


def block_links(block: pa.Table, weights: Weights, least: float) -> pa.Table:
    """Links between the classes of a block's two sides: a spanning forest of them."""
    side = block.column("side").to_numpy()
    names = block.column("h").to_pylist()
    classes = block.column("c").to_pylist()
    hashes, tf, cuts = shingles(block.column("__text").to_pylist())
    # a shingle that occurs t times is t elements; each has what it adds to the weight
    times = np.arange(int(tf.sum())) - np.repeat(np.cumsum(tf) - tf, tf) + 1
    hashes, owner = np.repeat(hashes, tf), np.repeat(np.repeat(np.arange(len(names)), np.diff(cuts)), tf)
    adds = weights.steps(hashes, times) - np.where(times > 1, weights.steps(hashes, np.maximum(times - 1, 1)), 0)
    total = np.bincount(owner, adds, len(names))
    _, element, found = np.unique(mix(hashes + times.astype(np.uint64)), return_inverse=True, return_counts=True)
    shared = found[element] > 1
    element, owner, adds = element[shared], owner[shared], adds[shared]
    rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    place = np.zeros(len(names), np.int64)
    place[rows], place[cols] = np.arange(len(rows)), np.arange(len(cols))
    both = np.zeros((len(rows), len(cols)))
    number = np.unique(element, return_inverse=True)[1]
    width = 4096
    for low in range(0, int(number.max()) + 1 if len(number) else 0, width):
        part = (number >= low) & (number < low + width)
        n, o, w = number[part] - low, owner[part], adds[part]
        left, right = np.zeros((len(rows), width), np.float32), np.zeros((width, len(cols)), np.float32)
        at = side[o] == 0
        left[place[o[at]], n[at]] = w[at]
        right[n[~at], place[o[~at]]] = 1
        both += left @ right
    whole = total[rows][:, None] + total[cols][None, :] - both
    links: list[tuple[str, str]] = []
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.get(c, c) != c:
            c = root[c]
        return c

    for i, j in zip(*np.nonzero(both >= least * whole)):
        a, b = find(classes[rows[i]]), find(classes[cols[j]])
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((names[rows[i]], names[cols[j]]))
    return pa.table([pa.array([a for a, _ in links], pa.string()), pa.array([b for _, b in links], pa.string())], names=["a", "b"])


def _members(sketch: DataFrame, label: DataFrame, tag: str) -> DataFrame:
    """Each row's class: its text's component, named by the smallest key in it."""
    own = sketch.groupBy("h").agg(F.min("key").alias("least"))
    root = stored(own.join(label, F.col("h") == F.col("node"), "left").select("h", "least", F.coalesce("root", "h").alias("root")), f"{tag}-root")
    named = stored(root.groupBy("root").agg(F.min("least").alias("class_id")), f"{tag}-named")
    classes = stored(root.select("h", "root").join(named, "root").select("h", "class_id", "root"), f"{tag}-classes")
    return sketch.select("key", "h").join(classes, "h").select("key", "class_id", F.col("root").alias("component"), "h")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each row's key, class (its smallest key), the class's number of rows, and
    whether the row stays (one document of each class; rows that repeat it with its key count as it)."""
    rows = stored(near_classes(docs, text, key), "minhash-rows")
    size = stored(rows.groupBy("component").agg(F.count(F.lit(1)).alias("class_size")), "minhash-sizes")
    named = rows.join(size, "component").select("key", "class_id", "class_size")
    alone = docs.select(docs[key].alias("key"), docs[text].alias("__text")).filter(~has_word(F.col("__text")))
    named = named.unionByName(alone.select("key", F.col("key").alias("class_id"), F.lit(1).cast("long").alias("class_size")))
    return named.select(F.col("key").alias(key), "class_id", "class_size", F.col("key").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each class: that with the smallest key (then the smallest md5 of
    its text); rows without a word all stay. Columns stay as they are."""
    first = (
        near_classes(docs, text, key)
        .groupBy("component")
        .agg(F.min(F.struct(F.col("key").isNull(), "key", "h")).alias("m"))
        .select(F.col("m.key").alias("__key"), F.col("m.h").alias("__own"))
    )
    first = stored(first, "minhash-kept")
    hashed = docs.withColumn("__h", F.md5(docs[text].cast("binary")))
    kept = hashed.join(first, (F.col("__h") == F.col("__own")) & F.col(f"`{key}`").eqNullSafe(F.col("__key")), "left_semi")
    alone = docs.filter(~has_word(docs[text]))
    return kept.dropDuplicates(["__h", key]).drop("__h").unionByName(alone)


def has_word(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[\p{L}\p{N}]"), F.lit(False))
