"""Toxicity by a convolutional text classifier trained in numpy.

A word's vector is the sum of two hashed embeddings, of the whole word and of
its first letters (toxic stems take many endings). Filters of several widths
run over all the words of a document; each filter's largest response over the
whole text feeds a logistic layer. Words of whose buckets training saw
nothing are neutral. Every labelled document that may be learned from teaches:
three of four (by a hash of the id) train the network, the fourth sets the
thresholds. Training is Adagrad over minibatches in shards of about ``SHARD``
documents, a group of a Spark job each; after each round the shards' networks are
averaged, every embedding over the shards that saw its words, in whole
numbers, so that no order of sums matters. A pass has ``ROUNDS`` rounds, each over
other shards, and there are as many passes as ``VISITS`` asks for, one at least. The
thresholds, one for each language, come from counts of all the held logits. The
language comes from the text alone (the n-gram model of ``langid``, of all the
rows that may be learned from), and a document's score is shifted so that its
language's threshold lies at ``AT``.

Edge cases: a null or empty text has the score of a text without any filter
response; without labels of both kinds every score is 0; of texts with one id
the smallest teaches; repeated rows and null ids are scored row by row (labels
without an id teach nothing); an empty table gives an empty table. Whole texts
are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from placeframe.llm.common import carried, held_out, in_batches, prepare, stored, text_batches
from placeframe.llm.langid import LanguageModel, Words, fit_languages
from placeframe.llm.textblocks import span_hashes

#: Documents, and bytes of their texts, that one task trains on in a round, about.
SHARD, SHARD_BYTES = 4096, 32 << 20
#: Rounds of a pass over the documents, if it has as many shards.
ROUNDS = 4
BUCKETS = 1 << 18
SIZE = 8
FILTERS = 16
WIDTHS = (1, 2, 3)
STEM = 4  # letters of a word's stem
#: Documents that training visits over all its passes, about, if they have fewer.
VISITS = 24_000
BATCH = 32
SEED = 7
RATE = 0.08
#: One in so many labelled documents sets the thresholds, the others train.
HOLD = 4
#: Logits are counted in steps of 1 / BINS, up to REACH.
BINS, REACH = 256, 60
#: Numbers are averaged as multiples of 1 / UNIT.
UNIT = 1 << 30
#: The score at which a document is called toxic.
AT = 0.3
#: Examples of each label that a language's own threshold needs.
LEAST = 15


def buckets(block: Words) -> np.ndarray:
    """The two embedding rows of each distinct word."""
    whole = span_hashes(block.letters, block.starts, block.ends)
    stem = span_hashes(block.letters, block.starts, np.minimum(block.ends, block.starts + STEM))
    n = np.uint64(BUCKETS)
    return np.stack([whole % n, stem % n + n]).astype(np.int64)


def shifted(inverse: np.ndarray, cuts: np.ndarray, by: int, empty: int) -> np.ndarray:
    """The word ``by`` places on within the same text, or ``empty``."""
    if not by:
        return inverse
    out = np.full(len(inverse), empty, inverse.dtype)
    out[:-by] = inverse[by:]
    for k in range(1, by + 1):
        edge = cuts[1:] - k
        out[edge[edge >= cuts[:-1]]] = empty
    return out


@dataclass
class Network:
    embedding: np.ndarray  # 2 * BUCKETS + 1 rows; the last is that of no word
    filters: list[np.ndarray]  # (width, SIZE, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: dict[int, float] = field(default_factory=dict)
    threshold: float = 0.0

    @classmethod
    def fresh(cls, seed: int = SEED) -> Network:
        r = np.random.default_rng(seed)
        return cls(
            (r.standard_normal((2 * BUCKETS + 1, SIZE)) * 0.05).astype(np.float32),
            [(r.standard_normal((w, SIZE, FILTERS)) * (0.5 / w)).astype(np.float32) for w in WIDTHS],
            np.full(len(WIDTHS) * FILTERS, 0.05, np.float32),
            (r.standard_normal(len(WIDTHS) * FILTERS) * 0.3).astype(np.float32),
            0.0,
        )

    def pooled(self, vectors: np.ndarray, inverse: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each text; ``vectors`` are the distinct words', a row of zeros last."""
        out = np.zeros((len(cuts) - 1, len(WIDTHS) * FILTERS), np.float32)
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        if len(full):
            places = [shifted(inverse, cuts, o, len(vectors) - 1) for o in range(max(WIDTHS))]
            for k, w in enumerate(self.filters):
                response = (vectors @ w[0])[places[0]]
                for o in range(1, len(w)):
                    response += (vectors @ w[o])[places[o]]
                out[full, k * FILTERS : (k + 1) * FILTERS] = np.maximum.reduceat(response, cuts[:-1][full], axis=0)
        return out

    def logits(self, block: Words) -> np.ndarray:
        rows = buckets(block)
        vectors = np.zeros((rows.shape[1] + 1, SIZE), np.float32)
        vectors[:-1] = self.embedding[rows[0]] + self.embedding[rows[1]]
        return np.maximum(self.pooled(vectors, block.inverse, block.cuts) + self.bias, 0) @ self.weights + self.offset

    def others(self) -> np.ndarray:
        """All numbers but the embedding, in rows as long as its."""
        flat = np.concatenate([*(w.ravel() for w in self.filters), self.bias, self.weights, [self.offset]])
        return np.append(flat, np.zeros(-len(flat) % SIZE)).reshape(-1, SIZE)

    def moved(self, old: Network, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where this network differs from ``old`` by training that saw the embeddings ``seen``:
        numbers of rows (of the embedding, then of ``others``), and by how many units."""
        at = np.flatnonzero(seen)
        by = np.vstack([self.embedding[at].astype(float) - old.embedding[at], self.others() - old.others()])
        return np.append(at, len(seen) + np.arange(len(by) - len(at))), np.rint(by * UNIT).astype(np.int64)

    def move(self, rows: np.ndarray, by: np.ndarray) -> None:
        """Adds ``by`` (numbers, not units) to the rows that ``moved`` names."""
        inner = rows < len(self.embedding)
        self.embedding[rows[inner]] += by[inner].astype(np.float32)
        flat = self.others()
        flat[rows[~inner] - len(self.embedding)] += by[~inner]
        flat, low = flat.ravel(), 0
        for x in (*self.filters, self.bias, self.weights):
            x[...] = flat[low : low + x.size].reshape(x.shape)
            low += x.size
        self.offset = float(flat[low])

    def train(self, rows: list[np.ndarray], labels: np.ndarray, visits: int = VISITS, seed: int = SEED) -> None:
        """Trains a fresh network on all there is to learn from; words that it didn't see become neutral."""
        seen = self.visit(rows, labels, np.bincount(labels, minlength=2) / len(labels), visits, seed)
        self.embedding[~seen] = 0

    def visit(self, rows: list[np.ndarray], labels: np.ndarray, share: np.ndarray, visits: int, seed: int) -> np.ndarray:
        """Trains on ``rows`` (for each document the two embedding rows of each of its words, (2, words)),
        the labels weighted by their ``share`` among all that train. Returns the embeddings seen."""
        order = np.random.default_rng(seed)
        rate = np.float32(RATE)
        seen = np.zeros(len(self.embedding), bool)
        squares = [np.full_like(x, 1e-2) for x in (self.embedding, *self.filters, self.bias, self.weights)]
        square_offset = 1e-2

        def step(values: np.ndarray, gradient: np.ndarray, square: np.ndarray) -> None:
            square += gradient * gradient
            values -= rate * gradient / np.sqrt(square)

        balance = (0.5 / np.maximum(share, 1e-9)).astype(np.float32)
        for _ in range(max(1, round(visits / len(rows)))):
            for ids in np.array_split(order.permutation(len(rows)), max(1, len(rows) // BATCH)):
                batch = [rows[i] for i in ids]
                cuts = np.concatenate([[0], np.cumsum([x.shape[1] for x in batch])])
                flat = np.concatenate(batch, axis=1)
                n = flat.shape[1]
                vectors = np.zeros((n + 1, SIZE), np.float32)
                vectors[:n] = self.embedding[flat[0]] + self.embedding[flat[1]]
                places = [shifted(np.arange(n), cuts, o, n) for o in range(max(WIDTHS))]
                peak, where = np.zeros((len(ids), len(self.bias)), np.float32), np.zeros((len(ids), len(self.bias)), np.int64)
                for k, w in enumerate(self.filters):
                    response = sum(vectors[places[o]] @ w[o] for o in range(len(w)))
                    own = slice(k * FILTERS, (k + 1) * FILTERS)
                    for d in range(len(ids)):
                        if cuts[d + 1] > cuts[d]:
                            part = response[cuts[d] : cuts[d + 1]]
                            at = part.argmax(axis=0)
                            where[d, own] = at + cuts[d]
                            peak[d, own] = part[at, np.arange(FILTERS)]
                hidden = np.maximum(peak + self.bias, 0)
                error = 1 / (1 + np.exp(-(hidden @ self.weights + self.offset))) - labels[ids]
                error = (error * balance[labels[ids]] / len(ids)).astype(np.float32)
                back = error[:, None] * self.weights * (hidden > 0)
                empty = cuts[1:] == cuts[:-1]
                inner = np.where(empty[:, None], 0, back)
                changed = np.zeros((n + 1, SIZE), np.float32)
                for k, w in enumerate(self.filters):
                    own = slice(k * FILTERS, (k + 1) * FILTERS)
                    gradient = np.zeros_like(w)
                    for o in range(len(w)):
                        at = np.append(places[o], n)[np.minimum(where[:, own], n)]
                        gradient[o] = np.einsum("dfs,df->sf", vectors[at], inner[:, own])
                        np.add.at(changed, at, inner[:, own, None] * w[o].T[None])
                    step(w, gradient, squares[1 + k])
                touched = np.flatnonzero(changed[:n].any(axis=1))
                for half in flat:
                    row, back_to = np.unique(half[touched], return_inverse=True)
                    gradient = np.zeros((len(row), SIZE), np.float32)
                    np.add.at(gradient, back_to, changed[touched])
                    squares[0][row] += gradient * gradient
                    self.embedding[row] -= rate * gradient / np.sqrt(squares[0][row])
                    seen[half] = True
                step(self.bias, back.sum(axis=0), squares[-2])
                step(self.weights, hidden.T @ error, squares[-1])
                square_offset += float(error.sum()) ** 2
                self.offset -= float(rate) * float(error.sum()) / square_offset**0.5
        return seen

    def calibrate(self, found: pa.Table) -> None:
        """A threshold for all and one for each language with enough examples of both labels,
        from the counts ``n`` of the held documents by lang, label and logit (``bin``, in steps)."""
        lang, label, at, n = (found.column(c).to_numpy() for c in ("lang", "label", "bin", "n"))

        def split(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            bins, back = np.unique(at[own], return_inverse=True)
            clean, toxic = (np.bincount(back, np.where(label[own] == y, n[own], 0), len(bins)) for y in (0, 1))
            return bins / BINS, clean, toxic

        whole = split(np.ones(len(n), bool))
        self.threshold = best_threshold(*whole) if whole[1].any() and whole[2].any() else 0.0
        for i in np.unique(lang):
            own = split(lang == i)
            if min(own[1].sum(), own[2].sum()) >= LEAST:
                self.thresholds[int(i)] = best_threshold(*own)


def best_threshold(x: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap that cuts off most clean documents and fewest toxic ones, of
    which there are ``clean`` and ``toxic`` at the logits ``x`` (ascending)."""
    # cut k: those at the first k logits are called clean; clean documents weigh twice
    value = 2 * np.concatenate([[0], np.cumsum(clean)]) / max(1, clean.sum()) - np.concatenate([[0], np.cumsum(toxic)]) / max(1, toxic.sum())
    at = np.flatnonzero(value >= value.max() - 1e-12)
    k = int(at[len(at) // 2])
    low = x[k - 1] if k else x[0] - 2
    high = x[k] if k < len(x) else x[-1] + 2
    return float(low + 0.5 * (high - low))


def word_rows(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the two embedding rows of each of its words."""
    out = []
    for low, high in text_batches(texts):
        block = Words.of(texts[low:high])
        both = buckets(block).astype(np.int32)
        out += [both[:, block.inverse[a:b]] for a, b in zip(block.cuts, block.cuts[1:])]
    return out


@dataclass
class ToxicityModel:
    network: Network | None
    languages: LanguageModel

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        if self.network is None:
            return out
        shift = np.log(AT / (1 - AT))
        for low, high in text_batches(texts):
            block = Words.of(texts[low:high])
            logits = self.network.logits(block)
            limit = np.array([self.network.thresholds.get(i, self.network.threshold) for i in self._languages(block).tolist()])
            out[low:high] = 1 / (1 + np.exp(-np.clip(logits - limit + shift, -40, 40)))
        return out

    def _languages(self, block: Words) -> np.ndarray:
        if not self.languages.names:
            return np.zeros(len(block.cuts) - 1, np.int64)
        return self.languages.strongest(block, self.languages.word_scores(block))


def _hashed(what: str, n: int) -> Column:
    """A number below ``n`` for each ``__key``."""
    return F.pmod(F.xxhash64(F.lit(what), "__key"), F.lit(n))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", label: str = "toxic") -> ToxicityModel:
    """Learns from every labelled document that may be learned from."""
    spark = prepare(docs.sparkSession)
    shown = labels.select(labels[key].alias("__key"), labels[label].cast("int").alias("__label"))
    shown = shown.filter(F.col("__key").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__key")))
    shown = shown.groupBy("__key").agg(F.max("__label").alias("__label"))
    texts = docs.select(docs[key].alias("__key"), docs[text].alias("__text")).filter(F.col("__key").isNotNull() & ~held_out(F.col("__key")))
    size = texts.groupBy("__key").agg(F.max(F.octet_length("__text")).alias("__size"))
    known = stored(shown.join(size, "__key"), "toxicity-known")  # an id, its label and a size a row
    held = _hashed("held", HOLD) == 0
    sizes = known.groupBy("__label", held.alias("held")).agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("bytes")).collect()  # four rows
    model = ToxicityModel(None, fit_languages(docs, text, lang, key, sample=None))
    if len({r["__label"] for r in sizes}) < 2:
        return model

    def taught(part: Column) -> DataFrame:
        """(__key, __text, __label) of the labelled documents in a part of the keys, each key once."""
        return texts.filter(part).join(known.filter(part).select("__key", "__label"), "__key").groupBy("__key").agg(F.min("__text").alias("__text"), F.first("__label").alias("__label"))

    counts = np.array([sum(r["n"] for r in sizes if not r["held"] and r["__label"] == y) for y in (0, 1)])
    total, volume = int(counts.sum()), sum(r["bytes"] or 0 for r in sizes if not r["held"])
    model.network, seen = Network.fresh(), np.zeros(2 * BUCKETS + 1, bool)
    shards = max(1, -(-total // SHARD), -(-volume // SHARD_BYTES))
    rounds = min(ROUNDS, shards)
    for i in range(max(1, round(VISITS / max(1, total))) * rounds if shards > 1 else 1):
        some = ~held & (_hashed("shard", shards) % rounds == i % rounds)
        rows = taught(some).withColumn("__shard", _hashed("shard", shards)).repartition(2 * -(-shards // rounds), "__shard")
        moves = _averaged(rows, model.network, counts / max(1, total), VISITS if shards == 1 else 0, i)
        at = moves.column("row").to_numpy()
        model.network.move(at, np.stack([moves.column(f"d{k}").to_numpy() for k in range(SIZE)], axis=1))
        seen[at[at < len(seen)]] = True
    model.network.embedding[~seen] = 0
    shared = spark.sparkContext.broadcast(model)

    def tally(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = batch.column("__text").to_pylist()
        for low, high in text_batches(own):
            block = Words.of(own[low:high])
            at = np.rint(np.clip(shared.value.network.logits(block), -REACH, REACH) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shared.value._languages(block)), batch.column("__label")[low:high], pa.array(at)], names=["lang", "label", "bin"])

    found = in_batches(taught(held).select("__text", "__label"), tally, "lang long, label int, bin long")
    # 2 * REACH * BINS rows at most for each language and label
    model.network.calibrate(found.groupBy("lang", "label", "bin").agg(F.count(F.lit(1)).alias("n")).toArrow())
    shared.destroy()
    return model


def _averaged(rows: DataFrame, network: Network, share: np.ndarray, visits: int, number: int) -> pa.Table:
    """Trains a copy of ``network`` on each shard (every document once, or in all ``visits``), and
    returns by how much each row moved, on average over the shards that saw it."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def learn(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("__key")
        own = deepcopy(shared.value)
        texts = word_rows(shard.column("__text").to_pylist())
        seen = own.visit(texts, shard.column("__label").to_numpy(), share, visits or len(texts), SEED + number)
        at, by = own.moved(shared.value, seen)
        return pa.table([pa.array(at), *(pa.array(x) for x in np.ascontiguousarray(by.T))], names=["row", *names])

    names = [f"d{k}" for k in range(SIZE)]
    moved = rows.groupBy("__shard").applyInArrow(learn, ", ".join(f"{n} long" for n in ["row", *names]))
    mean = [(F.sum(n) / F.count(F.lit(1)) / F.lit(float(UNIT))).cast("float").alias(n) for n in names]
    # 2 * BUCKETS rows at most, and those of ``others``
    found = moved.groupBy("row").agg(*mean).toArrow()
    shared.destroy()
    return found


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with each whole text's score."""
    names = docs.columns if keep is None else keep
    rows, inner, fields = carried(docs, names, __text=text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: embeddings and n-gram table

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = shared.value.scores(batch.column("__text").to_pylist())
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in inner), pa.array(scores)], names=[*inner, "__out"])

    return in_batches(rows, score, StructType([*fields, StructField("__out", DoubleType())])).toDF(*names, out)


def keep_clean(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", at: float = AT) -> DataFrame:
    """The documents that score below ``at``. Columns stay as they are."""
    own = "__score"
    while own in docs.columns:
        own += "_"
    scored = score_toxicity(docs, fit_toxicity(docs, labels, text, key, lang), text, out=own)
    return scored.filter(F.col(own) < at).drop(own)
