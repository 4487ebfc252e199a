"""Language identification by multilingual mixture inference.

Every word of a document is taken to be drawn from one of several languages;
its likelihood in a language is that of its letter n-grams.
Expectation-maximisation estimates the document's language proportions from
these likelihoods. The set of languages is selected by penalised likelihood:
the sets of the one, two, ... strongest languages are compared, each further
language costs ``PENALTY`` times the logarithm of the number of words. The
prediction is the language with the largest proportion in the selected set.

The n-gram model is fitted on a bounded sample of the rows that may be learned
from: ``SAMPLE`` rows shared evenly by the languages (``FEWEST`` for each at
least), chosen by a hash of id and text, equal rows once; every language has a
row at any size. Every document is inferred whole.

Proportions say which language, not whether it is one: the largest is never
small. ``keep_identified`` therefore identifies each text and then weighs evidence
that can fail: how much better, for each n-gram, a text's words are explained by the
mixture inferred for it than by a background in which every slot is equally likely.
A text needs ``FAIR`` of what all but the lowest ``LOW`` of the learnable rows of the
language predicted for it have under a model that hasn't seen them.

Edge cases: a null text or one without a letter is ``und`` with score 0; with
nothing to learn from every document is; ties go to the alphabetically first
language; repeated rows and null ids are scored row by row; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from placeframe.llm.common import carried, held_out, in_batches, prepare, stored, text_batches
from placeframe.llm.textblocks import lowered, mix, per_text, points, span_hashes, sums, words

UNDETERMINED = "und"
#: Rows that the n-gram model is fitted on, about.
SAMPLE = 20_000
#: Of each language at least so many, if it has them.
FEWEST = 200
#: Hashed n-grams (of three signs with word ends, and of two).
SLOTS = 1 << 16
SMOOTHING = 0.1
#: Natural logs a word's n-gram likelihoods are scaled by, as n-grams overlap.
SCALE = 0.5
PENALTY = 2.0
#: Languages in a document at most that selection weighs against each other.
MOST = 3
ROUNDS = 5
EDGE = 1
#: One in so many learnable rows is left out of the model that the bounds of the evidence come from.
HOLD = 5
LOW = 0.01
FAIR = 0.5


@dataclass
class Words:
    """The words of some texts: the distinct ones' letters, and each word's index among them."""

    letters: np.ndarray
    starts: np.ndarray  # of the distinct words
    ends: np.ndarray
    inverse: np.ndarray
    cuts: np.ndarray  # bounds of each text's words

    @classmethod
    def of(cls, texts: list[str | None]) -> Words:
        cps, bounds = points(texts)
        letters = lowered()[cps]
        starts, ends = words(cps, bounds)
        _, first, inverse = np.unique(span_hashes(letters, starts, ends), return_index=True, return_inverse=True)
        return cls(letters, starts[first], ends[first], inverse, per_text(starts, bounds))

    def ngrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the distinct words' n-grams, and the bounds of each word's."""
        length = self.ends - self.starts
        cuts = np.concatenate([[0], np.cumsum(length + 1)])
        total = int(cuts[-1])
        within = np.arange(total) - np.repeat(cuts[:-1], length + 1)  # 0 .. length
        at = np.repeat(self.starts, length + 1) + within
        letters = np.append(self.letters, EDGE).astype(np.uint64)
        here = letters[np.minimum(at, len(letters) - 1)]
        here[cuts[1:] - 1] = EDGE
        before = np.empty_like(here)
        before[1:] = here[:-1]
        before[cuts[:-1]] = EDGE
        older = np.empty_like(here)
        older[1:] = before[:-1]
        older[cuts[:-1]] = 0
        two = before * np.uint64(0x200000) + here
        three = mix(two + older * np.uint64(0x40000000000))
        return np.concatenate([mix(two), three]) % np.uint64(SLOTS), cuts

    def likelihoods(self, table: np.ndarray) -> np.ndarray:
        """Log-likelihood of each distinct word in each language."""
        slots, cuts = self.ngrams()
        half = len(slots) // 2
        each = table[slots[:half]] + table[slots[half:]]
        return sums(each, cuts)


@dataclass
class LanguageModel:
    names: list[str]
    table: np.ndarray  # log-probability of each slot in each language

    def word_scores(self, block: Words) -> np.ndarray:
        return block.likelihoods(self.table) * np.float32(SCALE)

    def strongest(self, block: Words, scores: np.ndarray) -> np.ndarray:
        """The single most likely language of each text, as an index."""
        return sums(scores[block.inverse], block.cuts).argmax(axis=1)

    def infer(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The proportions of each text's selected languages, and whether it has a word."""
        return self._inferred(texts)[:2]

    def weigh(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``infer`` returns, and the gain of each text's mixture over the background
        for each n-gram (-inf without a word)."""
        return self._inferred(texts, True)

    def _inferred(self, texts: list[str | None], weigh: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = np.zeros((len(texts), len(self.names)), np.float32)
        some, gain = np.zeros(len(texts), bool), np.full(len(texts), -np.inf)
        for low, high in text_batches(texts):
            block = Words.of(texts[low:high])
            full = block.cuts[1:] > block.cuts[:-1]
            some[low:high] = full
            if full.any() and self.names:
                scores = self.word_scores(block)[block.inverse]
                cuts = np.append(block.cuts[:-1][full], block.cuts[-1])
                at = np.flatnonzero(full) + low
                out[at] = mixture(scores, cuts)
                if weigh:
                    size = 2.0 * (block.ends - block.starts + 1)[block.inverse]  # n-grams of each word
                    explained = mixed_scores(scores, out[at], cuts) / SCALE + size * np.log(SLOTS)
                    gain[at] = sums(explained, cuts) / sums(size, cuts)
        return out, some, gain


def mixture(scores: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Proportions of the languages in each text from its words' log-likelihoods."""
    counts = np.diff(cuts)
    top = scores.max(axis=1, keepdims=True)
    like = np.exp(scores - top)
    n_texts, n_names = len(counts), scores.shape[1]

    def maximise(share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for i in range(rounds + 1):
            post = like * np.repeat(share, counts, axis=0)
            total = np.maximum(post.sum(axis=1, keepdims=True), 1e-30)
            if i == rounds:
                return share, sums(np.log(total[:, 0].astype(np.float64)), cuts)
            post /= total
            share = sums(post, cuts) / counts[:, None]
        raise AssertionError

    share, _ = maximise(np.full((n_texts, n_names), 1 / n_names, np.float32), ROUNDS)
    single = sums((scores - top).astype(np.float64), cuts)
    rank = np.argsort(-single, axis=1, kind="stable")
    best = np.zeros_like(share)
    best[np.arange(n_texts), rank[:, 0]] = 1
    value = single.max(axis=1)
    order = np.argsort(-share, axis=1, kind="stable")
    for k in range(2, min(MOST, n_names) + 1):
        mask = np.zeros_like(share)
        np.put_along_axis(mask, order[:, :k], 1, axis=1)
        start = (share + np.float32(1e-6)) * mask
        start /= start.sum(axis=1, keepdims=True)
        fitted, fit = maximise(start, 2)
        fit -= PENALTY * (k - 1) * np.log(counts + 1.0)
        better = fit > value
        value[better] = fit[better]
        best[better] = fitted[better]
    return best


def mixed_scores(scores: np.ndarray, share: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word in its text's mixture of languages."""
    top = scores.max(axis=1, keepdims=True)
    like = (np.exp(scores - top) * np.repeat(share, np.diff(cuts), axis=0)).sum(axis=1)
    return top[:, 0] + np.log(np.maximum(like, 1e-30).astype(np.float64))


def learnable(docs: DataFrame, text: str, lang: str, key: str, sample: int | None) -> DataFrame:
    """(__text, __lang, __held) of about ``sample`` of the rows that may be learned from,
    some of each language, or of all of them; one in ``HOLD`` is held."""
    names = docs.select(docs[text].alias("__text"), docs[lang].cast("string").alias("__lang"), docs[key].alias("__key"))
    rows = names.filter(~held_out(F.col("__key")) & F.col("__lang").isNotNull())
    held = (F.pmod(F.xxhash64(F.lit("held"), "__key", "__text"), F.lit(HOLD)) == 0).alias("__held")
    if sample is None:
        return rows.select("__text", "__lang", held)
    rows = rows.withColumn("__hash", F.xxhash64("__key", "__text")).withColumn("__order", F.pmod("__hash", F.lit(1 << 30)))
    # a row for each language, as the model has a column; its first row is in the sample whatever its share is
    sizes = rows.groupBy("__lang").agg(F.approx_count_distinct("__hash").alias("n"), F.min("__order").alias("first")).collect()
    each = max(FEWEST, sample // max(1, len(sizes)))
    cuts = [(r["__lang"], max(r["first"], round(min(1.0, each / max(1, r["n"])) * (1 << 30)))) for r in sizes]
    if any(cut < 1 << 30 for _, cut in cuts):
        bounds = docs.sparkSession.createDataFrame(cuts, "__lang string, __cut long")
        rows = rows.join(F.broadcast(bounds), "__lang").filter(F.col("__order") <= F.col("__cut"))
    rows = rows.select("__key", "__text", "__lang").distinct()
    return rows.select("__text", "__lang", held)


def counted(rows: DataFrame) -> pa.Table:
    """(lang, held, slot, n): the n-grams of ``learnable`` rows."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, bool], np.ndarray] = {}
        for batch in batches:
            texts, kinds = batch.column("__text").to_pylist(), list(zip(batch.column("__lang").to_pylist(), batch.column("__held").to_pylist()))
            for low, high in text_batches(texts):
                block = Words.of(texts[low:high])
                slots, cuts = block.ngrams()
                word_of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
                own = np.repeat(np.arange(high - low), np.diff(block.cuts))
                for kind in dict.fromkeys(kinds[low:high]):
                    mine = np.array([x == kind for x in kinds[low:high]])
                    weight = np.bincount(block.inverse[mine[own]], minlength=len(block.starts))[word_of]
                    got = np.bincount(slots.astype(np.int64), np.concatenate([weight, weight]), SLOTS)
                    found[kind] = found.get(kind, 0) + got
        for (name, held), got in found.items():
            slot = np.flatnonzero(got)
            columns = [pa.array([name] * len(slot), pa.string()), pa.array([held] * len(slot), pa.bool_()), pa.array(slot), pa.array(got[slot].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "held", "slot", "n"])

    prepare(rows.sparkSession)
    # at most 2 * SLOTS rows for each language
    return rows.mapInArrow(count, "lang string, held boolean, slot long, n long").groupBy("lang", "held", "slot").agg(F.sum("n").alias("n")).toArrow()


def model_of(found: pa.Table) -> LanguageModel:
    """The model of n-grams ``counted``."""
    langs = sorted(set(found.column("lang").to_pylist()))
    table = np.full((SLOTS, len(langs)), SMOOTHING)
    index = {x: i for i, x in enumerate(langs)}
    np.add.at(table, (found.column("slot").to_numpy(), [index[x] for x in found.column("lang").to_pylist()]), found.column("n").to_numpy())
    return LanguageModel(langs, np.log(table / table.sum(axis=0)).astype(np.float32) if langs else np.zeros((SLOTS, 0), np.float32))


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int | None = SAMPLE) -> LanguageModel:
    """Fits the n-gram model on about ``sample`` of the rows that may be learned from, or on all."""
    return model_of(counted(learnable(docs, text, lang, key, sample)))


def fit_evidence(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> tuple[LanguageModel, np.ndarray]:
    """The model of ``fit_languages``, and the evidence that a text of each language needs:
    ``FAIR`` of that at the quantile ``LOW`` of the held rows, under a model of the
    other rows; at least 0, also for a language with no held row."""
    rows = stored(learnable(docs, text, lang, key, sample), "langid-sample")
    found = counted(rows)
    part = docs.sparkSession.sparkContext.broadcast(model_of(found.filter(pc.invert(found.column("held")))))

    def weigh(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _, _, gain = part.value.weigh(batch.column("__text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("__lang"), pa.array(gain)], names=["lang", "gain"])

    # a row for each held row of the sample
    held = in_batches(rows.filter("__held").select("__text", "__lang"), weigh, "lang string, gain double").toArrow()
    model, langs, gain = model_of(found), np.array(held.column("lang").to_pylist(), object), held.column("gain").to_numpy()
    needed = np.zeros(len(model.names))
    for i, name in enumerate(model.names):
        own = gain[(langs == name) & np.isfinite(gain)]
        if len(own):
            needed[i] = max(0.0, FAIR * np.quantile(own, LOW))
    return model, needed


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None, out: str = "lang_pred", score: str = "score", gain: str | None = None
) -> DataFrame:
    """``docs`` (its columns ``keep``, by default all) with each whole text's main
    language in ``out`` and its proportion in ``score``; if asked for, in ``gain`` what its mixture
    gains over the background for each n-gram (-inf without a word or a language)."""
    names = docs.columns if keep is None else keep
    rows, inner, fields = carried(docs, names, __text=text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS x languages numbers

    def infer(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m, texts = shared.value, batch.column("__text").to_pylist()
        share, some, *more = m.weigh(texts) if gain else m.infer(texts)
        if m.names:
            first = share.argmax(axis=1)
            found = [m.names[i] if s else UNDETERMINED for i, s in zip(first.tolist(), some.tolist())]
            value = np.clip(np.where(some, share[np.arange(len(share)), first], 0.0), 0.0, 1.0)
        else:
            found, value = [UNDETERMINED] * len(some), np.zeros(len(some))
        columns = [*(batch.column(n) for n in inner), pa.array(found, pa.string()), pa.array(value, pa.float64()), *map(pa.array, more)]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    added = [StructField("__lang", StringType()), StructField("__score", DoubleType()), *[StructField("__gain", DoubleType())] * bool(gain)]
    schema = StructType([*fields, *added])
    return in_batches(rows, infer, schema).toDF(*names, out, score, *[gain] * bool(gain))


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The documents whose language can be told: those that ``identify`` gives a language, with
    the evidence for their mixture that ``fit_evidence`` asks for in that language. Where no row has a language
    to learn, there is no evidence against any document, and all stay. Columns stay as they are."""
    model, needed = fit_evidence(docs, text, lang, key)
    if not model.names:
        return docs
    own = "__"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    found = identify(docs, model, text, out=f"{own}lang", score=f"{own}score", gain=f"{own}gain")
    least = F.create_map(*(F.lit(x) for pair in zip(model.names, needed.tolist()) for x in pair))  # a row for each language, as the model has a column
    told = (F.col(f"{own}lang") != UNDETERMINED) & (F.col(f"{own}gain") >= least[F.col(f"{own}lang")])
    return found.filter(told).drop(f"{own}lang", f"{own}score", f"{own}gain")
