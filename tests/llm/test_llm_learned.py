"""Language ID and toxicity: held-out accuracy and the cases at the edge."""

import math
import random

import numpy as np
from llm_helpers import documents
from pyspark.sql import functions as F

from placeframe.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.1"


def test_languages_of_held_out_documents(spark):
    got = queries.op8_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    row = got.join(docs, "doc_id").filter("held_out").agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).first()
    assert row.n > 2000 and row.right > 0.99
    assert got.filter("score < 0 or score > 1 or score is null or lang_pred is null").isEmpty()


def test_language_edges(spark):
    docs = documents(spark)
    model = langid.fit_languages(docs)
    rows = langid.identify(docs, model, out="found", score="sure").select("doc_id", "text", "found", "sure").collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.found, r.sure) == ("und", 0.0)
        else:
            assert r.found in model.names and 0 <= r.sure <= 1
    unknown = langid.fit_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.found for r in langid.identify(docs, unknown, out="found", score="sure").collect()} == {"und"}
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.filter(~F.col("text").rlike("\\p{L}")).isEmpty()
    assert langid.keep_identified(docs.limit(0)).collect() == []


def test_sample_has_every_language_and_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "FEWEST", 5)
    rows = [(i, f"the words of number {i}", "en") for i in range(3000)] + [(5002, "ett ord", "sv"), (5004, "toinen sana", "fi")]
    rows += [(None, f"no id {i}", "da") for i in range(1000)] + [(6001, "the same row", "it")] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    can = {r.lang for r in docs.filter(~langid.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    assert can == {"en", "sv", "fi", "da", "it"}
    assert set(langid.fit_languages(docs, sample=50).names) == can
    got = {r["__lang"]: r["count"] for r in langid.learnable(docs, "text", "lang", "doc_id", 50).groupBy("__lang").count().collect()}
    assert set(got) == can and got["it"] == 1 and max(got.values()) < 50


def test_junk_of_letters_goes_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = {r.lang: r.text for r in docs.filter("n_chars between 1500 and 3000").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    pick = random.Random(4)
    random_words = lambda n, letters: " ".join("".join(pick.choice(letters) for _ in range(pick.randint(5, 10))) for _ in range(n))
    bad = [random_words(n, letters) for letters in ("abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz") for n in (20, 80, 400)]
    bad += ["xqzvkw", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności"]
    good = [own["en"] + "\n" + own["fr"], "\n".join(own.values()), own["de"][:40], own["es"].upper(), "the", "und die"]
    more = [(900_000 + i, t, "en", "src0", len(t)) for i, t in enumerate(bad)] + [(910_000 + i, t, None, "src0", len(t)) for i, t in enumerate(good)]
    kept = langid.keep_identified(docs.union(spark.createDataFrame(more, docs.schema)))
    assert {r.doc_id for r in kept.filter("doc_id >= 900000").select("doc_id").collect()} == set(range(910_000, 910_000 + len(good)))
    assert kept.filter("doc_id < 900000").count() == docs.count()


def test_mixture_of_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_languages(docs)
    one = {r.lang: r.text for r in docs.filter("n_chars between 1500 and 3000").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    share, some = model.infer([one["en"], one["en"] + "\n" + one["fr"], None])
    names = model.names
    assert some.tolist() == [True, True, False]
    assert share[0, names.index("en")] > 0.95
    both = len(one["fr"].split()) / len((one["en"] + " " + one["fr"]).split())
    assert abs(share[1, names.index("fr")] - both) < 0.15


def test_toxicity_of_held_out_documents(spark):
    got = queries.op1_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out")
    row = got.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("found"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("wrong"), F.count("*").alias("n")
    ).first()
    assert row.n > 500 and row.found > 0.85 and row.wrong < 0.03


def test_toxicity_edges(spark):
    docs = documents(spark, [(1000 + i, "you idiot " + "word " * i if i % 2 else "kind friend " + "word " * i, "en", "a", 1) for i in range(80)])
    labels = spark.createDataFrame([(1000 + i, 1, i % 2) for i in range(80)] + [(None, 1, 1), (5, None, None), (1001, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, model, out="found").collect()
    assert len(rows) == docs.count() and all(0 <= r.found <= 1 for r in rows)
    judged = [(r.found >= toxicity.AT) == bool(r.doc_id % 2) for r in rows if r.doc_id is not None and r.doc_id >= 1000]
    assert sum(judged) / len(judged) > 0.95
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r.found for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none), out="found").collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), model).collect() == []


def test_scores_do_not_read_labels_or_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = langid.held_out(F.col("doc_id"))
    a = toxicity.fit_toxicity(docs, labels)
    b = toxicity.fit_toxicity(docs.withColumn("lang", F.when(~out, F.col("lang"))), labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    texts = [r.text for r in docs.select("text").limit(200).collect()]
    assert a.scores(texts).tolist() == b.scores(texts).tolist()


def test_without_a_learnable_language_all_documents_stay(spark):
    from pyspark.sql import functions as F

    from placeframe.llm.langid import keep_identified

    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_stages_take_any_column_name(spark):
    from placeframe.llm.langid import keep_identified
    from placeframe.llm.toxicity import keep_clean

    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    for kept in (keep_identified(docs), keep_clean(docs, labels)):
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).isEmpty()


def plain_mixture(scores):
    """Proportions by expectation-maximisation, number by number."""
    names = range(len(scores[0]))

    def maximise(share, rounds):
        for i in range(rounds + 1):
            post = [[math.exp(row[k] - max(row)) * share[k] for k in names] for row in scores]
            if i == rounds:
                return share, sum(math.log(sum(p)) for p in post)
            share = [sum(p[k] / sum(p) for p in post) / len(scores) for k in names]

    share, _ = maximise([1 / len(names)] * len(names), langid.ROUNDS)
    alone = [sum(row[k] - max(row) for row in scores) for k in names]
    value = max(alone)
    best = [float(k == alone.index(value)) for k in names]
    order = sorted(names, key=lambda k: -share[k])
    for size in range(2, min(langid.MOST, len(names)) + 1):
        start = [(share[k] + 1e-6) * (k in order[:size]) for k in names]
        fitted, fit = maximise([x / sum(start) for x in start], 2)
        fit -= langid.PENALTY * (size - 1) * math.log(len(scores) + 1)
        if fit > value:
            value, best = fit, fitted
    return best


def test_mixture_is_plain_expectation_maximisation():
    r = np.random.default_rng(8)
    texts = []
    for n, true in ((1, [0]), (40, [1]), (60, [0, 2]), (200, [0, 1, 3]), (25, [3])):
        scores = r.normal(-30, 1, (n, 4))
        scores[np.arange(n), [true[i % len(true)] for i in range(n)]] += 9
        texts.append(scores.astype(np.float32))
    got = langid.mixture(np.concatenate(texts), np.cumsum([0, *map(len, texts)]))
    want = np.array([plain_mixture(t.astype(float).tolist()) for t in texts])
    assert np.allclose(got, want, atol=1e-4)
    assert (want > 0).sum(axis=1).tolist() == [1, 1, 2, 3, 1]


def plain_logit(parts, rows):
    """The network's output for one document, place by place; ``rows`` as in ``train``."""
    embedding, filters, bias, weights, offset = parts
    words = [embedding[a] + embedding[b] for a, b in rows.T]
    out, k = offset, 0
    for w in filters:
        for f in range(w.shape[2]):
            peak = max((sum(words[p + o] @ w[o, :, f] for o in range(len(w)) if p + o < len(words)) for p in range(len(words))), default=0.0)
            out += max(peak + bias[k], 0.0) * weights[k]
            k += 1
    return out


def test_network_is_the_plain_one_and_a_step_follows_its_gradient(monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 40)
    net = toxicity.Network.fresh()
    r = np.random.default_rng(1)
    rows = [np.stack([r.integers(0, 40, n), r.integers(40, 80, n)]) for n in (1, 2, 5, 9, 0, 3)]
    labels = np.array([1, 0, 1, 0, 0, 1])
    parts = [net.embedding.astype(float), [w.astype(float) for w in net.filters], net.bias.astype(float), net.weights.astype(float), net.offset]
    # forward: the same documents as words
    words = np.unique(np.concatenate(rows, axis=1), axis=1, return_inverse=True)
    vectors = np.vstack([net.embedding[words[0][0]] + net.embedding[words[0][1]], np.zeros((1, toxicity.SIZE), np.float32)])
    cuts = np.cumsum([0, *(x.shape[1] for x in rows)])
    got = np.maximum(net.pooled(vectors, words[1].ravel(), cuts) + net.bias, 0) @ net.weights + net.offset
    assert np.allclose(got, [plain_logit(parts, x) for x in rows], atol=1e-5)

    def loss():
        share = np.bincount(labels) / len(labels)
        z = [plain_logit(parts, x) for x in rows]
        return sum(0.5 / share[y] * (math.log1p(math.exp(v)) - y * v) for v, y in zip(z, labels.tolist())) / len(labels)

    def moved(values, at):
        """Where one step of Adagrad takes a number, by its numerical gradient."""
        old, small = values[at], 1e-5
        values[at] = old + small
        up = loss()
        values[at] = old - small
        g = (up - loss()) / (2 * small)
        values[at] = old
        return old - toxicity.RATE * g / math.sqrt(1e-2 + g * g)

    want = [(net.weights, k, moved(parts[3], k)) for k in (0, 7, len(parts[3]) - 1)] + [(net.bias, k, moved(parts[2], k)) for k in (3, 11)]
    for i, w in enumerate(net.filters):
        want += [(w, at, moved(parts[1][i], at)) for at in ((0, 2, 1), (i, 5, 4))]
    both = [int(rows[2][0, 1]), int(rows[2][1, 3])]
    want += [(net.embedding, (k, d), moved(parts[0], (k, d))) for k in both for d in (0, 3)]
    monkeypatch.setattr(toxicity, "BATCH", 100)
    net.train(rows, labels, visits=len(rows))
    for values, at, end in want:
        assert abs(values[at] - end) < 2e-3 * toxicity.RATE + 1e-5, (at, values[at], end)


def test_every_labelled_document_teaches(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 1500)
    monkeypatch.setattr(toxicity, "VISITS", 3000)
    n = 9000  # more of each label than the bound that once was
    spell = lambda i: "".join(chr(97 + int(d)) for d in str(i)) + "q" * 4
    docs = spark.createDataFrame([(i, f"{'awful' if i % 2 else 'lovely'} {spell(i)}", "en") for i in range(n)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    keys = docs.withColumnRenamed("doc_id", "__key").filter(~langid.held_out(F.col("__key")))
    for held in (True, False):
        own = [spell(r["__key"]) for r in keys.filter((toxicity._hashed("held", toxicity.HOLD) == 0) == held).collect()]
        whole = toxicity.buckets(langid.Words.of(own))[0]
        seen = model.network.embedding[whole].any(axis=1).mean()
        assert len(own) > 1000 and (seen < 0.1 if held else seen == 1.0)
    assert {r.doc_id % 2: r.n for r in toxicity.score_toxicity(docs, model).filter("score >= 0.3").groupBy((F.col("doc_id") % 2).alias("doc_id")).agg(F.count("*").alias("n")).collect()} == {1: n // 2}


def test_languages_of_all_rows(spark):
    docs = spark.createDataFrame([(i, "abc" if i % 2 else "xyz", "en" if i % 2 else "sv") for i in range(3000)], "doc_id long, text string, lang string")
    assert langid.learnable(docs, "text", "lang", "doc_id", None).count() == docs.filter(~langid.held_out(F.col("doc_id"))).count()
    assert langid.fit_languages(docs, sample=None).names == ["en", "sv"]


def test_shards_networks_are_averaged(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BUCKETS", 40)
    net, one, two = (toxicity.Network.fresh() for _ in range(3))
    one.embedding[3] += 1
    two.offset -= 0.5
    two.filters[2][1, 2, 3] += 2
    seen = np.zeros(81, bool)
    for other in (one, two):
        seen[[3, 5]] = True
        rows, by = other.moved(net, seen)
        assert rows[:2].tolist() == [3, 5] and (by[1] == 0).all()
        again = toxicity.Network.fresh()
        again.move(rows, by / toxicity.UNIT)
        for a, b in zip([again.embedding, *again.filters, again.bias, again.weights, again.offset], [other.embedding, *other.filters, other.bias, other.weights, other.offset]):
            assert np.allclose(a, b, atol=1e-6)


def test_documents_are_kept_by_the_mixture_inferred(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    own = {r.lang: r.text for r in docs.filter("n_chars between 1500 and 3000").groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    model, needed = langid.fit_evidence(docs)
    texts = [own["en"], own["en"] + "\n" + own["fr"], "Wszyscy ludzie", "12 !", None]
    share, some, gain = model.weigh(texts)
    assert [x.tolist() for x in model.infer(texts)] == [share.tolist(), some.tolist()]
    for t, s, g in zip(texts, share.astype(float), gain):
        block = langid.Words.of([t])
        logs = (block.likelihoods(model.table) * langid.SCALE)[block.inverse].astype(float)
        grams = sum(2 * int(block.ends[w] - block.starts[w] + 1) for w in block.inverse)
        fit = sum(math.log(sum(p * math.exp(x - max(row)) for p, x in zip(s, row))) + max(row) for row in logs.tolist())
        assert g == -np.inf if not grams else abs(g - (fit / langid.SCALE / grams + math.log(langid.SLOTS))) < 1e-3
    more = docs.union(spark.createDataFrame([(900_000 + i, t, None, "src0", 0) for i, t in enumerate(texts)], docs.schema))
    model, needed = langid.fit_evidence(more)
    found = langid.identify(more, model, keep=["doc_id"], gain="gain").collect()
    want = {r.doc_id for r in found if r.lang_pred != "und" and r.gain >= needed[model.names.index(r.lang_pred)]}
    assert {r.doc_id for r in langid.keep_identified(more).select("doc_id").collect()} == want
    assert {900_000, 900_001} <= want and not {900_003, 900_004} & want
