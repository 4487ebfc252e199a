"""Every stage of the pipeline against a plain version of it, on its own input."""

import hashlib
import math
from collections import Counter

import corpus_pipeline as cp
from llm_helpers import documents
from pyspark.sql import functions as F
from test_llm_minhash import brute_classes
from test_llm_tokens import ids_of

from placeframe.llm import langid, minhash, mixing, toxicity
from placeframe.llm.common import settled, stored
from placeframe.session import folder_names, shared_root

SF = "/root/testdata/sf0.001"


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return Counter((str(r.doc_id), r.text) for r in df.select("doc_id", "text").collect())


def expected_language(spark, docs):
    """Word by word: the gain of each word's best language over equally likely n-grams."""
    model, needed = langid.fit_evidence(docs)
    out = Counter()
    for i, t in texts_of(docs):
        block = langid.Words.of([t])
        gain, grams, total = 0.0, 0, [0.0] * len(model.names)
        scores = block.likelihoods(model.table)
        for w in block.inverse.tolist():
            n = 2 * int(block.ends[w] - block.starts[w] + 1)
            gain += max(scores[w].tolist()) + n * math.log(langid.SLOTS)
            grams += n
            total = [a + b for a, b in zip(total, scores[w].tolist())]
        if grams and gain / grams >= needed[total.index(max(total))]:
            out[str(i), t] += 1
    return out


def expected_toxicity(spark, docs):
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    pairs = texts_of(docs)
    return Counter((str(i), t) for (i, t), s in zip(pairs, model.scores([t for _, t in pairs])) if s < toxicity.AT)


def expected_dedup(spark, docs):
    pairs = sorted(set(texts_of(docs)), key=lambda p: (p[0] is None, p[0] or 0, hashlib.md5((p[1] or "").encode()).hexdigest()))
    weights = minhash.fit_weights(docs.select(F.col("text").alias("__text")))
    classes = brute_classes([t for _, t in pairs], weights)
    return Counter((str(i), t) for k, (i, t) in enumerate(pairs) if classes[k] == k)


def expected_mix(spark, docs):
    by_source = {}
    for r in docs.select("source", "doc_id", "text").collect():
        by_source.setdefault(r.source or "", []).append((r.doc_id, r.text))
    order = sorted(by_source)
    weights = mixing.derived_weights({s: len(x) for s, x in by_source.items()})
    blocks = {}
    for s, own in by_source.items():
        own.sort(key=lambda p: (p[0] is not None, p[0] or 0))
        blocks[s] = [own[i : i + mixing.BLOCK] for i in range(0, len(own), mixing.BLOCK)]
    schedule = [order[x[0]] for x in mixing.period_schedule([weights[s] for s in order])]
    out, placed, waiting = Counter(), Counter(), set(order)
    slot = 0
    while waiting:
        s = schedule[slot % len(schedule)]
        out.update((str(i), t) for i, t in blocks[s][placed[s] % len(blocks[s])])
        placed[s] += 1
        if placed[s] == len(blocks[s]):
            waiting.discard(s)
        slot += 1
    return out


EXPECTED = [expected_language, expected_toxicity, expected_dedup, expected_mix]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(900_000, "12 34 !!", "en", "src0", 8), (900_001, None, None, None, 0), (900_002, "", "en", "src1", 0)], docs.schema)
    docs = stored(docs.union(junk), "t-pipeline")
    names = docs.columns
    sizes = [docs.count()]
    for (name, stage), expected in zip(cp.STAGES, EXPECTED):
        got = stored(stage(spark, docs, SF), f"t-{name}")
        assert got.columns == names and rows(got) == expected(spark, docs), name
        docs = got
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[4] >= sizes[3]
    want = Counter((str(i), len(ids_of(t)), hashlib.sha256(",".join(map(str, ids_of(t))).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts_of(docs))
    last = cp.STAGES[-1][1](spark, docs, SF)
    assert Counter((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in last.collect()) == want


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["language_id", "toxicity", "minhash_near_dedup", "mixing", "bpe_codec"]


def test_edges_go_through_every_stage(spark):
    for docs in (documents(spark), documents(spark).limit(0)):
        for _, stage in cp.STAGES:
            docs = stored(stage(spark, docs, SF), "t-edges")
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run(spark):
    got = cp.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < got.count()
    assert got.join(docs, "doc_id", "left_anti").isEmpty()


def test_queries_are_registered():
    import __spark_entry__ as entry

    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_tables_on_the_way_are_removed(spark):
    root = f"{shared_root(spark)}/placeframe"
    before = {*folder_names(spark, root)}
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('text ', id) AS text", "concat('s', id % 3) AS source")
    out = settled(spark, lambda: mixing.mixed(docs), "t-settled")
    left = {*folder_names(spark, root)} - before
    assert len(left) == 1 and next(iter(left)).startswith("t-settled") and out.count() >= 50
