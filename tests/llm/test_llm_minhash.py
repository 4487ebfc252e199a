"""MinHash near-dedup against brute force over the whole table."""

import numpy as np
from llm_helpers import documents, sentence
from pyspark.sql import functions as F

from placeframe.llm import minhash as mh


def brute_classes(texts, weights, least=mh.SIMILARITY):
    """The smallest index of each text's class; texts without a word are alone."""
    hashes, tf, cuts = mh.shingles(texts)
    steps = weights.steps(hashes, tf)
    sets = [dict(zip(hashes[a:b].tolist(), steps[a:b].tolist())) for a, b in zip(cuts, cuts[1:])]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and min(len(x), len(y)) >= 0.5 * max(len(x), len(y)):
                both = sum(min(w, y[k]) for k, w in x.items() if k in y)
                if both and both >= least * (sum(x.values()) + sum(y.values()) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    weights = mh.fit_weights(docs.select(F.col("text").alias("__text")))
    want = brute_classes([r.text for r in rows], weights)
    got = mh.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    classes = {}
    for r, c in zip(rows, want):
        classes.setdefault(c, []).append(r)
    expected = sorted((str(m.doc_id), str(rows[c].doc_id), len(ms)) for c, ms in classes.items() for m in ms)
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in got) == expected
    return rows, want


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_edges_and_one_document_of_each_class(spark):
    docs = documents(spark)
    rows, want = check(docs)
    kept = mh.keep_one(docs)
    assert kept.columns == docs.columns
    worded = {c for r, c in zip(rows, want) if r.text and any(x.isalnum() for x in r.text)}
    alone = sum(1 for r in rows if not (r.text and any(x.isalnum() for x in r.text)))
    assert kept.count() == len(worded) + alone
    assert mh.near_duplicates(docs.limit(0)).collect() == [] and mh.keep_one(docs.limit(0)).collect() == []


def test_large_group_of_near_copies_is_one_class(spark):
    base = sentence(7, 300).split()
    rows = []
    for i in range(400):
        words = list(base)
        words[(i * 7) % 300] = f"edit{i}"
        words[(i * 13 + 5) % 300] = f"other{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, sentence(500 + i, 100)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in mh.near_duplicates(docs).collect()}
    assert {got[i].class_id for i in range(400)} == {0} and got[0].kept and not got[1].kept
    assert all(got[1000 + i].kept and got[1000 + i].class_size == 1 for i in range(300))


def test_blocks_find_the_links_that_pairs_have(spark, monkeypatch):
    """With small blocks the result is the same."""
    monkeypatch.setattr(mh, "BLOCK", 8)
    base = sentence(3, 60).split()
    rows = []
    for i in range(120):
        words = list(base)
        for k in range(4):
            words[(i * 11 + k * 17) % 60] = f"edit{i % 40}x{k}"
        rows.append((i, " ".join(words + words[:20] * (i % 3))))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_samples_agree_as_often_as_the_weighted_similarity():
    r = np.random.default_rng(1)
    shared, own = r.integers(0, 1 << 63, 300, dtype=np.uint64), r.integers(0, 1 << 63, 60, dtype=np.uint64)
    x, y = np.concatenate([shared, own[:30]]), np.concatenate([shared, own[30:]])
    wx, wy = r.integers(32, 96, 330), r.integers(32, 96, 330)
    wy[:300] = wx[:300]
    want = mh.similarity((np.sort(x), wx[np.argsort(x)]), (np.sort(y), wy[np.argsort(y)]))
    keys = mh.Sampler((2000, 1)).bands(np.concatenate([x, y]), np.concatenate([wx, wy]), np.array([0, 330, 660]))
    assert abs((keys[0] == keys[1]).mean() - want) < 0.04


def test_connected_with_a_hub(spark):
    """A node with most of the links: its links are dealt over groups, the components are right."""
    import random

    from placeframe.llm import common

    r = random.Random(4)
    links = [("m", f"n{i:04d}") for i in range(1200)]  # a hub that isn't the smallest node
    links += [(f"a{i:03d}", f"a{i + 1:03d}") for i in range(60)] + [("a060", "n0007")]  # a chain into it
    links += [(f"x{r.randrange(300)}", f"x{r.randrange(300)}") for _ in range(200)] + [("m", "m"), ("b", "b")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {x.node: x.root for x in common.connected(spark.createDataFrame(links, "a string, b string").repartition(5), "a", "b", "hub-test").collect()}
    assert got == {x: find(x) for x in root}


def test_one_text_and_one_class_with_a_third_of_the_rows(spark):
    from llm_helpers import sentence

    from placeframe.llm.minhash import near_duplicates

    base = sentence(7, 300).split()
    near = [" ".join([*base[: i % 290], f"edit{i}", *base[i % 290 + 1 :]]) for i in range(120)]
    rows = [(i, t) for i, t in enumerate([*near, *[sentence(500, 120)] * 120, *(sentence(1000 + i, 90) for i in range(120))])]
    got = {r.doc_id: (r.class_id, r.class_size) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == {i: (0, 120) if i < 120 else (120, 120) if i < 240 else (i, 1) for i in range(360)}
