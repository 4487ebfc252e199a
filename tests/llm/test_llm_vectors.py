"""Nearest neighbours and near-duplicate vectors against brute force."""

import numpy as np
from llm_helpers import vectors
from pyspark.sql import functions as F

from placeframe.llm import ann, queries, vector_dedup


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def exact_nearest(rows, count=10):
    """(query, rank, id, distance) by comparing everything."""
    rows = sorted({(i, tuple(v)) for i, v in rows if usable(v)}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for q, x in rows:
        if q is None or q % 100:
            continue
        near = sorted((float(np.sqrt(((np.array(y) - np.array(x)) ** 2).sum())), i is None, i or 0) for i, y in rows if len(y) == len(x) and i != q)
        out += [(q, k + 1, None if none else i, d) for k, (d, none, i) in enumerate(near[:count])]
    return out


def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want = exact_nearest(rows)
    got = queries.op5_nearest(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == len(want)
    exact = {(q, i): d for q, _, i, d in want}
    found = [(r.query_id, r.vec_id) for r in got]
    assert len(set(found) & set(exact)) >= 0.9 * len(exact)
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-9 for r in got if (r.query_id, r.vec_id) in exact)
    for q in {r.query_id for r in got}:
        own = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [x[0] for x in own] == list(range(1, 11)) and own == sorted(own, key=lambda x: (x[1], x[2]))


def test_edges_of_search(spark):
    df = vectors(spark)
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    # with few rows in the tables every query is compared with all rows
    got = ann.search(df, F.col("id") % 100 == 0, tables=1, probed=1)
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.collect()) == sorted((q, k, i, round(d, 9)) for q, k, i, d in exact_nearest(rows))
    assert ann.search(df.limit(0), F.col("id") % 100 == 0).collect() == []


def test_blocks_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(ann, "BASE_BLOCK", 7)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rows = [(i, [1.0, 0.5, 0.25, i * 1e-6]) for i in range(0, 400, 2)] + [(i, [-1.0, 0.5, float(i % 3), 1.0]) for i in range(1, 400, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("id") % 100 == 0).collect()
    want = exact_nearest(rows)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted((q, k, i) for q, k, i, _ in want)


def test_repeated_rows_count_once(spark):
    rows = [(i, [1.0, 0.5, 0.25, i * 1e-6]) for i in range(0, 400, 2)]
    # each a neighbour of a query; the last is repeated with both signs of zero
    rows += [rows[51]] * 20 + [rows[102]] * 20 + [(500, [1.0, 0.5, 0.25, 0.0])] * 12 + [(500, [1.0, 0.5, 0.25, -0.0])] * 12
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted((q, k, i) for q, k, i, _ in exact_nearest(rows))
    for how in ({}, {"tables": 1, "probed": 1}):  # through the tables
        assert sorted((r.query_id, r.rank, r.vec_id) for r in ann.search(df, F.col("id") % 100 == 0, **how).collect()) == want
    # every other row has a signed axis of its own, so that the tables give the queries too little
    far = [(i, [float(i == 3 + k) * (1 + i / 100) for k in range(16)]) for i in range(3, 19)]
    rows = [(0, [1.0] * 16), (100, [-1.0] * 16), *far * 20]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("id") % 100 == 0, tables=1, probed=1).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted((q, k, i) for q, k, i, _ in exact_nearest(rows))


def brute_links(rows, least=0.9):
    unit = [np.array(v) / np.linalg.norm(v) if usable(v) else None for _, v in rows]
    links = [[j for j, y in enumerate(unit) if j != i and x is not None and y is not None and len(x) == len(y) and x @ y >= least] for i, x in enumerate(unit)]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((str(rows[i][0]), len(links[i]), str(min(ids) if ids else None)))
    return sorted(out)


def test_near_duplicate_vectors(spark, monkeypatch):
    df = vectors(spark)
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got = vector_dedup.near_duplicates(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert vector_dedup.near_duplicates(df.limit(0)).collect() == []
    # a cluster that fills its filters, compared in small blocks
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    r = np.random.default_rng(2)
    centre = r.standard_normal(64)
    rows = [(i, [float(x) for x in centre + 0.25 * r.standard_normal(64)]) for i in range(120)]
    rows += [(1000 + i, [float(x) for x in r.standard_normal(64)]) for i in range(100)]
    got = vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = brute_links(rows)
    missing = sum(w[1] for w in want) - sum(g.n_links for g in got)
    assert 0 <= missing <= 0.01 * sum(w[1] for w in want)  # the filters' misses only
    assert sorted((str(g.vec_id), str(g.component_id)) for g in got) == [(w[0], w[2]) for w in want]


def test_candidates_grow_slower_than_the_rows():
    share = []
    for n in (500, 2000, 8000):
        x = np.random.default_rng(n).standard_normal((n, 64))
        q, found = x[: 40], np.zeros((40, n), bool)
        work = 0
        for t in range(ann.TABLES):
            own, asked = ann.buckets(x, t, n), ann.probes(q, t, n, ann.probe_count(n))
            assert (asked[:, :, None] == own[:40, None, None]).any(axis=1).all()  # its own bucket is the nearest
            hit = np.stack([np.isin(own, a) for a in asked])
            work += hit.sum()
            found |= hit
        share.append(work / 40 / n)
        d = ((q[:, None] / np.linalg.norm(q, axis=1)[:, None, None] - x[None] / np.linalg.norm(x, axis=1)[None, :, None]) ** 2).sum(axis=2)
        near = np.argsort(d, axis=1)[:, 1:11]
        assert np.take_along_axis(found, near, axis=1).mean() > 0.93
    assert share[1] < 0.8 * share[0] and share[2] < 0.8 * share[1]


def test_filters_hold_few_vectors_and_miss_few_pairs_at_any_size():
    r = np.random.default_rng(6)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    x, y = (unit(r.standard_normal((1500, 64))) for _ in range(2))
    y = 0.9 * x + np.sqrt(1 - 0.81) * unit(y - (y * x).sum(axis=1, keepdims=True) * x)
    for n in (2000, 50_000, 400_000):
        words = vector_dedup.codewords_for(n)
        a, b = ({*zip(*(v.tolist() for v in vector_dedup.decoded(m, words)))} for m in (x, y))
        assert len({row for row, _ in a & b}) >= 0.998 * len(x)
        held = len(a) / (vector_dedup.ROTATIONS * words**2) * n / len(x)
        assert held < 2 * vector_dedup.HELD
