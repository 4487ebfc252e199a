"""Fill-in-the-middle against slicing of each text by itself."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents, sentence
from pyspark.sql import functions as F

from placeframe.llm import fim
from placeframe.llm.queries import op13_fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, rate=50, spm=80, seed=42):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = UNIT.findall(text)
    sha = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(sha[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def vectorized(texts, draws, rate=100, spm=50):
    data, bounds = fim.laid(pa.array(texts, pa.string()))
    n, form, first, second = fim.cut(data, bounds, np.array(draws, np.int64), rate, spm)
    out, outs = fim.scatter(data, bounds, form, first, second)
    back, again = fim.gather(out, outs, form)
    assert fim.strings(back, again).to_pylist() == [t or "" for t in texts]
    return n, form, fim.strings(out, outs).to_pylist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet=st.one_of(st.sampled_from("ab <P>SM\t\n\x0b\x1c é漢🎉"), st.characters(codec="utf-8")), max_size=25)), st.tuples(*[st.integers(0, 2**32 - 1)] * 4)), min_size=1, max_size=8), st.integers(1, 40))
def test_any_text(rows, piece):
    whole = fim.SLICE
    fim.SLICE = piece  # shifts in slices of any size
    try:
        n, form, outputs = vectorized([t for t, _ in rows], [d for _, d in rows])
    finally:
        fim.SLICE = whole
    for i, (text, d) in enumerate(rows):
        text = text or ""
        units = UNIT.findall(text)
        assert n[i] == len(units)
        a, b = sorted(x % (len(units) + 1) for x in d[:2])
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
            assert outputs[i] == text and form[i] == fim.PLAIN
        else:
            assert outputs[i] == (f"<S>{s}<P>{p}<M>{m}" if d[3] % 100 < 50 else f"<P>{p}<S>{s}<M>{m}")


def test_wrong_marks_raise():
    for form, output in ((fim.PSM, "<S>a<P>b<M>c"), (fim.SPM, "<P>a<S>b<M>c"), (fim.PSM, "<P>a<S>b"), (fim.PSM, "<P>a<S>b<M>c<M>d"), (fim.SPM, "")):
        with pytest.raises(ValueError, match="marks"):
            fim.gather(*fim.laid(pa.array([output])), np.array([form]))


def test_documents(spark):
    docs = documents(spark).withColumn("a.b", F.lit("clash")).withColumn("output", F.lit("clash")).withColumn("hash", F.lit("clash"))
    by = ["doc_id", "text"]
    made = fim.fill_in_middle(docs.withColumn("own", F.col("text")), keep=["doc_id", "own", "a.b"], rate=90)
    rows = [(r.doc_id, r.own, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()]
    key = lambda r: tuple(map(repr, r))
    assert sorted(rows, key=key) == sorted(((r.doc_id, r.text, *plain(r.doc_id, r.text, rate=90)) for r in docs.select(*by).collect()), key=key)
    assert {r[3] for r in rows} == {"plain", "psm", "spm"}
    back = fim.restore_middle(made, out="back").collect()
    assert [r.back for r in back] == [r.own or "" for r in back] and len(back) == len(rows)
    assert fim.fill_in_middle(docs.drop("n", "output")).columns[:1] == ["doc_id"]


def test_long_text_and_empty_table(spark):
    long = " ".join([sentence(99, 60_000)] * 8) + " \n"  # over one slice
    assert len(long) > 2 * fim.SLICE
    docs = spark.createDataFrame([(i, long) for i in range(6)], "doc_id long, text string")
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fim.fill_in_middle(docs, rate=100).collect()}
    assert got == {i: plain(i, long, rate=100) for i in range(6)}
    assert fim.restore_middle(fim.fill_in_middle(docs.limit(0))).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        n, form, p, m, output = plain(r.doc_id, r.text)
        want[r.doc_id] = (n, form, p, m, sha(output), sha(r.text or ""))
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in op13_fim(spark, sf).collect()}
    assert got == want and {v[1] for v in want.values()} == {"plain", "psm", "spm"}
