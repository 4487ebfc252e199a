"""Token files against the tokenizers library, and round trips of the format."""

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents, edge_texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placeframe.llm.queries import op12_token_files
from placeframe.llm.token_files import Encoder, FileWriter, TokenFile, plain_specials, read_token_files, restored, shuffled, token_file_digests, write_token_files

SF_SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, "rb") as f:
    RAW = f.read()


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=70), st.sampled_from([1, 8]))
def test_planes_round_trip(ids, bits):
    ids = np.array(ids, np.uint32)
    planes = shuffled(ids, bits)
    assert len(planes) == 32 // bits
    if len(ids):
        assert restored([p.tobytes() for p in planes], len(ids), bits).tolist() == ids.tolist()


def made(docs, **how):
    w = FileWriter(**how)
    flat = np.array([x for _, ids in docs for x in ids], np.uint32)
    records = [*w.add([i for i, _ in docs], flat, np.cumsum([0, *(len(ids) for _, ids in docs)])), *w.end()]
    return b"".join(r + b"\n" for r in records)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 1 << 60)), st.lists(st.integers(0, 70_000), max_size=30)), max_size=12), st.sampled_from([1, 8]), st.integers(1, 20))
def test_files_round_trip(docs, bits, block):
    held = TokenFile(made(docs, bits=bits, block=block))
    flat = [x for _, ids in docs for x in ids]
    assert [(None if held.null[i] else int(held.doc_ids[i]), np.concatenate([np.zeros(0), *parts]).tolist()) for i, parts in held.documents()] == docs
    for a in range(0, len(flat) + 1, 3):
        for b in range(a, len(flat) + 1, 5):
            assert held.ids(a, b).tolist() == flat[a:b]


def test_a_range_touches_its_blocks_alone():
    raw = bytearray(made([(1, list(range(1000)))], block=100))
    held = TokenFile(bytes(raw))
    raw[held.blocks[5, 0] + 3] ^= 1  # damages block 5
    held = TokenFile(bytes(raw))
    assert held.ids(600, 700).tolist() == list(range(600, 700))
    with pytest.raises(Exception):  # noqa: B017 - zstandard's own error, or ours
        held.ids(590, 601)
    with pytest.raises(ValueError, match="no token file"):
        TokenFile(bytes(raw)[:-3])


def test_encoder_is_the_library():
    texts = edge_texts()
    for cached in (3, 400_000):
        flat, bounds = Encoder(RAW, cached).encode(texts)
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(t) for t in texts]


def test_other_settings_go_by_whole_texts():
    data = json.loads(RAW)
    assert plain_specials(data) == {"<|endoftext|>": 50256}
    data["pre_tokenizer"]["add_prefix_space"] = True
    assert plain_specials(data) is None
    raw = json.dumps(data).encode()
    texts = ["one two", "", None, "  x"]
    flat, bounds = Encoder(raw).encode(texts)
    library = Tokenizer.from_str(raw.decode())
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def want(docs):
    """(doc_id, start, ids) in the order of the files; equal ids in any order of their texts."""
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.tie, [*ids_of(r.text), 2]) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect()), key=lambda r: r[:3])
    out, at = [], 0
    for some, i, _, ids in rows:
        out.append((i if some else None, at, ids))
        at += len(ids)
    return out


@pytest.mark.parametrize(("bits", "block", "file_bytes"), [(8, 1 << 16, 1 << 25), (1, 1000, 60_000)])
def test_tables(spark, scratch, bits, block, file_bytes):
    docs = documents(spark).withColumn("a.b", F.lit("clash"))
    write_token_files(docs, scratch, PATH, end=2, bits=bits, block=block, file_bytes=file_bytes)
    expected = want(docs)
    back = sorted(read_token_files(spark, scratch).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.ids) for r in back] == expected
    sums = sorted(token_file_digests(spark, scratch).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sums] == [(i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, at, ids in expected]


def test_empty_table(spark, scratch):
    write_token_files(documents(spark).limit(0), scratch, PATH, end=2)
    assert read_token_files(spark, scratch).collect() == []
    assert token_file_digests(spark, scratch).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(op12_token_files(spark, SF_SMALL).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == [(i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, at, ids in want(docs)]
