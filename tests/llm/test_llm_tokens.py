"""Token counts and the BPE codec against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import documents, edge_texts
from tokenizers import Tokenizer

from placeframe.llm.bpe_codec import Codec, Lexicon, decode_documents, encode_documents
from placeframe.llm.pieces import parse_vocabulary, parts_of
from placeframe.llm.queries import codec_digests
from placeframe.llm.token_count import Counter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, "rb") as f:
    VOCABULARY = parse_vocabulary(f.read())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_edge_texts():
    texts = edge_texts()
    want = [ids_of(t) for t in texts]
    assert Counter(VOCABULARY).counts(texts).tolist() == [len(w) for w in want]
    lexicon = Lexicon.build({w.encode(): ids_of(w) for w in ("the", " quick", "quick", "a", " brown", " browner", "same")})
    codec = Codec(VOCABULARY, lexicon)
    flat, bounds = codec.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert codec.decode(flat, bounds) == [t or "" for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("a's trevldm'\n\t  1½.<|>　\x1c\u0085é"), st.characters(codec="utf-8"))), max_size=4))
def test_any_text(texts):
    want = [ids_of(t) for t in texts]
    assert Counter(VOCABULARY, cached=3).counts(texts).tolist() == [len(w) for w in want]
    flat, bounds = Codec(VOCABULARY, Lexicon.build({})).encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_long_texts_are_cut_where_pieces_begin():
    text = "word " * 50 + "   x\n\n y's " + "tail " * 30
    parts = parts_of([text], {}, long=20)
    assert len(parts.texts) > 5 and "".join(parts.texts) == text
    assert sum(len(ids_of(p)) for p in parts.texts) == len(ids_of(text))


def plainly_merged(piece):
    """The lowest-ranked adjacent pair is looked for from the start after every merge."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while found := [(VOCABULARY.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in VOCABULARY.ranks]:
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [VOCABULARY.ids[p] for p in parts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=40), st.text(alphabet="aet hing", max_size=300).map(str.encode)), max_size=6))
def test_pieces_merge_together_as_each_alone(pieces):
    pieces = [*pieces, b"", b"a" * 255, b"ab" * 129, b"the" * 200]
    want = [plainly_merged(p) for p in pieces]
    flat, sizes = VOCABULARY.encoded(pieces)
    assert sizes.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]
    assert [VOCABULARY.encoded_long(p) for p in pieces] == want
    lexicon = Lexicon.of(VOCABULARY, pieces)
    assert sorted(lexicon.ids.tolist()) == sorted(i for p in {*pieces} for i in plainly_merged(p))


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): [i, i + 1][: 1 + i % 2] for i, w in enumerate(["tap", "taps", "top", "tops", "stops", "a", "é"])}
    lexicon = Lexicon.build(words)
    assert len(lexicon.finals) == 10  # a trie has 16; suffixes are shared
    lexicon.save(str(tmp_path / "lexicon"))
    lexicon = Lexicon.mapped(str(tmp_path / "lexicon"))
    asked = [*words, b"", b"ta", b"tapss", b"x", b"t"]
    offsets = np.cumsum([0, *map(len, asked)])
    numbers = lexicon.numbers(np.frombuffer(b"".join(asked), np.uint8), offsets)
    got = [lexicon.ids[lexicon.offsets[n] : lexicon.offsets[n + 1]].tolist() if n >= 0 else None for n in numbers.tolist()]
    assert got == [words.get(w) for w in asked]


def test_documents(spark):
    docs = documents(spark)
    want = sorted((r.doc_id is None, r.doc_id or 0, len(ids_of(r.text))) for r in docs.select("doc_id", "text").collect())
    counted = count_tokens(docs, PATH, out="tokens_found")
    assert counted.columns == [*docs.columns, "tokens_found"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.tokens_found) for r in counted.collect()) == want
    coded = encode_documents(docs, PATH, keep=["doc_id"], decoded="decoded", words=40)
    rows = codec_digests(coded).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in rows) == want
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    by_id = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            assert r.ids_sha256 == sha(",".join(map(str, ids_of(by_id[r.doc_id]))))
            assert r.decoded_sha256 == sha(by_id[r.doc_id] or "")
    back = {r.doc_id: r.text for r in decode_documents(coded.drop("decoded"), PATH).collect() if r.doc_id is not None}
    assert back == {k: v or "" for k, v in by_id.items()}


def test_empty_table(spark):
    none = documents(spark).limit(0)
    assert count_tokens(none, PATH, keep=["doc_id"]).collect() == []
    assert encode_documents(none, PATH, keep=["doc_id"], decoded="decoded").collect() == []
