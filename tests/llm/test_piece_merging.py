"""Encoding and decoding against the library, on whole tables, odd rows and made-up strings."""

import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import piece_merging as p

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = p.vocabulary(PATH)
USUAL = [s for s, kind in zip(PIECES.names, PIECES.kinds) if kind == p.USUAL]


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(model, text):
    ids = [1, *model.encode(text), 2]
    assert PIECES.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert PIECES.decode(PIECES.encode(text)) == model.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*USUAL[:60], *USUAL[-40:], " ", "  ", "\n", "<s>", "<0x41>", "½", "߷", "🎉", "\x00", "　"]), max_size=12))
def test_encodes_like_the_library(model, parts):
    same(model, "".join(parts))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aerstin xgo▁", max_size=60))
def test_few_letters(model, text):
    same(model, text)


@pytest.mark.parametrize("unit", [" ", "a", "x", "\t", "▁", "ab", "日本", "er", "tion"])
def test_runs(model, unit):
    for n in [*range(40), 5000]:
        same(model, unit * n)
        same(model, unit * n + "the")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 258)), max_size=12))
def test_decodes_like_the_library(model, ids):
    assert PIECES.decode(struct.pack(f"<{len(ids)}I", *ids)) == model.decode(ids)


def test_every_piece_alone(model):
    for piece in USUAL:
        same(model, piece)


def test_ids_outside_the_vocabulary_read_as_unknown():
    assert PIECES.decode(struct.pack("<2I", 32_000, 4_000_000_000)) == p.UNREADABLE * 2


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table(spark, model, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    got = {r.doc_id: (bytes(r.ids), r.n_tokens, r.decoded) for r in p.round_trip(docs, PATH).collect()}
    want = {}
    for r in docs.collect():
        ids = [1, *model.encode(r.text or ""), 2]
        want[r.doc_id] = (struct.pack(f"<{len(ids)}I", *ids), len(ids), model.decode(ids))
    assert got == want


def test_odd_rows(spark, odd, model):
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids), r.n_tokens) for r in p.encode(odd, PATH).collect())
    want = []
    for r in odd.collect():
        ids = [1, *model.encode(r.text or ""), 2]
        want.append((r.doc_id is None, r.doc_id or 0, struct.pack(f"<{len(ids)}I", *ids), len(ids)))
    assert got == sorted(want)
    both = p.round_trip(odd, PATH).select("doc_id", "decoded")
    apart = p.decode(p.encode(odd, PATH), PATH)
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apart.collect()))
    assert p.round_trip(odd.limit(0), PATH).collect() == []


def test_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray(b""))], "doc_id long, ids binary")
    assert sorted(map(tuple, p.decode(df, PATH).collect())) == [(1, None), (2, "")]


def test_other_kinds_of_models_are_refused(tmp_path):
    file = tmp_path / "unigram.model"
    piece = b"\x0a\x03\x0a\x01a"
    file.write_bytes(piece + b"\x12\x02\x18\x01")
    with pytest.raises(ValueError, match="not a vocabulary of merges"):
        p.Vocabulary(str(file))
