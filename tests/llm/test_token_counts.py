"""Token counts against the library's own encoding of whole texts."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import token_counts as t

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = t.processor(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "a", "the", "▁", "\n", "<s>", "½", "é", "🎉", "\x00", "word", "<0x0A>", "ing", "　", "."])))
def test_counts_like_the_library(parts):
    text = "".join(parts)
    assert t.count(text, PATH) == len(MODEL.encode(text))


def test_proof(spark):
    whole = t.prove(MODEL)
    assert "the" in whole and all(len(MODEL.encode(w)) == 1 for w in list(whole)[:500])


def test_normaliser_is_read_from_the_file():
    assert t.normaliser(MODEL.serialized_model_proto()) == t.NO_CHANGE
    assert t.normaliser(b"\x1a\x06\x12\x02ab\x20\x00") != t.NO_CHANGE and t.normaliser(b"") != t.NO_CHANGE


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in t.token_counts(docs, PATH).collect()}
    assert got == {
        r.doc_id: (len(r.text.encode()), n := len(MODEL.encode(r.text)), n > 4096) for r in docs.collect()
    }


def test_odd_rows(odd):
    rows = t.token_counts(odd, PATH).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in rows)[:2] == [(0, 0), (0, 0)]
    assert len(rows) == odd.count() and any(r.over_limit for r in rows if r.doc_id == 5)
    assert t.token_counts(odd.limit(0), PATH).count() == 0


def test_unsuitable_vocabulary():
    class Model:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

        is_control = is_unknown = is_byte = is_unused = lambda self, i: False

    with pytest.raises(ValueError, match="space mark"):
        t.prove(Model())
