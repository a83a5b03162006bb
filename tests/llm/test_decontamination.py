"""Decontamination: the index by brute force, passages, blocks of phrases, odd input."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import decontamination as d
from sluiceway.llm.fm_index import FMIndex


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1))
def test_index_finds_and_locates(text, patterns):
    index = FMIndex(np.array(text), 5)
    padded = np.zeros((len(patterns), 4), np.int64)
    for i, p in enumerate(patterns):
        padded[i, 4 - len(p) :] = p
    low, high = index.search(padded, np.array([len(p) for p in patterns]))
    for p, a, b in zip(patterns, low, high):
        expected = [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(a, max(a, b)))) == expected


def passage(a, b):
    return " ".join(f"p{i}" for i in range(a, b))


def test_passages(documents, spark):
    item = spark.createDataFrame([(10, passage(0, 20)), (7, "Short item"), (8, None), (9, "..."), (None, passage(50, 63))], "item_id long, text string")
    docs = documents(
        "x " + passage(2, 15) + ", tail",  # one window
        "x " + passage(2, 14) + " tail",  # twelve words only
        passage(0, 20).upper() + " short--ITEM short item",  # both items, the short one twice
        "y " + passage(50, 63),  # an item without an id
        "clean " * 400 + "short item",  # hit, but below a twentieth
        None,
    )
    rows = {r.doc_id: r for r in d.find_passages(docs, item).collect()}
    assert [(rows[i].n_words, rows[i].n_hit, rows[i]["items"], rows[i].contaminated) for i in range(6)] == [
        (15, 13, [10], True), (14, 0, [], False), (24, 24, [7, 10], True), (14, 13, [], True), (402, 2, [7], False), (0, 0, [], False),
    ]
    assert [(s.begin, s.end) for s in rows[0].spans] == [(1, 14)]


def test_blocks_give_the_same(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    docs = docs.unionByName(docs.limit(20))  # repeated rows
    one = d.find_passages(docs, items).orderBy("doc_id")
    several = d.find_passages(docs, items, block_bytes=4000).select(*one.columns).orderBy("doc_id")
    assert one.collect() == several.collect()


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    rows = d.find_passages(odd, items, carry=tuple(c for c in odd.columns if c not in ("n_words", "items", "spans"))).collect()
    assert len(rows) == odd.count() and [r.contaminated for r in rows if r.doc_id == 3] == [True, True]
    assert not any(r.contaminated for r in d.find_passages(odd, items.limit(0)).collect())
    assert d.find_passages(odd.limit(0), items).count() == 0
