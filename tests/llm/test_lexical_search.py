"""The term grid against plain sums, and ranked search against a brute-force version and the SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import lexical_search as s
from sluiceway.llm.heaps import Heaps
from sluiceway.llm.oracles import op11_sql
from sluiceway.llm.queries import op11_lexical_search
from sluiceway.llm.term_grid import K2Treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k):
    """(item, rank, doc, score) of lists of (id, text)."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = [(key, Counter(TERM.findall((text or "").translate(fold)))) for key, text in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in counts:
            m = 50 + 50 * c.total() * n_docs // max(1, n_terms)
            score = 0
            for t in dict.fromkeys(TERM.findall((text or "").translate(fold))):
                if t in c:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += weight * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0 and key is not None:
                scores.append((-score, key))
        out += [(item, rank, key, -score) for rank, (score, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shape", [(1, 1), (2, 9), (40, 3), (33, 200)])
def test_grid(shape):
    rng = np.random.default_rng(sum(shape))
    dense = np.where(rng.random(shape) < 0.3, rng.integers(1, 5, shape), 0)
    dense[0, 0] = 1 << 40
    rows, columns = np.nonzero(dense)
    grid = K2Treap(rows, columns, dense[rows, columns], *shape)
    keys = np.pad(np.arange(shape[1]) * 3, (0, (1 << grid.depth) - shape[1]), mode="edge")
    terms = [np.unique(rng.integers(0, shape[0], n)) for n in (1, 2, 7, 20)] + [np.zeros(0, np.int64)]
    heaps = Heaps(len(terms), 4)
    grid.best(terms, keys, heaps, np.arange(len(terms)))
    got = sorted(zip(*(x.tolist() for x in heaps.entries())))
    want = []
    for i, t in enumerate(terms):
        sums = dense[t].sum(0) if len(t) else np.zeros(shape[1], np.int64)
        ranked = sorted((-x, 3 * c) for c, x in enumerate(sums.tolist()) if x > 0)[:4]
        want += [(i, -x, c) for x, c in ranked]
    assert got == sorted(want)


def test_terms():
    assert s.terms_of("Ab-c É1_x\x7f y Z".encode()) == ["ab".encode(), b"c", "É1".encode(), b"x", " y".encode(), b"z"]


def test_small_treaps_and_blocks(spark, documents, monkeypatch):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(150)]
    texts += [(200 + i, texts[3][1]) for i in range(60)]  # ties beyond the k best
    items = [(i, " ".join(rng.choice(words, 5))) for i in range(12)] + [(3, "w1 w2"), (None, "w3"), (90, None), (91, "?!"), (92, "nowhere")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(*texts).repartition(3)
    want = brute(texts, [i for i in items if i[1]], 10)
    for block_bytes in (s.BLOCK_BYTES, 60):
        got = s.rank_documents(docs, asked, k=10, block_bytes=block_bytes).collect()
        assert sorted(map(tuple, got), key=repr) == want


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "a B", "x"), (2, "words w5 x", "x"), (3, "x" * 70_000, "x")], "item_id long, text string, score string")
    want = brute([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()], 50)
    assert sorted(map(tuple, s.rank_documents(odd, items).collect()), key=repr) == want
    assert s.rank_documents(odd.limit(0), items).collect() == [] == s.rank_documents(odd, items.limit(0)).collect()
    assert s.rank_documents(odd.where(F.col("text").isNull()), items).collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    got = op11_lexical_search(spark, sf_dir).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(op11_sql()).fetchall())
