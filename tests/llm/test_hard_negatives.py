"""Strassen's products against plain ones, heaps against sorting, mining against a brute-force version and the SQL."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import hard_negatives as h
from sluiceway.llm.heaps import Heaps
from sluiceway.llm.oracles import op13_sql
from sluiceway.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 65, 70), (64, 64, 64), (130, 35, 200), (200, 0, 3), (0, 5, 7)])
@pytest.mark.parametrize("large", [300, 1 << 31, 1 << 62])
def test_strassen(shape, large):
    m, k, n = shape
    rng = np.random.default_rng(m + n)
    a, b = rng.integers(-large, large, (m, k)), rng.integers(-large, large, (k, n))
    assert (h.strassen(a, b) == a @ b).all()  # integers wrap around alike


def test_heaps():
    rng = np.random.default_rng(1)
    heaps, seen = Heaps(5, 3), [[] for _ in range(5)]
    for _ in range(20):
        scores, keys = rng.integers(0, 4, (5, 7)), rng.integers(0, 50, 7)
        row, column = np.nonzero(heaps.admits(np.arange(5)[:, None], scores, keys) & (rng.random((5, 7)) < 0.5))
        heaps.add(row, scores[row, column], keys[column])
        for r, c in zip(row, column):
            seen[r].append((-scores[r, c], keys[c]))
    got = sorted(zip(*(x.tolist() for x in heaps.entries())))
    assert got == sorted((i, -s, k) for i, x in enumerate(seen) for s, k in sorted(x)[:3])


def brute(rows, is_anchor):
    good = [
        (key, [math.floor(256 * float(x)) for x in v], label)
        for key, v, label in rows
        if key is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor, vector, label in sorted({(k, tuple(v), lab) for k, v, lab in good if is_anchor(k)}):
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), k, lab) for k, v, lab in good)
        for p, key, _ in [x for x in scored if x[2] == label and x[1] != anchor][:5]:
            fits = [(n, k) for n, k, lab in scored if lab != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(anchor, key, rank, k, -p, -n) for rank, (n, k) in enumerate(fits[:3], 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df, **options):
    return sorted(map(tuple, h.mine(df, F.col("key") % 50 == 0, **options).select(*COLUMNS).collect()))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(h, "CANDIDATE_TILE", 50)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.4, 9).round(1).tolist(), int(i % 3)) for i in range(400)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(80)]  # one vector many times
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute([(k, [np.float32(x) for x in v], lab) for k, v, lab in rows], lambda k: k % 50 == 0)
    assert want and mined(df) == want
    assert mined(df, block_bytes=200) == want  # three anchors a pass


def test_odd_rows(spark):
    big = 1e6
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.2, 0.1], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1),
        (3, [float("nan"), 1.0], 2), (4, [float("inf"), 1.0], 2), (5, [1.0, 0.4], None), (6, [1.0, 0.5], 1), (7, [1.0], 1),
        (8, [], 1), (9, [0.8, 0.2], 2), (9, [0.8, 0.2], 2), (10, [0.6, 0.4], 3), (11, [-1.0, -1.0], 1), (50, [big, -big], 4), (51, [big, -0.9 * big], 4),
        (52, [0.7 * big, -0.7 * big], 5), (100, [0.3, 0.3], 9), (150, [], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ["key", "vector", "score", "rank", "anchor_id", "window"]})
    want = brute([(k, v and [x if x is None else np.float32(x) for x in v], lab) for k, v, lab in rows], lambda k: k % 50 == 0)
    assert want and mined(df) == want
    assert mined(df.limit(0)) == [] == mined(df.where("vec_id % 50 <> 0"))


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    result = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({op13_sql()})").fetchall()
    assert sorted(map(tuple, op13_hard_negatives(spark, sf).select(*COLUMNS).collect())) == sorted(result)
