"""The classifier: held-out accuracy, exactness of the neighbour vote, odd input."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from sluiceway.llm import quality_classifier as q


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    held = labels[[zlib.crc32(str(i).encode()) % 5 == 0 for i in labels.doc_id]]
    learned = spark.createDataFrame(labels[~labels.doc_id.isin(held.doc_id)][["doc_id", "quality"]])
    space = q.fit(*q.labelled_sample(docs, learned))
    tested = docs.join(F.broadcast(spark.createDataFrame(held[["doc_id", "quality"]])), "doc_id")
    rows = q.scores(tested, space).toPandas().merge(held, on="doc_id")
    rank, ones = rows.score.rank(), rows.quality == 1
    auc = (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / ones.sum() / (~ones).sum()
    assert len(rows) == len(held) and auc > 0.99
    assert ((rows.score >= 0.3) == ones).mean() > 0.97


def test_vote_is_exact():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "#", "X!"], rng.integers(1, 30))).encode() for _ in range(90)]
    labels = rng.integers(0, 2, 60).astype(float)
    space = q.fit(texts[:60], labels, 0.7, rank=8)
    vectors = q._unit(q._rows(texts[60:], space.idf) @ space.basis)
    for vector, score in zip(vectors, space.score(texts[60:], neighbours=5)):
        near = vector @ space.vectors.T
        best = np.argsort(-near)[:5]
        weight = np.maximum(near[best], 0) * space.worth[best]
        assert abs(score - (weight * labels[best]).sum() / weight.sum()) < 1e-5


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (5, None), (None, 1)], "doc_id long, quality int")
    space = q.fit(*q.labelled_sample(odd, labels))
    rows = q.scores(odd, space).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    nothing = q.fit(*q.labelled_sample(odd, labels.limit(0)))
    assert {r.score for r in q.scores(odd, nothing).collect()} == {0.5}
    assert q.scores(odd.limit(0), space).count() == 0
