"""Hard negatives: rows of another label that an anchor scores just below one of its positives.

Scores are inner products of integer vectors. Tiles of anchors meet tiles of candidates in Strassen's multiplication, which
works on 64-bit integers with zero padding: its sums and differences may wrap around, and still every result that fits is exact.

Anchors are taken in blocks of bounded size; for each block all candidates are read twice. The first pass keeps, in each task,
a heap of the best same-label candidates of every anchor, and the heaps of all tasks are merged. The positives' scores give
each anchor its windows, and the second pass keeps a heap of the best candidates of other labels for every window. Only
heaps are shuffled, never scores; a heap's size does not depend on the candidates that a task has seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.heaps import Heaps, spread
from sluiceway.session import hand_over

#: Bytes of anchor vectors that one pass takes, rows of a tile of anchors and of candidates, and the side below which
#: matrices are multiplied directly.
BLOCK_BYTES, ANCHOR_TILE, CANDIDATE_TILE, LEAF = 8 << 20, 512, 2048, 32


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of small matrices: in doubles where every sum stays an exact integer, else in integers."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    largest = [max(abs(int(x.max())), abs(int(x.min()))) for x in (a, b)]
    if largest[0] * largest[1] * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of integer matrices, modulo 2**64: seven products of half the sides in place of eight."""
    m, k = a.shape
    n = b.shape[1]
    if min(m, k, n) <= LEAF:
        return _product(a, b)
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    whole = strassen(a11 + a22, b11 + b22)
    low_left = strassen(a21 + a22, b11)
    top_right = strassen(a11, b12 - b22)
    bottom = strassen(a22, b21 - b11)
    top_left = strassen(a11 + a12, b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = strassen(a12 - a22, b21 + b22)
    out[:i, :l] += whole + bottom - top_left
    out[:i, l:] = top_right + top_left
    out[i:, :l] = low_left + bottom
    out[i:, l:] = strassen(a21 - a11, b11 + b12)
    out[i:, l:] += whole - low_left + top_right
    return out[:m, :n]


class Block:
    """Anchors of one pass as arrays: keys, labels, vectors (padded with zeros to ``width``)."""

    def __init__(self, rows: pa.Table, width: int):
        self.keys = rows["key"].to_numpy()
        self.labels = rows["label"].to_numpy()
        self.vectors = _matrix(rows["vector"].combine_chunks(), width)


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, spread(np.zeros(len(sizes), np.int64), sizes)] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CANDIDATE_TILE):
            part = batch.slice(at, CANDIDATE_TILE)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), _matrix(part.column(2), width)


def _positives(shared, width: int, size: int):
    """Partial heaps of same-label candidates: anchor, score, key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        heaps = Heaps(len(block.keys), size)
        for keys, labels, vectors in _tiles(batches, width):
            for label in np.intersect1d(labels, block.labels):
                mine, own = labels == label, np.flatnonzero(block.labels == label)
                there, transposed = keys[mine], np.ascontiguousarray(vectors[mine].T)
                for begin in range(0, len(own), ANCHOR_TILE):
                    at = own[begin : begin + ANCHOR_TILE]
                    scores = strassen(block.vectors[at], transposed)
                    row, column = np.nonzero((block.keys[at][:, None] != there) & heaps.admits(at[:, None], scores, there))
                    heaps.add(at[row], scores[row, column], there[column])
        columns = [pa.array(c, pa.int64()) for c in heaps.entries()]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "score", "key"])

    return run


def _negatives(shared, width: int, size: int):
    """Partial heaps of candidates of other labels within each window: window, score, key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, low, high = shared.value
        n, windows = low.shape
        heaps = Heaps(n * windows, size)
        for keys, labels, vectors in _tiles(batches, width):
            transposed = np.ascontiguousarray(vectors.T)
            for begin in range(0, n, ANCHOR_TILE):
                at = np.arange(begin, min(n, begin + ANCHOR_TILE))
                scores = strassen(block.vectors[at], transposed)
                other = block.labels[at][:, None] != labels
                for w in range(windows):
                    fits = other & (scores >= low[at, w][:, None]) & (scores <= high[at, w][:, None])
                    fits &= heaps.admits((at * windows + w)[:, None], scores, keys)
                    row, column = np.nonzero(fits)
                    heaps.add(at[row] * windows + w, scores[row, column], keys[column])
        columns = [pa.array(c, pa.int64()) for c in heaps.entries()]
        yield pa.RecordBatch.from_arrays(columns, names=["window", "score", "key"])

    return run


def _merged(heaps: DataFrame, of: str, size: int) -> DataFrame:
    """The heaps of all tasks as one, with ``rank`` from 1. A list has at most ``size`` entries from each task."""
    order = Window.partitionBy(of).orderBy(F.desc("score"), "key")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def quantised(rows: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``key, label, vector`` of the rows that take part, components as floor(scale * x) in doubles."""
    named = rows.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").alias("vector"))
    x = F.transform("vector", lambda v: v.cast("double"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = named.where("key IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(F.coalesce(finite, F.lit(False)))
    return whole.select("key", "label", F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("vector"))


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor and positive.

    ``anchors`` is a condition on ``key`` that says which rows are anchors. An anchor's positives are its first rows of the same
    label with another key; a negative of one has another label and low * positive <= 100 * score <= high * positive. First means
    highest score, equal scores by smaller key. All are returned where there are fewer.

    Rows with a null key, label or vector, or with a null or non-finite component, take no part. Shorter vectors are padded
    with zeros. Scores must fit 64 bits; a larger one is taken modulo 2**64. Rows that repeat a key are candidates of their own;
    anchors that repeat it with the same label and vector are one anchor, and no row is a positive of an anchor with its key.
    Other columns are ignored; an empty table gives an empty result. One block of anchors is on the driver at a time.
    """
    spark = rows.sparkSession
    taken = hand_over(quantised(rows, key, vector, label, scale), "candidates")
    asked = hand_over(taken.where(anchors).distinct(), "anchors")
    n = asked.count()
    width = taken.agg(F.max(F.size("vector"))).first()[0] or 1
    blocks = -(-n * width * 8 // block_bytes)
    found = []
    for number in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("key", "label", "vector"), F.lit(blocks)) == number) if blocks > 1 else asked
        block = Block(part.toArrow().sort_by([("key", "ascending"), ("label", "ascending")]), width)
        if not len(block.keys):
            continue
        shared = spark.sparkContext.broadcast(block)
        heaps = taken.mapInArrow(_positives(shared, width, positives), "anchor long, score long, key long")
        best = _merged(heaps, "anchor", positives).toArrow()
        shared.destroy()
        at, place = best["anchor"].to_numpy(), best["rank"].to_numpy() - 1
        shape = (len(block.keys), positives)
        partner, score = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        partner[at, place], score[at, place] = best["key"].to_numpy(), best["score"].to_numpy()
        least, most = np.ones(shape, np.int64), np.zeros(shape, np.int64)  # empty windows where there is no positive
        exact = score[at, place].astype(object)
        least[at, place], most[at, place] = -(-low * exact // 100), high * exact // 100
        windows = spark.sparkContext.broadcast((block, least, most))
        heaps = taken.mapInArrow(_negatives(windows, width, negatives), "window long, score long, key long")
        flat = spark.createDataFrame(
            pa.table({
                "window": np.arange(partner.size),
                "anchor_id": np.repeat(block.keys, positives),
                "positive_id": partner.ravel(),
                "positive_score": score.ravel(),
            })
        )
        named = _merged(heaps, "window", negatives).join(flat, "window")
        found.append(
            hand_over(
                named.select(
                    "anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
                ),
                "hard-negatives",
            )
        )
        windows.destroy()
    if not found:
        return spark.createDataFrame([], _RESULT)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
