"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Texts become term vectors: hashed words, pairs of neighbouring character classes, and bucketed measures of
repetition and length, each family of unit length after inverse document frequency weighting. A truncated
singular value decomposition of the labelled sample gives the latent space; it and the labelled vectors are
broadcast. Every document is projected, compared with all labelled vectors by blocked cosine products, and
its nearest neighbours vote with their similarity as weight.

The labelled sample is bounded (``SAMPLE`` documents, as many of each label as it has, up to half of the
sample each), so the broadcast is too: SAMPLE * RANK + TERMS * RANK floats, about 2 MB. Votes are reweighted
by the label shares of all labelled documents, so the balanced sample does not shift the scores.
"""

from __future__ import annotations

import collections
import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import bytes_of, steps

SAMPLE, RANK, NEIGHBOURS, BLOCK = 3000, 64, 15, 256
_WORDS = 1 << 12
_CLASSES, _BUCKETS, _STATS = 16, 12, 7
TERMS = _WORDS + _CLASSES**2 + _STATS * _BUCKETS
_SECOND, _THIRD = _WORDS, _WORDS + _CLASSES**2
#: Each family of terms, and how much of a vector's square length it gets.
_FAMILIES = ((slice(0, _SECOND), 0.2), (slice(_SECOND, _THIRD), 0.4), (slice(_THIRD, TERMS), 0.4))


def _character_classes() -> np.ndarray:
    kinds = np.full(256, 15, np.uint8)  # beyond ASCII
    kinds[:128] = 14
    for kind, members in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c",
         b".,;:", b"?'\"()-", b"!", b"#*", b"$%&", b"|", b"<>[]{}", b"/\\@_=+~^`")
    ):
        kinds[np.frombuffer(members, np.uint8)] = kind
    return kinds


_KINDS = _character_classes()


def _bucket(value: float) -> int:
    return min(_BUCKETS - 1, int(value * _BUCKETS))


def term_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights) of one text, weights damped by the logarithm."""
    words = text.split()
    seen = collections.Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    kinds = _KINDS[np.frombuffer(text, np.uint8)].astype(np.int64)
    pairs = np.bincount(kinds[:-1] * _CLASSES + kinds[1:], minlength=_CLASSES**2) if len(kinds) > 1 else np.zeros(_CLASSES**2)
    n = max(1, len(words))
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    stats = (
        len(seen) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(c for c in triples.values() if c > 1) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        np.log1p(len(words)) / 12,
        sum(map(len, words)) / n / 16,
        (kinds == 1).mean() if len(kinds) else 0,
    )
    hashed: collections.Counter[int] = collections.Counter()
    for word, count in seen.items():
        hashed[zlib.crc32(word.lower()) % _WORDS] += count
    terms = np.concatenate(
        (
            np.fromiter(hashed, np.int64, len(hashed)),
            np.flatnonzero(pairs) + _WORDS,
            [_WORDS + _CLASSES**2 + i * _BUCKETS + _bucket(v) for i, v in enumerate(stats)],
        )
    ).astype(np.int64)
    weights = np.concatenate(
        (np.fromiter(hashed.values(), float, len(hashed)), 1000 * pairs[pairs > 0] / max(1, len(kinds)), np.ones(_STATS))
    )
    return terms, np.log1p(weights)


@dataclass
class Space:
    """The latent space, the labelled vectors in it, and what a vote for each counts."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    worth: np.ndarray
    prior: float

    def score(self, texts: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors; the prior where nothing is similar."""
        out = np.full(len(texts), self.prior)
        if not len(self.vectors):
            return out
        k = min(neighbours, len(self.vectors))
        for at in range(0, len(texts), BLOCK):
            near = _unit(_rows(texts[at : at + BLOCK], self.idf) @ self.basis) @ self.vectors.T
            best = np.argpartition(near, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(float) * self.worth[best]
            total = weight.sum(1)
            some = total > 0
            out[at : at + BLOCK][some] = ((weight * self.labels[best]).sum(1) / np.where(some, total, 1))[some]
        return np.clip(out, 0, 1)


def _rows(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Weighted term vectors of a block of texts."""
    rows = np.zeros((len(texts), TERMS), np.float32)
    for i, text in enumerate(texts):
        terms, weights = term_counts(text)
        rows[i, terms] = weights  # the terms of a text are distinct
    rows *= idf
    for family, share in _FAMILIES:
        rows[:, family] = _unit(rows[:, family]) * np.float32(np.sqrt(share))
    return rows


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows**2).sum(1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


def fit(texts: list[bytes], labels: np.ndarray, share_of_ones: float, rank: int = RANK, seed: int = 7) -> Space:
    """Decompose the labelled sample; ``share_of_ones`` is the share among all labelled documents."""
    frequency = np.zeros(TERMS)
    for t in texts:
        frequency[np.unique(term_counts(t)[0])] += 1
    idf = np.log((1 + len(texts)) / (1 + frequency)) + 0.1
    idf = idf.astype(np.float32)
    rows = _rows(texts, idf)
    rank = min(rank, *rows.shape) if len(rows) else 0
    # Randomised range finder with power steps: the leading right singular vectors of the sample.
    guess = np.random.default_rng(seed).standard_normal((rows.shape[0], rank + 8)).astype(np.float32)
    basis = rows.T @ guess
    for _ in range(4):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0] if len(rows) else basis
    if len(rows):
        _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
        basis = (basis @ right.T)[:, :rank]
    ones = labels.mean() if len(labels) else 0
    worth = np.where(labels == 1, share_of_ones / max(ones, 1e-9), (1 - share_of_ones) / max(1 - ones, 1e-9))
    return Space(idf, basis, _unit(rows @ basis), labels.astype(float), worth, share_of_ones)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> tuple[list[bytes], np.ndarray, float]:
    """Texts and labels of the sample, in key order, and the share of ones among all labelled rows.

    Of each label the ``sample / 2`` rows with the least hash of their key are taken. Null keys and labels are
    ignored; a key labelled twice counts once with its larger label. Whole texts come to the driver, which the
    bound on the sample allows; only ids are ranked.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("label"))
    share = known.agg(F.avg("label")).first()[0]
    picks = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(sample // 2)
        picks = part if picks is None else picks.unionByName(part)
    rows = (
        docs.select(key, bytes_of(text).alias("_bytes"))
        .join(F.broadcast(picks), key)  # at most `sample` rows of two numbers
        .dropDuplicates([key])
        .orderBy(key)
        .select("_bytes", "label")
        .toLocalIterator()
    )
    texts, values = [], []
    for r in rows:
        texts.append(bytes(r[0]))
        values.append(r[1])
    return texts, np.array(values, float), float(share) if share is not None else 0.5


def scores(docs: DataFrame, space: Space, neighbours: int = NEIGHBOURS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` of every whole text, in [0, 1].

    Null and empty texts are scored as texts without words. Every row is scored on its own, so keys may be
    null or repeat. Without any labelled document the score is the prior. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(space)
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_bytes"):
            texts = batch.column(batch.schema.get_field_index("_bytes")).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.score(texts, neighbours))], names=["key", "score"]
            )

    taken = docs.select(F.col(key).alias("key"), bytes_of(text).alias("_bytes"))
    return taken.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
