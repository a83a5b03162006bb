"""Ranked lexical search: the best documents of every item by a sum of integer term impacts.

One pass over the texts counts the terms that items ask for; from these counts come the weights of the terms and the impact of
every (term, document). Each task then deals its documents to K2-treaps of bounded size and searches all items in each, one
heap per item for the whole task, so that what earlier treaps have found prunes later ones. The heaps of all tasks are merged.

Items are taken in blocks of bounded size, one pass over the texts for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import bytes_of, steps
from sluiceway.llm.decontamination import blocks
from sluiceway.llm.heaps import Heaps
from sluiceway.llm.term_grid import K2Treap
from sluiceway.session import hand_over

#: Bytes of items in one pass, points and documents of one treap, and items that are searched together.
BLOCK_BYTES, POINTS, DOCUMENTS, TOGETHER = 8 << 20, 1 << 19, 1 << 14, 64
#: Terms consist of digits, letters and characters beyond ASCII; all else separates, and A-Z are lower-cased.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, repeats included."""
    return text.translate(_FOLD).split()


def _counted(vocabulary: dict[bytes, int]):
    """Documents to their number of terms and, packed as 32-bit integers, the asked terms in them with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_bytes"):
            sizes, found, times = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                sizes.append(len(words))
                numbers = np.fromiter((n for n in map(vocabulary.get, words) if n is not None), np.int32)
                term, count = np.unique(numbers, return_counts=True)
                found.append(term.tobytes())
                times.append(count.astype(np.int32).tobytes())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.binary()), pa.array(times, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "terms", "times"])

    return run


def _frequencies(n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    return run


def _searched(shared, k: int):
    """Partial heaps of the items: item, score, key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, n_docs, n_terms = shared.value
        heaps = Heaps(len(items), k)
        held: list[tuple] = []
        points = 0

        def search() -> None:
            keys, sizes, found, times = (np.array([h[i] for h in held], np.int64) if i < 2 else [h[i] for h in held] for i in range(4))
            order = np.argsort(keys, kind="stable")
            term = np.concatenate([np.frombuffer(found[i], np.int32) for i in order]).astype(np.int64)
            tf = np.concatenate([np.frombuffer(times[i], np.int32) for i in order]).astype(np.int64)
            column = np.repeat(np.arange(len(order)), [len(found[i]) // 4 for i in order])
            m = 50 + (50 * sizes[order] * n_docs) // n_terms
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[column]))
            some = impact > 0
            if not some.any():
                return
            grid = K2Treap(term[some], column[some], impact[some], len(weights), len(order))
            ordered = np.pad(keys[order], (0, (1 << grid.depth) - len(order)), mode="edge")
            for at in range(0, len(items), TOGETHER):
                group = items[at : at + TOGETHER]
                grid.best(group, ordered, heaps, np.arange(at, at + len(group)))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                points += len(row[2]) // 4
                if points >= POINTS or len(held) >= DOCUMENTS:
                    search()
                    held, points = [], 0
        if held:
            search()
        columns = [pa.array(c, pa.int64()) for c in heaps.entries()]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "score", "key"])

    return run


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item, rank, key, score`` of the ``k`` best documents of every item, all with a score above 0 where there are fewer.

    With N documents that have a term, L terms in all of them, n terms in one document and tf of them the term that df documents
    hold, a term's weight is floor(1000 ln((2N + 2) / (2df + 1))), a document's m is 50 + 50nN div L, and a score sums
    weight * (10^9 tf div (1000 tf + 20 m)) over the distinct terms of the item. Equal scores rank by smaller key. 50nN must fit
    64 bits.

    Null and empty texts have no terms: such documents are found by nothing, such items find nothing. Documents with a null key
    count in N, L and df, and are not returned. Rows that repeat a key are documents of their own; every row of ``items`` is
    ranked by itself, under its id, which may repeat or be null. Keys are integers. Other columns are ignored.
    """
    spark = docs.sparkSession
    taken = docs.select(F.col(f"`{key}`").cast("long").alias("key"), bytes_of(f"`{text}`").alias("_bytes"))
    found = []
    for block in blocks(items, item, item_text, block_bytes):
        wanted = [dict.fromkeys(terms_of(b)) for _, b in block]
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for ts in wanted for t in ts))}
        if not vocabulary:
            continue
        counted = hand_over(taken.mapInArrow(_counted(vocabulary), "key long, n long, terms binary, times binary"), "term-counts")
        n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        sums = counted.select("terms").mapInArrow(_frequencies(len(vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df"))
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in sums.collect():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        rows = [np.array([i for i in map(vocabulary.get, ts) if weights[i]], np.int64) for ts in wanted]
        shared = spark.sparkContext.broadcast((rows, weights, n_docs, n_terms))
        heaps = counted.where("key IS NOT NULL AND octet_length(terms) > 0").mapInArrow(_searched(shared, k), "item long, score long, key long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), "key")
        best = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], "item long, item_id long")
        named = best.join(ids, "item").select(F.col("item_id").alias(item), "rank", F.col("key").alias(key), "score")
        found.append(hand_over(named, "ranked"))
        shared.destroy()
    if not found:
        return spark.createDataFrame([], f"`{item}` long, rank int, `{key}` long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
