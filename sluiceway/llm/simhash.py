"""SimHash near-duplicates, compared bit-sliced.

Every text gets a 64-bit fingerprint of its word shingles. Two fingerprints link if they differ in at most
``RADIUS`` bits. Candidates share a key: of three bit fields that cover 64 bits, two fingerprints two bits
apart agree in one at least. A key with more than ``LARGEST`` distinct fingerprints is split by applying the
same rule to the bits that the key leaves open, as often as needed, so no link is lost and no group is large.

Within a partition sorted by key the comparison is bit-sliced: 64 consecutive fingerprints form a block that
is stored as 64 bit planes, one machine word per bit. A fingerprint meets a block by adding the differing
planes into two carry-save counter words and an overflow word, all 64 distances at once. Blocks in which all
lanes have overflowed are dropped after every few planes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import bytes_of, steps
from sluiceway.llm.components import components
from sluiceway.session import hand_over

RADIUS = 2
FIELDS = RADIUS + 1
#: Distinct fingerprints compared under one key; larger keys are split.
LARGEST = 512
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The fingerprint as an unsigned integer: a bit is 1 if set in over half of the shingle hashes."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        joined: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, joined, itertools.repeat(42))
    for at in range(0, n, 1 << 16):
        part = np.fromiter(hashes, "<u8", min(1 << 16, n - at))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_bytes"):
            texts = batch.column(batch.schema.get_field_index("_bytes")).to_pylist()
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values)], names=[*batch.schema.names[:-1], "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` (fp as a signed long) of every text; null and wordless texts get zero."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    taken = docs.select(F.col(key).alias("key"), bytes_of(text).alias("_bytes"))
    return taken.mapInArrow(_fingerprints(shingle), f"key {kind}, fp long").withColumnRenamed("key", key)


def fields_of(open_bits: int) -> list[int]:
    """Split the given bits into FIELDS fields of nearly equal size, as masks."""
    bits = [b for b in range(64) if open_bits >> b & 1]
    return [sum(1 << b for b in bits[i::FIELDS]) for i in range(FIELDS)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def planes_of(fps: np.ndarray) -> np.ndarray:
    """(64, blocks): bit j of plane p of a block is bit p of the block's fingerprint j. Lanes are padded with zeros."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def close_pairs(fps: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of one group whose fingerprints differ in at most RADIUS bits.

    Rows are ordered by group; first and last give the group's range [first, last) for every row.
    """
    n = len(fps)
    planes = planes_of(fps)
    begins = np.arange(planes.shape[1]) * 64
    reach = np.minimum(begins + 64, n) - first[begins]  # rows from the start of the block's first group
    block = np.repeat(np.arange(len(begins)), reach)
    query = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(first[begins], reach)
    low = np.clip(query + 1 - begins[block], 0, 64).astype(np.uint64)
    high = np.clip(last[query] - begins[block], 0, 64).astype(np.uint64)
    keep = high > low
    block, query, low, high = block[keep], query[keep], low[keep], high[keep]
    lanes = (_ONES << low) & (_ONES >> (np.uint64(64) - high))
    one = np.zeros(len(query), np.uint64)
    two, over = one.copy(), ~lanes
    for p in range(64):
        differ = planes[p][block] ^ np.where(fps[query] >> np.uint64(p) & np.uint64(1), _ONES, np.uint64(0))
        carry = one & differ
        one ^= differ
        over |= two & carry
        two ^= carry
        if p % 4 == 3:
            alive = over | (one & two) != _ONES
            block, query, one, two, over = block[alive], query[alive], one[alive], two[alive], over[alive]
    near = ~(over | (one & two))
    at, lane = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return query[at], block[at] * 64 + lane


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index connected to each of n indices."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by (mask, value), as (fingerprint, least connected one of its group)."""

    def links(mask: np.ndarray, value: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
        size = np.diff(np.r_[new, len(fps)])
        a, b = close_pairs(fps.view(np.uint64), np.repeat(new, size), np.repeat(new + size, size))
        root = _roots(len(fps), a, b)
        linked = np.flatnonzero(root != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[root[linked]]), pa.array(fps[linked])], names=["a", "b"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held:
            columns = [np.concatenate(x) for x in zip(held, columns)]
        mask, value, _ = columns
        open_from = int(np.flatnonzero((mask != mask[-1]) | (value != value[-1]))[-1] + 1) if len(mask) and (
            (mask != mask[-1]) | (value != value[-1])
        ).any() else 0
        if open_from:
            yield links(*[c[:open_from] for c in columns])
        held = [c[open_from:] for c in columns]
    if held:
        yield links(*held)


def links(fps: DataFrame, largest: int = LARGEST) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that join all pairs within RADIUS bits.

    Pairs of one key are reduced to links to the least fingerprint that they connect to.
    """
    spark = fps.sparkSession
    found: list[DataFrame] = []
    pending = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    masks = [0]
    while True:
        split = {m: fields_of(~m & ((1 << 64) - 1)) for m in masks}
        arrays = [
            F.when(F.col("mask") == _signed(m), F.array(*[F.lit(_signed(m | f)).cast("long") for f in fields]))
            for m, fields in split.items()
        ]
        keyed = pending.select(F.explode(F.coalesce(*arrays)).alias("mask"), "fp").withColumn(
            "value", F.col("fp").bitwiseAND(F.col("mask"))
        )
        counts = keyed.groupBy("mask", "value").count().where("count > 1")
        shared = hand_over(keyed.join(counts, ["mask", "value"]), "simhash-keys")
        small = shared.where(F.col("count") <= largest).select("mask", "value", "fp")
        found.append(
            hand_over(
                small.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp").mapInArrow(_stars, "a long, b long"),
                "simhash-links",
            )
        )
        large = shared.where(F.col("count") > largest)
        if large.isEmpty():
            break
        masks = [m | f for m, fields in split.items() for f in fields]
        # A fingerprint that is large under several masks is split under each: pairs of one key share that mask.
        pending = large.select("mask", "fp")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(
    docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text", largest: int = LARGEST
) -> DataFrame:
    """``key, fp, fingerprint, component_id`` of every row; component_id is the least key reachable over links.

    Equal fingerprints always link, so copies never need comparing; null and wordless texts share fingerprint
    zero. Rows with a null key keep their fingerprint and their component, but name none: if a component has
    only null keys, its id is null. Repeated keys are rows like any other. Other columns are ignored.
    """
    marked = hand_over(fingerprints(docs, shingle, key, text), "simhash-fingerprints")
    distinct = marked.groupBy("fp").agg(F.min(key).alias("low"))
    rooted = components(links(hand_over(distinct.select("fp"), "simhash-distinct"), largest))
    groups = distinct.join(rooted.select(F.col("vertex").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = groups.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = groups.join(least, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(key, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
