"""Near copies: documents whose sets of word shingles have a Jaccard similarity of ``similarity`` or more.

MinHash bands propose and the shingle sets themselves decide. A text has BANDS keys of ROWS minima each; two texts
of similarity s share a key with a chance of 1 - (1 - s^ROWS)^BANDS, which is 0.99993 at 0.8. First every text
of a key is compared with the least one of that key, and most keys are then known to hold one component only. Of the
other keys, the texts beside the least one meet again with their sets at hand: texts of the key's largest component with
those of the others, and these among themselves. Texts of large keys are dealt to chunks, and every two chunks that have
something to compare meet in a group of bounded size. A group keeps a union-find and gives one link for each two components
that it joins, so links stay below the rows that went in; no pair is listed, and none is left out.

With ``fingerprinted``, op2's SimHash comes first: texts that it puts in one class are linked, whatever their sets share, and
are not compared again. It finds near copies below the similarity, and alone would miss most of those above: of two texts of
similarity 0.8, fingerprints of 64 bits differ in some 10 bits on average and in up to 18, and fields of 64 / 19 bits are keys
that everything shares.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import simhash
from sluiceway.llm.common import bytes_of, steps
from sluiceway.llm.components import components
from sluiceway.session import hand_over

BANDS, ROWS = 24, 5
#: Texts and bytes of sets of one key in a chunk; two chunks make a group.
CHUNK, CHUNK_BYTES = 512, 16 << 20
#: Four standard deviations of a similarity of 0.8 that is estimated from BANDS * ROWS minima.
MARGIN = 0.15
_MASK = (1 << 64) - 1
_RANDOM = np.random.default_rng(5)
_TIMES = _RANDOM.integers(0, _MASK, BANDS * ROWS, np.uint64, endpoint=True) | np.uint64(1)
_PLUS = _RANDOM.integers(0, _MASK, BANDS * ROWS, np.uint64, endpoint=True)


def shingles(text: bytes, shingle: int = 5) -> np.ndarray:
    """The hashes of the word shingles, distinct and in order; shorter texts are one shingle, wordless ones have none."""
    import xxhash

    words = text.lower().split()
    joined = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)] if words else []
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), np.uint64))


def _identity(hashes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(hashes.tobytes())


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of BANDS * ROWS keyed hashes over the set."""
    low = np.full(BANDS * ROWS, _MASK, np.uint64)
    for at in range(0, len(hashes), 1 << 12):
        low = np.minimum(low, (_TIMES[:, None] * hashes[None, at : at + (1 << 12)] + _PLUS[:, None]).min(1))
    return low


def _marks(shingle: int, fingerprinted: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in steps(batches, "_bytes"):
            texts = batch.column("_bytes").to_pylist()
            sets = [shingles(t, shingle) for t in texts]
            prints = np.array([simhash.fingerprint(t) for t in texts] if fingerprinted else [0] * len(texts), np.uint64)
            lows = [minima(s) for s in sets]
            bands = [
                xxhash.xxh64_intdigest(low[b * ROWS : (b + 1) * ROWS].tobytes(), b) for low in lows for b in range(BANDS)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("digest"),
                    pa.array(np.array([_identity(s) for s in sets], np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(np.array(bands, np.uint64).view(np.int64))
                    ),
                    pa.array([low.astype(np.uint8).tobytes() for low in lows], pa.binary()),
                    pa.array([s.nbytes for s in sets], pa.int64()),
                    pa.array(prints.view(np.int64)),
                ],
                names=["key", "digest", "fp", "bands", "sketch", "size", "simhash"],
            )

    return run


def _sets(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_bytes"):
            sets = [shingles(t, shingle) for t in batch.column("_bytes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array([_identity(s) for s in sets], np.uint64).view(np.int64)), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["fp", "items"],
            )

    return run


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sorted sets without repeats; two empty sets are equal."""
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / max(1, len(both) - common) if len(both) else 1.0


def _confirm(similarity: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "items_a"):
            pairs = zip(batch.column("items_a").to_pylist(), batch.column("items_b").to_pylist())
            good = pa.array([jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= similarity for x, y in pairs], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return run


def _forest(similarity: float) -> Callable:
    """Rows of groups (band, lo, hi) to the links that join what the similarity joins within a group: a tree each.

    Rows are fp, root, minor, sketch, items. Two rows are compared if their components differ, one of them is not of the key's
    largest component, they lie in different chunks of the group (or the group has one), and their minima allow the similarity.
    """

    def joined(rows: list[dict], alone: bool) -> Iterator[tuple[int, int]]:
        minima = np.frombuffer(b"".join(r["sketch"] for r in rows), np.uint8).reshape(-1, BANDS * ROWS)
        chunk = np.array([r["chunk"] for r in rows])
        minor = np.array([r["minor"] for r in rows])
        number = {root: i for i, root in enumerate(dict.fromkeys(r["root"] for r in rows))}
        of = np.array([number[r["root"]] for r in rows])
        for i in np.flatnonzero(minor):
            others = (of != of[i]) & (alone | (chunk != chunk[i]))
            others &= ~minor | (np.arange(len(rows)) > i)
            at = np.flatnonzero(others)
            alike = (minima[at] == minima[i]).mean(1)
            items = None
            for j in at[np.argsort(-alike, kind="stable")][: int((alike >= similarity - MARGIN).sum())]:
                if of[j] == of[i]:
                    continue
                items = np.frombuffer(rows[i]["items"], np.uint64) if items is None else items
                if jaccard(items, np.frombuffer(rows[j]["items"], np.uint64)) >= similarity:
                    of[of == of[j]] = of[i]
                    yield rows[i]["fp"], rows[j]["fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for part in steps([batch], "items") for row in part.to_pylist())
        for (_, lo, hi), group in itertools.groupby(rows, lambda r: (r["band"], r["lo"], r["hi"])):
            found = list(joined(list(group), lo == hi))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

    return run


def class_links(marked: DataFrame) -> DataFrame:
    """Links ``a, b`` between the shingle sets of texts in one class of op2: a star for each class of several sets.

    ``marked`` has ``fp`` of the set and ``simhash`` of the text of every row. Classes are those of ``simhash.near_duplicates``.
    """
    named = hand_over(marked.select("fp", "simhash").distinct(), "near-fingerprints")
    linked = simhash.links(hand_over(named.select(F.col("simhash").alias("fp")).distinct(), "near-simhash"))
    rooted = components(linked).select(F.col("vertex").alias("simhash"), "root")
    classed = named.join(rooted.hint("merge"), "simhash", "left").select(F.coalesce("root", "simhash").alias("class"), "fp")
    several = classed.groupBy("class").agg(F.min("fp").alias("a"), F.max("fp").alias("high")).where("a < high")
    stars = classed.join(several.hint("merge"), "class").where("fp <> a").select("a", F.col("fp").alias("b"))
    return hand_over(stars.distinct(), "near-classed")


def links(
    distinct: DataFrame, texts: DataFrame, shingle: int, similarity: float, chunk: int = CHUNK, known: DataFrame | None = None
) -> DataFrame:
    """Links ``a, b`` between shingle sets that join all proposed pairs of the similarity, and the links ``known`` before.

    ``distinct`` has ``fp, at (digest, key), bands, sketch, size`` of every set; ``texts`` has ``key, digest, _bytes``.
    """
    banded = distinct.select(F.explode("bands").alias("band"), "fp", "size")
    groups = banded.groupBy("band").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    kept = banded.join(groups.where("low < high").hint("merge"), "band").select("band", "fp", "size", "low")
    shared = hand_over(kept.where("fp <> low"), "near-keys")
    stars = hand_over(shared.select(F.col("low").alias("a"), F.col("fp").alias("b")).distinct(), "near-stars")
    ends = stars.select(F.col("a").alias("fp")).unionByName(stars.select(F.col("b").alias("fp"))).distinct()
    wanted = distinct.join(ends.hint("merge"), "fp").select(F.col("at.digest").alias("_d"), F.col("at.key").alias("_k"))
    found = texts.join(wanted.hint("merge"), (F.col("digest") == F.col("_d")) & F.col("key").eqNullSafe(F.col("_k")), "left_semi")
    sets = found.select("_bytes").mapInArrow(_sets(shingle), "fp long, items binary").dropDuplicates(["fp"])
    sets = hand_over(sets, "near-sets")
    left, right = (sets.select(F.col("fp").alias(x), F.col("items").alias(f"items_{x}")) for x in "ab")
    both = stars.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "items_a", "items_b")
    near = hand_over(both.mapInArrow(_confirm(similarity), "a long, b long"), "near-links")
    near = near if known is None else near.unionByName(known)

    rooted = components(near).select(F.col("vertex").alias("fp"), "root")
    # The least text of a key has been compared with all others of it; they are left.
    members = shared.join(rooted.hint("merge"), "fp", "left").select("band", "fp", "size", F.coalesce("root", "fp").alias("root"))
    members = hand_over(members, "near-members")
    counted = members.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    chunks = lambda n, size: F.ceil(F.greatest(n / F.lit(chunk), size / F.lit(CHUNK_BYTES)))
    parts = (
        counted.groupBy("band")
        .agg(F.max(F.struct("n", "bytes", "root")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        .where(F.col("n") > F.col("top.n"))
        .select(
            "band",
            F.col("top.root").alias("major"),
            chunks(F.col("top.n"), F.col("top.bytes")).alias("majors"),
            chunks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("minors"),
        )
    )
    # Chunks of the largest component come first, 0 to majors - 1; those of the others follow and meet all.
    every = F.sequence(F.lit(0).cast("long"), F.col("majors") + F.col("minors") - 1)
    dealt = (
        members.join(parts.hint("merge"), "band")
        .withColumn("minor", F.col("root") != F.col("major"))
        .withColumn("at", F.pmod(F.xxhash64("fp"), F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors"))))
        .withColumn("chunk", F.col("at") + F.when(F.col("minor"), F.col("majors")).otherwise(0))
        .withColumn("other", F.explode(F.when(F.col("minor"), every).otherwise(F.filter(every, lambda c: c >= F.col("majors")))))
        .select("band", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "fp", "root", "minor")
    )
    forest = (
        dealt.join(distinct.select("fp", "sketch").hint("merge"), "fp")
        .join(sets.hint("merge"), "fp")
        .select("band", "lo", "hi", "chunk", "fp", "root", "minor", "sketch", "items")
        .repartition("band", "lo", "hi")
        .sortWithinPartitions("band", "lo", "hi", "fp")
        .mapInArrow(_forest(similarity), "a long, b long")
    )
    return near.unionByName(hand_over(forest.distinct(), "near-trees"))


def near_copies(
    docs: DataFrame,
    shingle: int = 5,
    similarity: float = 0.8,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    fingerprinted: bool = False,
) -> DataFrame:
    """``key, digest, component, component_id`` of every row; component_id is the least key of the component.

    Texts with one and the same set of shingles always link: copies, and all null and wordless texts. With
    ``fingerprinted``, texts that ``simhash.near_duplicates`` puts in one component link too. Rows with a
    null key have a component, but name none. ``digest`` is a hash of the text, ``component`` a number of the component that
    also tells components without a key apart. Rows that repeat a key with different texts are rows of their own; an empty
    table gives an empty result. A text is worked on as a whole in one task; its set of hashes takes eight bytes a word.
    Other columns are ignored.
    """
    kind = docs.select(f"`{key}`").schema[0].dataType.simpleString()
    texts = docs.select(F.col(f"`{key}`").alias("key"), _digest(text), bytes_of(f"`{text}`").alias("_bytes"))
    columns = f"key {kind}, digest long, fp long, bands array<long>, sketch binary, size long, simhash long"
    marks = texts.mapInArrow(_marks(shingle, fingerprinted), columns)
    marked = hand_over(marks, "near-marks")
    distinct = hand_over(
        marked.groupBy("fp").agg(
            F.min("key").alias("low"),
            F.min(F.struct("digest", "key")).alias("at"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
            F.first("size").alias("size"),
        ),
        "near-distinct",
    )
    known = class_links(marked) if fingerprinted else None
    rooted = components(links(distinct, texts, shingle, similarity, chunk, known)).select(F.col("vertex").alias("fp"), "root")
    groups = distinct.select("fp", "low").join(rooted, "fp", "left").withColumn("component", F.coalesce("root", "fp"))
    least = groups.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = groups.join(least, "component").select("fp", "component", "component_id")
    return marked.join(classes, "fp").select(F.col("key").alias(key), "digest", "component", "component_id")


def _digest(text: str):
    return F.xxhash64(F.col(f"`{text}`")).alias("digest")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component of near copies, with all its columns: that of the least key, rows without a key last.

    Where one key has several texts of a component, the text with the least digest stays; of rows alike in key and text one
    stays. Options are those of ``near_copies``. No component is lost: as many rows stay as there are components.
    """
    classes = hand_over(near_copies(docs, key=key, text=text, **options).select(F.col(f"`{key}`").alias("key"), "digest", "component"), "near-classes")
    first = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "digest")).alias("first")
    firsts = classes.groupBy("component").agg(first).select("component", F.col("first.key").alias("_key"), F.col("first.digest").alias("_digest"))
    alike = F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest"))
    # The rows to keep grow with the input and are never broadcast: the same plan at every size.
    same = classes.withColumnRenamed("component", "c").join(firsts.hint("merge"), alike & (F.col("c") == F.col("component")))
    chosen = hand_over(same.groupBy("_key", "_digest").agg(F.count("*").alias("_rows")), "near-firsts")
    named = docs.withColumns({"_near_key": F.col(f"`{key}`"), "_near_digest": _digest(text)})

    def rows_of(wanted: DataFrame) -> DataFrame:
        there = F.col("_near_key").eqNullSafe(F.col("_key")) & (F.col("_near_digest") == F.col("_digest"))
        return named.join(wanted.select("_key", "_digest").hint("merge"), there, "left_semi")

    repeated = chosen.where("_rows > 1")
    if repeated.isEmpty():
        return rows_of(chosen).select(*[F.col(f"`{c}`") for c in docs.columns])
    once = rows_of(repeated).dropDuplicates(["_near_key", "_near_digest"])
    kept = rows_of(chosen.where("_rows = 1")).unionByName(once)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
