"""Passages that documents share: what the two substring operators have in common.

A window is ``width`` consecutive units (words or bytes) of one document. A unit is removed if a window over it
also starts in a document with a smaller key. To find these windows without sorting every position of the
corpus, equal windows are brought together by anchors:

1. Each window has an anchor: the first of its k-grams with the least hash. Equal windows have equal anchors,
   whatever surrounds them, and neighbouring windows mostly share theirs, so few positions are anchors. The
   windows of one anchor are a passage.
2. Only anchors that occur in two different texts can belong to a shared window; the others are dropped. In a
   large corpus short k-grams of different texts are equal by chance, nearly all of them in the end. So more has
   to be equal (``Units.sides``): a window reaches half of the rest of its length to the left or to the right of
   its anchor, and what lies there occurs in two different texts too.
3. Each remaining passage is sent to the shard of its anchor. There the operator's own index finds the windows
   that started in a smaller document.

An anchor that so many texts contain that it would make one task slow is split: its windows, cut out one by
one, are keyed by their content instead. Texts that are equal as a whole are searched once, for the least key;
in the others everything is shared.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import bytes_of, steps
from sluiceway.session import hand_over, own_files, sweep

ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of segments that a shard index is built over at once, and rows of one anchor that stay together.
SHARD_BYTES, FEWEST_HOT, MOST_TOGETHER = 1 << 20, 2_000, 16_000
#: Units of one text that are looked at together, as a power of 2: their places take the lowest bits of hashes. Units of short texts.
PIECE_BITS, TOGETHER = 20, 1 << 16


@dataclass(frozen=True)
class Units:
    """How an operator sees a text: ``cut`` gives its units, ``codes`` a 64-bit code for each, ``join`` undoes cut.

    ``width`` is below half a piece. ``sides`` says whether k-grams are so short that passages are told by more.
    """

    width: int
    gram: int
    cut: Callable[[bytes], list[bytes] | bytes]
    codes: Callable[[list[bytes] | bytes], np.ndarray]
    join: Callable[[list[bytes] | bytes], bytes]
    sides: bool = False


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sliding(values: np.ndarray, span: int, pick: np.ufunc) -> np.ndarray:
    """pick over every ``span`` consecutive values, in about log2(span) passes."""
    done, out = 1, values
    while 2 * done <= span:
        out, done = pick(out[:-done], out[done:]), 2 * done
    rest = span - done
    return pick(out[:-rest], out[rest:]) if rest else out


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """The powers of ODD, and those of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(1 << PIECE_BITS, x, np.uint64)))) for x in (ODD, inverse))


def _sums(codes: np.ndarray) -> np.ndarray:
    """What ``_hashes`` tells the hashes of all parts of a piece from."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * _powers()[0][: len(codes)])))


def _hashes(sums: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of the ``size`` codes from each ``begin`` on."""
    return _mixed((sums[begin + size] - sums[begin]) * _powers()[1][begin])


def anchors(codes: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the k-grams that are the first least of some window of a piece; nothing below a window.

    Hashes are compared without their lowest PIECE_BITS, which hold the position here.
    """
    n, k = len(codes), units.gram
    if n < units.width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = _sums(codes)
    grams = _mixed((sums[k:] - sums[:-k]) * _powers()[1][: n - k + 1])
    low = np.uint64((1 << PIECE_BITS) - 1)
    least = _sliding(grams & ~low | np.arange(n - k + 1, dtype=np.uint64), units.width - k + 1, np.minimum) & low
    at = least[np.concatenate(([True], least[1:] != least[:-1]))].astype(np.int64)
    return at, grams[at].view(np.int64)


def _pieces(cuts: Iterator[list[bytes] | bytes], units: Units) -> Iterator[list[tuple]]:
    """Lists of (row, offset, cut): short texts several together, long ones in pieces that overlap by less than a window."""
    held, size, most = [], 0, 1 << PIECE_BITS
    for row, cut in enumerate(cuts):
        for offset in range(0, len(cut) - units.width + 1, most - units.width + 1):
            piece = cut[offset : offset + most]
            if held and size + len(piece) > min(TOGETHER, most):
                yield held
                held, size = [], 0
            held.append((row, offset, piece))
            size += len(piece)
    if held:
        yield held


def passages(cuts: Iterator[list[bytes] | bytes], units: Units) -> Iterator[tuple]:
    """Some at a time: (pieces, piece, begin, end, anchor, sides) of the passages of texts.

    A passage is the windows of a piece that start from ``begin`` to before ``end`` and have one anchor; each window of a text is
    in one. A side is the hash of half of a window, the anchor included, and masked where no window of the passage reaches so far.
    """
    width, reach, half = units.width, units.width - units.gram, (units.width - units.gram + 1) // 2
    for pieces in _pieces(cuts, units):
        codes = [units.codes(piece) for _, _, piece in pieces]
        until = np.cumsum([len(c) for c in codes])
        since = until - np.array([len(c) for c in codes])
        codes = np.concatenate(codes)
        at, hashes = anchors(codes, units)
        # The windows of an anchor end where the next one, if less, comes into them, or else where it leaves them itself.
        rank = hashes.view(np.uint64) >> np.uint64(PIECE_BITS)
        bounds = np.concatenate(([0], np.where(rank[1:] < rank[:-1], at[1:] - reach, at[:-1] + 1), [len(codes) - width + 1]))
        piece = np.searchsorted(until, at, side="right")
        begin, end = np.maximum(bounds[:-1], since[piece]), np.minimum(bounds[1:], until[piece] - width + 1)
        within = np.flatnonzero(begin < end)  # not windows over two texts
        at, piece, begin, end = at[within], piece[within], begin[within], end[within]
        sides = []
        if units.sides:
            sums = _sums(codes)
            for nearest, farthest in ((0, half - 1), (half, reach)):
                some = (begin <= at - nearest) & (end > at - farthest)
                same = _hashes(sums, np.where(some, at - nearest, 0), width - farthest + nearest)
                sides.append(np.ma.array((same >> np.uint64(32)).astype(np.uint32).view(np.int32), mask=~some))
        yield pieces, piece, begin - since[piece], end - since[piece], hashes[within], sides


def _emit_anchors(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_bytes"):
            reps = batch.column(0).to_numpy(zero_copy_only=False)
            for pieces, piece, _, _, hashes, sides in passages(map(units.cut, batch.column(1).to_pylist()), units):
                of = np.array([row for row, _, _ in pieces])[piece]
                # Once for each text.
                told = _mixed(hashes.view(np.uint64) + of.astype(np.uint64) * ODD)
                for side in sides:
                    told = _mixed(told + side.filled(0).astype(np.uint64) + (side.mask.astype(np.uint64) << np.uint64(40)))
                one = np.unique(told, return_index=True)[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[one]), pa.array(reps[of[one]]), *(pa.array(x.data[one], mask=x.mask[one]) for x in sides)],
                    names=["anchor", "rep", *SIDES[: len(sides)]],
                )

    return run


SIDES = ["right", "left"]
_SEGMENT = pa.schema(
    [("anchor", pa.int64()), ("key", pa.int64()), ("digest", pa.int64()), ("begin", pa.int64()), ("segment", pa.binary()), ("hot", pa.bool_())]
)


def _emit_segments(units: Units):
    """Rows (key, digest, _bytes, anchors, hot) to the passages of their shared anchors, or single windows of hot ones."""

    def of_row(anchors: np.ndarray, row: np.ndarray) -> np.ndarray:
        return _mixed(anchors.view(np.uint64) + row.astype(np.uint64) * ODD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in steps(batches, "_bytes"):
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            known, hot = (columns[name].flatten().to_numpy(zero_copy_only=False) for name in ("anchors", "hot"))
            known = of_row(known, np.repeat(np.arange(batch.num_rows), columns["anchors"].value_lengths().to_numpy()))
            order = np.argsort(known)
            known, hot = known[order], hot[order]

            def part(of: np.ndarray, route: np.ndarray, begin: np.ndarray, segments: list[bytes], warm: bool) -> pa.RecordBatch:
                whose = pa.array(of)
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(route),
                        columns["key"].take(whose),
                        columns["digest"].take(whose),
                        pa.array(begin),
                        pa.array(segments, pa.binary()),
                        pa.array(np.full(len(of), warm)),
                    ],
                    schema=_SEGMENT,
                )

            texts = map(units.cut, (x.as_py() for x in columns["_bytes"]))
            for pieces, piece, begin, end, hashes, _ in passages(texts, units):
                rows, offsets = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
                told = of_row(hashes, rows[piece])
                place = np.minimum(np.searchsorted(known, told), len(known) - 1)
                shared = known[place] == told
                for warm in (False, True):
                    mine = np.flatnonzero(shared & (hot[place] == warm))
                    if not len(mine):
                        continue
                    p, b, e = piece[mine], begin[mine], end[mine]
                    if not warm:
                        cut = [units.join(pieces[x][2][y:z]) for x, y, z in zip(p.tolist(), b.tolist(), (e + units.width - 1).tolist())]
                        yield part(rows[p], hashes[mine], offsets[p] + b, cut, False)
                        continue
                    sizes = e - b
                    p, b = np.repeat(p, sizes), np.arange(sizes.sum()) + np.repeat(b - np.cumsum(sizes) + sizes, sizes)
                    cut = [xxhash.xxh3_128_digest(units.join(pieces[x][2][y : y + units.width])) for x, y in zip(p.tolist(), b.tolist())]
                    route = np.array([int.from_bytes(w[:8], "little", signed=True) for w in cut], np.int64)
                    yield part(rows[p], route, offsets[p] + b, cut, True)

    return run


#: Anchors, keys and segments, of whole anchors and sorted, to covered ranges (row, begin, end).
Match = Callable[[np.ndarray, np.ndarray, list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _by_shard(match: Match):
    """Cut rows sorted by (anchor, key) into shards of whole anchors and match each shard."""

    def matched(rows: pa.Table) -> pa.RecordBatch:
        at, begin, end = match(rows["anchor"].to_numpy(), rows["key"].to_numpy(), rows["segment"].to_pylist())
        base = rows["begin"].to_numpy()[at]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows["key"].to_numpy()[at]),
                rows["digest"].combine_chunks().take(pa.array(at)),
                pa.array(base + begin),
                pa.array(base + end),
            ],
            names=["key", "digest", "begin", "end"],
        )

    def weight(part: pa.RecordBatch) -> int:
        return part.num_rows + pc.sum(pc.binary_length(part.column(4))).as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                held.append(part)
                size += weight(part)
                if size >= SHARD_BYTES:
                    rows = pa.Table.from_batches(held)
                    routes = rows["anchor"].to_numpy()
                    whole = int(np.searchsorted(routes, routes[-1]))
                    if whole:
                        yield matched(rows.slice(0, whole))
                        rows = rows.slice(whole)
                    held = rows.to_batches()
                    size = sum(map(weight, held)) if whole else 0
        if held:
            yield matched(pa.Table.from_batches(held))

    return run


def covered(docs: DataFrame, units: Units, match: Match, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, digest, whole, spans``: the covered ranges of units of texts that have any.

    A row is told by its key and a 64-bit digest of its text; which texts are equal is decided by 128 bits. ``whole`` marks later copies of a text, which are
    covered as a whole if they have a window at all. Keys are integers; rows with a null key are no reference
    and keep everything.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("key"),
        F.unhex(F.md5(body.cast("binary"))).alias("digest"),
        F.xxhash64(body).alias("rep"),
        bytes_of(text).alias("_bytes"),
    )
    rows = hand_over(keyed.select("key", "digest", "rep").distinct(), "repeats-rows")
    # Written, so that the joins below shuffle both sides and Spark can split a digest that many rows share.
    firsts = hand_over(rows.groupBy("digest").agg(F.min("key").alias("key"), F.first("rep").alias("rep")), "repeats-firsts")
    copies = rows.join(firsts.select("digest", F.col("key").alias("_first")), "digest").where(F.col("key") > F.col("_first"))

    sides = SIDES if units.sides else []
    emitted = keyed.select("rep", "_bytes").mapInArrow(_emit_anchors(units), ", ".join(["anchor long, rep long", *(f"{x} int" for x in sides)]))

    def in_two(*by: str) -> Column:
        same = Window.partitionBy(*by)
        return F.col(by[-1]).isNotNull() & (F.min("rep").over(same) < F.max("rep").over(same))

    twice = emitted.withColumn("_two", in_two("anchor")).where("_two")
    if sides:
        twice = twice.withColumns({f"_{x}": in_two("anchor", x) for x in sides}).where(" or ".join(f"_{x}" for x in sides))
    # Spark need not sort or deal out again for windows within those of one anchor.
    shared = hand_over(twice.select("anchor", "rep", F.count("*").over(Window.partitionBy("anchor")).alias("n")), "repeats-anchors")
    sweep(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot_from = min(MOST_TOGETHER, max(FEWEST_HOT, shared.count() // (2 * tasks)))
    lists = (
        shared.withColumn("hot", F.col("n") > hot_from)
        .groupBy("rep")
        .agg(F.collect_set(F.struct("anchor", "hot")).alias("found"))
        .join(firsts, "rep")
        .select("key", F.col("rep").alias("digest"), F.col("found.anchor").alias("anchors"), F.col("found.hot").alias("hot"))
    )
    texts = keyed.select("key", F.col("rep").alias("digest"), "_bytes").join(lists, ["key", "digest"])
    segments = hand_over(
        texts.select("key", "digest", "_bytes", "anchors", "hot").mapInArrow(
            _emit_segments(units), "anchor long, key long, digest long, begin long, segment binary, hot boolean"
        ),
        "repeats-segments",
    )
    sweep(spark)
    in_shards = (
        segments.where(~F.col("hot"))
        .select("anchor", "key", "digest", "begin", "segment")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "key")
        .mapInArrow(_by_shard(match), "key long, digest long, begin long, end long")
    )
    windows = segments.where("hot").select(F.col("segment").alias("window"), "key", "digest", "begin")
    first_key = hand_over(windows.groupBy("window").agg(F.min("key").alias("_first")), "repeats-windows")
    in_windows = (
        windows.join(first_key, "window")
        .where(F.col("_first") < F.col("key"))
        .select("key", "digest", "begin", (F.col("begin") + units.width).alias("end"))
    )
    spans = (
        in_shards.unionByName(in_windows)
        .groupBy("key", "digest")
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"), F.lit(False).alias("whole"))
    )
    none = F.array().cast("array<struct<begin:long,end:long>>")
    return spans.unionByName(copies.select("key", F.col("rep").alias("digest"), none.alias("spans"), F.lit(True).alias("whole")))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def _strip(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in steps(batches, "_bytes"):
            out: tuple[list, ...] = ([], [], [], [], [])
            for text, spans, whole in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                cut = units.cut(text)
                n = len(cut)
                gone = [(0, n)] if whole and n >= units.width else merged(spans or [])
                left, kept = 0, []
                for begin, end in gone:
                    kept.append(cut[left:begin])
                    left = end
                kept.append(cut[left:])
                rest = units.join(type(cut)().join(kept)) if isinstance(cut, bytes) else units.join([u for k in kept for u in k])
                pairs = [{"begin": b, "end": e} for b, e in gone]
                for column, value in zip(out, (n, sum(e - b for b, e in gone), pairs, rest, hashlib.sha256(rest).hexdigest())):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), span, pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["key", "n_units", "n_removed", "spans", "kept", "kept_sha256"],
            )

    return run


def remove(docs: DataFrame, units: Units, match: Match, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_units, n_removed, spans, kept, kept_sha256`` of every row; kept is the remaining text in bytes."""
    with own_files(docs.sparkSession):
        found = hand_over(covered(docs, units, match, key, text), "repeats-spans", beyond=True).withColumnRenamed("key", "_key")
    sweep(docs.sparkSession)
    kind = docs.select(key).schema[0].dataType.simpleString()
    body = docs.select(
        F.col(f"`{key}`").alias("key"), bytes_of(text).alias("_bytes"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_digest")
    )
    joined = body.join(found, (F.col("key") == F.col("_key")) & (F.col("_digest") == F.col("digest")), "left")
    stripped = joined.select("key", "_bytes", "spans", F.coalesce("whole", F.lit(False)).alias("whole")).mapInArrow(
        _strip(units),
        f"key {kind}, n_units long, n_removed long, spans array<struct<begin:long,end:long>>, kept binary, kept_sha256 string",
    )
    return stripped.withColumnRenamed("key", key)
