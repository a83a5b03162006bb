"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group that stays in one shard. Groups, from large to small, go to the shard
with the least room that still takes them; shards are kept in a balanced tree ordered by their room. For a
given number of shards the capacity is the least one, up to a tolerance, for which the packing needs no more.

Groups of equal size are interchangeable, so the packing runs over size classes and their counts, and its
result says which range of a class goes where. Sizes below EXACT bytes are classes of their own; larger
ones are classed by their leading bits, at most 0.1 % apart, and packed at their mean, or at their largest
where a capacity is given and must hold. So at most
``EXACT + 1024 * 64`` class rows reach the driver, whatever the input; groups are assigned by Spark.

A group larger than a whole shard cannot be kept together by any packing with equal capacities. It is cut
into parts of an eighth of a shard by a hash of the key; with a given capacity, into its rows. At most ``shards``
groups can be that large.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.numbering import number_rows
from sluiceway.session import hand_over

EXACT = 1 << 16
TOLERANCE = 1e-4


class RoomTree:
    """Bins ordered by (room, number) in a treap; finds the least room of at least a given size."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return hash((key[0] * 2654435761 + 1, key[1])) & 0xFFFFFFFF

    @classmethod
    def _split(cls, node, key):
        if node is None:
            return None, None
        at, _, left, right = node
        if at < key:
            low, high = cls._split(right, key)
            node[3] = low
            return node, high
        low, high = cls._split(left, key)
        node[2] = high
        return low, node

    @classmethod
    def _merge(cls, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = cls._merge(low[3], high)
            return low
        high[2] = cls._merge(low, high[2])
        return high

    def add(self, room: int, number: int) -> None:
        key = (room, number)
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, self._priority(key), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room >= size."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, rest = self._split(high, (key[0], key[1] + 1))
        self.root = self._merge(low, rest)
        return key


@dataclass(frozen=True)
class Run:
    """Groups number first to first + count - 1 of a size class go to a shard."""

    size_class: int
    first: int
    count: int
    shard: int


def pack(classes: list[tuple[int, int, int]], capacity: int, most: int | None = None) -> list[Run] | None:
    """Best fit over (class, size, count); sizes fall. None if more than ``most`` bins would be needed."""
    tree, runs, bins = RoomTree(), [], 0
    for size_class, size, count in sorted(classes, key=lambda c: (-c[1], c[0])):
        done = 0
        while done < count:
            bin_ = tree.take_tightest(size)
            if bin_ is None:
                if bins == most:
                    return None
                bin_ = (max(capacity, size), bins)
                bins += 1
            room, number = bin_
            # After a group went in, this bin is tighter than before and stays the tightest that fits.
            n = min(count - done, room // size if size else count)
            tree.add(room - n * size, number)
            runs.append(Run(size_class, done, n, number))
            done += n
    return runs


def pack_into(classes: list[tuple[int, int, int]], shards: int, tolerance: float = TOLERANCE) -> list[Run]:
    """The packing with the least capacity, up to ``tolerance`` of it, that needs at most ``shards`` bins."""
    total = sum(size * count for _, size, count in classes)
    low = max([-(-total // shards), *(size for _, size, _ in classes), 1])
    best = pack(classes, low, shards)
    if best is not None:
        return best
    step = max(1, int(low * tolerance))
    fails, works = low, low + step
    while (best := pack(classes, works, shards)) is None:
        fails, works, step = works, works + 2 * step, 2 * step
    while works - fails > max(1, int(low * tolerance)):
        middle = (fails + works) // 2
        packed = pack(classes, middle, shards)
        if packed is None:
            fails = middle
        else:
            works, best = middle, packed
    return best


def _size_class(size: str):
    """The class of a group size: itself, or its leading 11 bits."""
    keep = F.expr(f"cast(greatest(0, floor(log2(greatest({size}, 1))) - 10) as int)")
    return F.when(F.col(size) < EXACT, F.col(size)).otherwise(
        F.call_function("shiftleft", F.call_function("shiftright", F.col(size), keep), keep)
    )


def assign(
    docs: DataFrame, shards: int | None = 16, capacity: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` of every row.

    Give the number of ``shards``, or a ``capacity`` in bytes to use as few shards of that size as best fit
    finds; no shard then holds more, but one whose only row is larger. The size of a row is its UTF-8 bytes plus 1; a null text counts as empty. Slots number the rows of
    a shard from 0 by key; rows with a null key come first, rows that repeat a key get distinct slots in an
    arbitrary order. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = hand_over(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(body.cast("binary"))).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest", "size").agg((F.count("*") * F.col("size")).alias("bytes")).select("digest", "bytes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = capacity or -(-total // shards) or 1
    # Fewer than total / limit groups are larger than the limit; with a capacity that number grows with the input.
    huge = hand_over(groups.where(F.col("bytes") > limit), "shard-huge")
    parts = huge.select("digest", F.ceil(8 * F.col("bytes") / limit).alias("parts"))
    cut = rows.join(parts.hint("merge") if capacity else F.broadcast(parts), "digest", "left")
    by_key = F.pmod(F.xxhash64("key"), F.col("parts"))
    if capacity:  # rows of one key, or of a hash, may exceed a part: each row of a huge group is a unit of its own
        by_key = F.xxhash64("key", F.monotonically_increasing_id())
    parted = cut.withColumn("part", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(by_key).cast("long"))
    if capacity:
        parted = hand_over(parted, "shard-parted")
    units = (
        parted.groupBy("digest", "part")
        .agg(F.sum("size").alias("bytes"))
        .withColumn("class", _size_class("bytes"))
    )
    numbered = hand_over(number_rows(units, ["class"], ["digest", "part"], "rank"), "shard-units")
    classes = [
        (r["class"], r["mean"], r["n"])
        for r in numbered.groupBy("class").agg((F.max("bytes") if capacity else F.ceil(F.avg("bytes"))).alias("mean"), F.count("*").alias("n")).collect()
    ]
    runs = pack(classes, capacity) if capacity else pack_into(classes, shards)
    plan = spark.createDataFrame(
        [(r.size_class, r.first, r.first + r.count, r.shard) for r in runs],
        "class long, first long, until long, shard int",
    )
    # A class has a run for each shard at most; most have one. Ranges of a class are looked up in one array.
    ranges = plan.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("first", "until", "shard"))).alias("runs"))
    shard = F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["until"]))[0]["shard"]
    placed = numbered.join(ranges, "class").select("digest", "part", shard.alias("shard"))
    sharded = parted.join(placed, ["digest", "part"]).select("key", "size", "text_crc32", "shard")
    return number_rows(sharded, ["shard"], ["key"], "slot").withColumnRenamed("key", key)
