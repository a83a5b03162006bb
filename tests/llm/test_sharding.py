"""Sharding: the packing against a plain one, and the laws of the assignment."""

import collections
import random
import zlib

from sluiceway.llm import sharding as s


def plain_best_fit(sizes, capacity):
    rooms, placed = [], []
    for size in sorted(sizes, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            _, i = min(fits)
        else:
            rooms.append(max(capacity, size))
            i = len(rooms) - 1
        rooms[i] -= size
        placed.append((size, i))
    return collections.Counter(placed), len(rooms)


def test_packing_is_best_fit():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 60))]
        capacity = rng.randint(20, 60)
        runs = s.pack([(z, z, n) for z, n in collections.Counter(sizes).items()], capacity)
        placed = collections.Counter()
        for r in runs:
            placed[r.size_class, r.shard] += r.count
        expected, bins = plain_best_fit(sizes, capacity)
        assert +placed == expected and len({r.shard for r in runs}) == bins


def test_tree():
    tree, rng, held = s.RoomTree(), random.Random(1), set()
    for i in range(2000):
        room = rng.randint(0, 300)
        tree.add(room, i)
        held.add((room, i))
        if rng.random() < 0.6:
            size = rng.randint(0, 300)
            expected = min((h for h in held if h[0] >= size), default=None)
            assert tree.take_tightest(size) == expected
            held.discard(expected)


def check(docs, rows, shards):
    texts = collections.defaultdict(set)
    slots, load = collections.defaultdict(list), collections.Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(load) <= set(range(shards))
    return texts, load


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = s.assign(docs, shards=16).collect()
    _, load = check(docs, rows, 16)
    assert max(load.values()) - min(load.values()) <= 0.01 * max(load.values())
    together = collections.defaultdict(set)
    for r in rows:
        together[texts[r.doc_id]].add(r.shard)
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode()))
    assert {len(v) for v in together.values()} == {1} and len(rows) == len(texts)


def test_group_larger_than_a_shard_is_spread(documents):
    docs = documents(*["the same text"] * 300, *[f"text number {i}" for i in range(600)])
    rows = s.assign(docs, shards=8).collect()
    _, load = check(docs, rows, 8)
    assert max(load.values()) < 1.1 * min(load.values())


def test_capacity(documents):
    rows = s.assign(documents(*["x" * n for n in (9, 9, 5, 4, 3, 1)]), shards=None, capacity=16).collect()
    _, load = check(None, rows, 16)
    assert max(load.values()) <= 16 and sum(load.values()) == 37


def test_capacity_holds_for_classed_sizes(documents):
    """Sizes of one class differ; a shard of the largest must not overrun."""
    docs = documents(*["x" * (70_000 + 13 * n) for n in range(30)], *["y" * 500] * 300, "z" * 400_000)
    capacity = 210_067
    rows = s.assign(docs, shards=None, capacity=capacity).collect()
    _, load = check(None, rows, len(rows))
    assert sorted(load.values())[-1] == 400_001 and sorted(load.values())[-2] <= capacity
    assert sum(load.values()) == sum(r["size"] for r in rows) and len(load) <= 17


def test_odd_rows(odd):
    rows = s.assign(odd, shards=3).collect()
    check(odd, rows, 3)
    assert len(rows) == odd.count() and sorted(r["size"] for r in rows)[:2] == [1, 1]
    assert s.assign(odd.limit(0)).count() == 0
