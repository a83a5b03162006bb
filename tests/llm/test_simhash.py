"""SimHash: fingerprints and components by brute force."""

import re

import numpy as np
import pytest
import xxhash

from sluiceway.llm import simhash as s
from sluiceway.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m.group(0).lower(), text or ""))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(fps):
    low = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= 2 and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


@pytest.mark.parametrize("largest", [s.LARGEST, 2])
def test_whole_table(spark, sf_dir, largest):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in s.near_duplicates(docs, largest=largest).collect()}
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    low = brute_components(fps)
    assert got == {i: (f"{fps[i]:016x}", low[i]) for i in fps}


def test_bit_sliced_comparison():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64) for _ in range(2)]
    fps = np.unique(np.concatenate([b ^ flips[0] ^ flips[1] for b in base]))
    rng.shuffle(fps)
    group = np.sort(rng.integers(0, 7, len(fps)))
    first, last = np.searchsorted(group, group, "left"), np.searchsorted(group, group, "right")
    a, b = s.close_pairs(fps, first, last)
    expected = {
        (i, j)
        for i in range(len(fps))
        for j in range(i + 1, len(fps))
        if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= 2
    }
    assert set(zip(a.tolist(), b.tolist())) == expected and len(a) == len(expected)


def test_components(spark):
    links = [(i + 1, i) for i in range(30)] + [(100, 50), (50, 100), (7, 7), (None, 3)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.vertex: r.root for r in rows} == {**{i: 0 for i in range(31)}, 50: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd):
    rows = s.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 4)} == {1}
    assert {r.component_id for r in rows if r.doc_id == 3} == {3}
    assert s.near_duplicates(odd.limit(0)).count() == 0
