"""Near copies by five-word shingles: components by brute force, and what the pipeline stage removes."""

import collections
import random

import pytest
from test_simhash import brute_fingerprint

import corpus_pipeline
from sluiceway.llm import near_copies as n
from sluiceway.llm import simhash


def brute(texts, similarity=0.8):
    sets = {}
    for i, t in texts.items():
        ws = t.lower().split()
        sets[i] = {tuple(ws[j : j + 5]) for j in range(len(ws) - 4)} or {tuple(ws)}
    low = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for i in texts:
            for j in texts:
                if low[j] < low[i] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                    low[i], changed = low[j], True
    return low


def families(seed=1):
    """Ten texts, each with twelve chained edits: a chain drifts away from its first text, so links go over others."""
    rng = random.Random(seed)
    texts = {}
    for family in range(10):
        words = [f"v{rng.randrange(5000)}" for _ in range(rng.choice([60, 120, 300]))]
        for _ in range(13):
            texts[len(texts) * 7 % 131] = " ".join(words)
            words = list(words)
            for _ in range(rng.choice([1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"v{rng.randrange(5000)}"
    return texts


@pytest.mark.parametrize("chunk", [n.CHUNK, 3])
def test_components_by_brute_force(documents, chunk):
    texts = families()
    got = {r.doc_id: r.component_id for r in n.near_copies(documents(*texts.items()), chunk=chunk).collect()}
    assert got == brute(texts)


def test_stage_removes_near_copies_beyond_two_bits(spark, documents):
    rng = random.Random(2)
    words = [f"v{rng.randrange(5000)}" for _ in range(200)]
    texts = {0: " ".join(words)}
    for i in range(1, 9):
        edited = list(words)
        for at in rng.sample(range(200), 2):
            edited[at] = "edited"
        texts[i] = " ".join(edited)
    texts[9] = " ".join(f"v{rng.randrange(5000)}" for _ in range(200))
    kept = corpus_pipeline.near_dedup(spark, documents(*texts.items()), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9]


def variants(n, seed=4):
    """Texts that differ from one of 200 words in two to four: close to the similarity, on both sides."""
    rng = random.Random(seed)
    words = [f"v{rng.randrange(5000)}" for _ in range(200)]
    for _ in range(n):
        edited = list(words)
        for at in rng.sample(range(200), rng.choice([2, 3, 4])):
            edited[at] = f"e{rng.randrange(10**6)}"
        yield " ".join(edited)


@pytest.mark.parametrize("n_texts", [150, 600])
def test_links_stay_below_the_rows(documents, monkeypatch, n_texts):
    """A group of near copies gives trees, not pairs, whatever its size."""
    made = {}
    plain = n.hand_over

    def counting(df, purpose):
        out = plain(df, purpose)
        made[purpose] = out.count()
        return out

    monkeypatch.setattr(n, "hand_over", counting)
    texts = dict(enumerate(variants(n_texts)))
    got = {r.doc_id: r.component_id for r in n.near_copies(documents(*texts.items())).collect()}
    assert n_texts > 150 or got == brute(texts)
    assert collections.Counter(got.values()).most_common(1)[0][1] > n_texts / 4
    assert made["near-trees"] <= n_texts and made["near-stars"] <= n_texts * n.BANDS


def test_recall_against_all_pairs(spark):
    """All pairs of 0.8 among the distinct shingle sets of a table, by prefix filter: nine of ten links or more are found."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    sets = {}
    for r in docs.collect():
        found = n.shingles((r.text or "").encode())
        sets.setdefault(found.tobytes(), (r.doc_id, found))
    items = sorted(sets.values(), key=lambda x: len(x[1]))
    frequency = collections.Counter(h for _, s in items for h in s.tolist())
    index, pairs = collections.defaultdict(list), []
    for i, (doc, s) in enumerate(items):
        rare = sorted(s.tolist(), key=lambda h: (frequency[h], h))[: len(s) - -(-8 * len(s) // 10) + 1]
        for j in {j for h in rare for j in index[h]}:
            if n.jaccard(s, items[j][1]) >= 0.8:
                pairs.append((doc, items[j][0]))
        for h in rare:
            index[h].append(i)
    of = {r.doc_id: r.component_id for r in n.near_copies(docs).collect()}
    assert len(pairs) >= 40 and sum(of[a] == of[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_odd_rows(odd):
    rows = n.near_copies(odd).collect()
    assert len(rows) == odd.count() and {r.component_id for r in rows if r.doc_id in (1, 2, 4)} == {1}
    assert n.near_copies(odd.limit(0)).count() == 0
    kept = n.keep_first(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 5, 6] and ids.count(None) == 1
    assert n.keep_first(odd.limit(0)).count() == 0


def test_one_row_of_each_component_stays(documents):
    a, b, c = (" ".join(f"{x}{i}" for i in range(12)) for x in "abc")
    kept = n.keep_first(documents((1, a), (1, b), (2, b), (3, c), (1, c), (1, a), (None, "d e"), (None, "d e"), (None, a))).collect()
    assert sorted(r.text for r in kept) == sorted([a, b, c, "d e"])
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 1)] * 3 + [(True, 0)]


def shared_lines(seed=6):
    """Texts of one long repeated line with endings of their own: alike to op2, and below the similarity as sets."""
    rng = random.Random(seed)
    line = " ".join(f"v{rng.randrange(5000)}" for _ in range(30))
    return {1000 + i: " ".join([line] * 40 + [f"e{rng.randrange(10**6)}" for _ in range(20)]) for i in range(6)}


@pytest.mark.parametrize("chunk", [n.CHUNK, 3])
def test_components_of_both_links_by_brute_force(documents, chunk):
    texts = families() | shared_lines()
    low, prints = brute(texts), {i: brute_fingerprint(t) for i, t in texts.items()}
    assert len({low[i] for i in texts if i >= 1000}) == 6
    for i in texts:
        for j in texts:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((low[i], low[j]))
                low = {k: a if v == b else v for k, v in low.items()}
    assert len({low[i] for i in texts if i >= 1000}) < 6
    got = {r.doc_id: r.component_id for r in n.near_copies(documents(*texts.items()), chunk=chunk, fingerprinted=True).collect()}
    assert got == low


def test_stage_keeps_one_document_of_each_component_of_op2(spark):
    """Four pairs of sf0.1 lie within two bits and share less than 0.8 of their shingles; a fifth shares more."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    docs = docs.where(docs.doc_id.isin(3, 212, 385, 4738, 589, 6676, 2528, 5966, 7810, 9829) | (docs.doc_id < 300)).cache()
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept >= {3, 385, 589, 2528, 7810} and not kept & {212, 4738, 6676, 5966, 9829}
    of = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert len({of[i] for i in kept}) == len(kept)


def test_odd_rows_with_fingerprints(odd):
    rows = n.near_copies(odd, fingerprinted=True).collect()
    assert len(rows) == odd.count() and {r.component_id for r in rows if r.doc_id in (1, 2, 4)} == {1}
    assert n.near_copies(odd.limit(0), fingerprinted=True).count() == 0
    assert n.keep_first(odd, fingerprinted=True).count() == 5
