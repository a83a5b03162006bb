"""Both substring operators against brute force, and their indexes alone."""

import hashlib
import random
import re

import numpy as np
import pytest

from sluiceway.llm import repeats, substring_dedup, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, cut, size, join):
    units, first = [(i, cut(t or "")) for i, t in rows], {}
    for i, u in units:
        for at in range(len(u) - size + 1) if i is not None else ():
            first[u[at : at + size]] = min(i, first.get(u[at : at + size], i))
    out = []
    for i, u in units:
        gone = bytearray(len(u))
        for at in range(len(u) - size + 1) if i is not None else ():
            if first[u[at : at + size]] < i:
                gone[at : at + size] = b"\1" * size
        kept = join([x for x, g in zip(u, gone) if not g])
        out.append((i, len(u), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def by_words(rows):
    return brute(rows, lambda t: tuple(WORD.findall(t)), 13, lambda kept: " ".join(kept).encode())


def by_bytes(rows):
    return brute(rows, str.encode, 50, bytes)


def result(df):
    return sorted(((r.doc_id, r.n_units, r.n_removed, len(r.spans), r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hot", [None, 2])
def test_whole_table(spark, sf_dir, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(repeats, "FEWEST_HOT", hot)
        monkeypatch.setattr(repeats, "MOST_TOGETHER", hot)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(substring_dedup.remove_repeats(docs)) == by_words(rows)
    assert result(suffix_dedup.remove_repeats(docs)) == by_bytes(rows)


def test_small_shards_and_copies(documents, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 300)
    rng = random.Random(8)
    phrases = [" ".join(rng.choice("abcde") + str(rng.randint(0, 30)) for _ in range(rng.randint(5, 30))) for _ in range(12)]
    rows = [(rng.randint(0, 60), " ".join(rng.choice(phrases) for _ in range(rng.randint(0, 5)))) for _ in range(70)]
    rows += [(5, rows[3][1]), (None, rows[3][1]), rows[7], rows[7]]
    docs = documents(*rows)
    assert result(substring_dedup.remove_repeats(docs)) == by_words(rows)
    assert result(suffix_dedup.remove_repeats(docs)) == by_bytes(rows)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(substring_dedup.remove_repeats(odd)) == by_words(rows)
    assert result(suffix_dedup.remove_repeats(odd)) == by_bytes(rows)
    assert substring_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_suffix_array():
    rng = random.Random(5)
    for _ in range(1500):
        text = [rng.randint(1, rng.choice([1, 2, 9])) for _ in range(rng.randint(0, 40))]
        assert suffix_dedup.suffix_array(np.array(text, np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    large = [rng.randint(1, 1 << 21) for _ in range(300)] * 2
    assert suffix_dedup.suffix_array(np.array(large)).tolist() == sorted(range(len(large)), key=lambda i: large[i:])


def test_suffix_automaton():
    rng = random.Random(6)
    for _ in range(600):
        added = [[rng.randint(0, 2) for _ in range(rng.randint(0, 12))] for _ in range(3)]
        query, size = [rng.randint(0, 2) for _ in range(rng.randint(0, 20))], rng.randint(1, 5)
        automaton = substring_dedup.SuffixAutomaton()
        for a in added:
            automaton.add(a)
        known = {tuple(a[i : i + size]) for a in added for i in range(len(a) - size + 1)}
        expected = {j for i in range(len(query) - size + 1) if tuple(query[i : i + size]) in known for j in range(i, i + size)}
        assert {j for b, e in automaton.covered(query, size) for j in range(b, e)} == expected


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(9)
    units = repeats.Units(13, 7, list, np.array, bytes)
    for _ in range(200):
        window = rng.integers(0, 4, 13, dtype=np.uint64)
        found = []
        for _ in range(2):
            before, after = rng.integers(0, 4, rng.integers(0, 20), dtype=np.uint64), rng.integers(0, 4, rng.integers(0, 20), dtype=np.uint64)
            at, hashes = repeats.anchors(np.concatenate((before, window, after)), units)
            inside = (at >= len(before)) & (at + 7 <= len(before) + 13)
            found.append(set(hashes[inside].tolist()))
        assert found[0] & found[1]


def test_chance_repeats_of_short_grams_are_not_sent(documents, monkeypatch):
    """Texts of long words share nearly all of their k-grams, but hardly ever 33 bytes; one passage is a true repeat."""
    rng, sent, hand_over = random.Random(11), {}, repeats.hand_over

    def counted(df, purpose, **how):
        written = hand_over(df, purpose, **how)
        sent[purpose] = written.count()
        return written

    monkeypatch.setattr(repeats, "hand_over", counted)
    words = ["".join(rng.choice("abcdefgh") for _ in range(19)) for _ in range(1000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(100)]
    rows[9] = (9, f"{rows[9][1]} {rows[4][1][100:190]}")
    assert result(suffix_dedup.remove_repeats(documents(*rows))) == by_bytes(rows)
    assert 0 < sent["repeats-segments"] < sum(len(t) for _, t in rows) // 400


def test_windows_of_a_text_lie_in_one_passage_each(monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(repeats, "PIECE_BITS", 7)
    repeats._powers.cache_clear()
    units = repeats.Units(20, 8, bytes, suffix_dedup._codes, bytes, sides=True)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 300))) for _ in range(3)]
        texts.append(texts[0][rng.randint(0, 30) :] + texts[1])
        starts, known = [[] for _ in texts], {}
        for pieces, piece, begin, end, anchor, sides in repeats.passages(iter(texts), units):
            for i, p in enumerate(piece.tolist()):
                row, offset, _ = pieces[p]
                told = {(anchor[i], at, side[i]) for at, side in enumerate(sides) if not side.mask[i]}
                for at in range(offset + begin[i], offset + end[i]):
                    starts[row].append(at)
                    window = texts[row][at : at + 20]
                    known[window] = known.get(window, told) & told
                    assert known[window]
        assert [sorted(x) for x in starts] == [list(range(max(0, len(t) - 19))) for t in texts]
    repeats._powers.cache_clear()


def test_only_the_spans_stay_on_disk(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr("sluiceway.session.shared_folder", lambda _, purpose: str(tmp_path / purpose))
    same = "one passage of some sixty bytes that two of these documents do hold"
    docs = documents((1, f"a {same}"), (2, f"b {same}"))
    assert sorted(r.n_removed for r in suffix_dedup.remove_repeats(docs).collect()) == [0, len(same) + 1]
    assert [f.name for f in tmp_path.iterdir()] == ["repeats-spans"]
