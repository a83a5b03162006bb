"""Benchmark decontamination with an FM-index per shard of the training documents.

Benchmark items become test phrases: every window of ``width`` words, or the whole item if it is shorter.
The phrases are put into blocks of bounded size; a block is broadcast. Each task indexes its documents shard
by shard (a few MB of text), finds every phrase by backward search, locates its occurrences through sampled
suffix positions, and merges them into spans.

A shard's index holds the runs of words that occur in the block's phrases, at least as long as the shortest
phrase; other words end a run. No occurrence lies outside such runs, so nothing is missed.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import bytes_of, steps
from sluiceway.llm.fm_index import FMIndex
from sluiceway.session import hand_over

WIDTH = 13
#: Benchmark text in one block, in bytes.
BLOCK_BYTES = 8 << 20

#: Fixed value: word characters are a-z after lower-casing A-Z, digits, and everything beyond ASCII.
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Phrases:
    """The test phrases of one block: their words as numbers from 2, and the items each phrase belongs to."""

    def __init__(self, items: list[tuple[int | None, bytes]], width: int):
        owners: dict[tuple[bytes, ...], set] = {}
        for item, text in items:
            ws = words_of(text)
            size = min(width, len(ws))
            for at in range(len(ws) - size + 1) if size else ():
                owners.setdefault(tuple(ws[at : at + size]), set()).add(item)
        self.words = {w: i for i, w in enumerate(dict.fromkeys(itertools.chain(*owners)), start=2)}
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.patterns = np.zeros((len(owners), width), np.int64)
        for row, phrase in enumerate(owners):
            self.patterns[row, width - len(phrase) :] = [self.words[w] for w in phrase]
        self.items = [sorted(o - {None}) for o in owners.values()]
        self.shortest = int(self.lengths.min()) if len(owners) else 0

    def find(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
        """(word count, merged spans of words, found items) of each text of one shard."""
        counts, runs, pieces, size = [], [], [], 0
        number = self.words.get
        for row, text in enumerate(texts):
            ws = words_of(text)
            counts.append(len(ws))
            if not self.shortest:
                continue
            ids = np.array([number(w, 0) for w in ws], np.int64)
            edges = np.flatnonzero(np.diff(ids > 0, prepend=False, append=False))
            begins, ends = edges[::2], edges[1::2]
            long_enough = ends - begins >= self.shortest
            for begin, end in zip(begins[long_enough], ends[long_enough]):
                runs.append((size, row, begin))
                pieces += [ids[begin:end], [1]]
                size += end - begin + 1
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[int]] = [set() for _ in texts]
        if runs:
            index = FMIndex(np.concatenate(pieces), len(self.words) + 2)
            low, high = index.search(self.patterns, self.lengths)
            found = np.flatnonzero(high > low)
            n = (high - low)[found]
            rows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[found], n)
            phrase = np.repeat(found, n)
            at = index.locate(rows)
            run_start, run_row, run_word = np.array(runs, np.int64).T
            run = np.searchsorted(run_start, at, side="right") - 1
            begin = run_word[run] + at - run_start[run]
            for row, b, p in zip(run_row[run].tolist(), begin.tolist(), phrase.tolist()):
                spans[row].append((b, b + int(self.lengths[p])))
                items[row].update(self.items[p])
        return [(c, merged(s), sorted(i)) for c, s, i in zip(counts, spans, items)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjacent spans as one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


_FOUND = "n_words long, spans array<struct<begin:long,end:long>>, items array<long>"


def _search(df: DataFrame, phrases: Phrases) -> DataFrame:
    """Add the findings of one block to rows with a column ``_bytes``, which is dropped."""
    shared = df.sparkSession.sparkContext.broadcast(phrases)
    carried = [c for c in df.columns if c != "_bytes"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carried).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in steps(batches, "_bytes"):
            columns = dict(zip(batch.schema.names, batch.columns))
            counts, spans, items = zip(*shared.value.find(columns.pop("_bytes").to_pylist()))
            pairs = [[{"begin": b, "end": e} for b, e in s] for s in spans]
            added = [pa.array(counts, pa.int64()), pa.array(pairs, span), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns.values(), *added], names=[*columns, "n_words", "spans", "items"])

    return df.select(*carried, "_bytes").mapInArrow(run, f"{schema}, {_FOUND}")


def blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The benchmark in blocks of about ``block_bytes``; one block is on the driver at a time."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item).cast("long").alias("item"), bytes_of(text).alias("b"))
    total = rows.agg(F.sum(F.octet_length("b"))).first()[0] or 0
    n = total // block_bytes + 1
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "b"), F.lit(n)) == block) if n > 1 else rows
        yield [(r["item"], bytes(r["b"])) for r in part.toLocalIterator()]


def _union_of_spans(spans: Column) -> Column:
    """Merge sorted spans of several blocks."""
    empty = F.array().cast("array<struct<begin:long,end:long>>")
    return F.aggregate(
        F.sort_array(spans),
        empty,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["begin"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["begin"].alias("begin"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    carry: tuple[str, ...] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every document with its contaminated passages.

    Returns ``key, <carry>, n_words, spans, items, n_hit, contaminated``: spans are merged word ranges
    [begin, end), items the distinct ids of the items with an occurrence, contaminated means that a twentieth
    of the words or more is hit. Null or empty texts have no words and are clean; null or empty items have no
    phrases; an item without an id counts for spans only. An empty benchmark leaves every document clean.
    Rows with a null or repeated key are judged each on its own. Carried columns must not have the names of result
    columns; other columns may have any.

    A benchmark that fits one block, the usual case, costs one pass without a shuffle. With more blocks each
    pass writes its findings, and those of a text are put together by (key, digest of the carried row).
    """
    own = {c: f"_in_{i}" for i, c in enumerate(dict.fromkeys([key, *carry]))}
    taken = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()], bytes_of(text).alias("_bytes"))
    parts = blocks(benchmark, item, item_text, block_bytes)
    first = Phrases(next(parts, []), width)
    second = next(parts, None)
    if second is None:
        found = _search(taken, first)
    else:
        passes = []
        carried = taken.columns[:-1]
        for phrases in itertools.chain([first], (Phrases(b, width) for b in itertools.chain([second], parts))):
            marked = taken.withColumn("_row", F.sha2(F.col("_bytes"), 256))
            passes.append(hand_over(_search(marked, phrases), "decontamination-block"))
        together = passes[0]
        for more in passes[1:]:
            together = together.unionByName(more)
        grouped = together.groupBy(*carried, "_row", "n_words").agg(
            _union_of_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / len(passes)).cast("int").alias("_times"),
        )
        found = grouped.withColumn("_again", F.explode(F.sequence(F.lit(1), "_times"))).drop("_again", "_times", "_row")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    named = found.select(*[F.col(n).alias(c) for c, n in own.items()], "n_words", "spans", "items", hit.alias("n_hit"))
    return named.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
