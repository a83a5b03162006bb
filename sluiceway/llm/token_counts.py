"""Token counts with a whole-token shortcut.

A text falls into pre-tokens: runs of the space mark with what follows up to the next one. No vocabulary
string holds the mark after another character, so no merge crosses such a border and the counts of the
pre-tokens add up; ``prove`` checks that property of the vocabulary and lists the strings that, as a
pre-token with one mark, encode alone as exactly one token. Texts are then counted by looking their
pre-tokens up, and only the rest goes through the merging library.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import bytes_of, steps
from sluiceway.llm.piece_merging import fields

#: Fixed value: the character that stands for a space in the vocabulary.
MARK = "▁"
#: Rest words whose counts a worker remembers.
REMEMBERED = 200_000


def normaliser(model: bytes) -> dict[str, object]:
    """What a model does to a text before it cuts it: the settings of its file, with their defaults."""
    spec = dict(fields(next((value for number, value in fields(model) if number == 3), b"")))
    return {
        "character map": bytes(spec.get(2, b"")),
        "mark before the text": bool(spec.get(3, 1)),
        "fewer spaces": bool(spec.get(4, 1)),
        "marks for spaces": bool(spec.get(5, 1)),
    }


#: The settings under which only spaces change, to marks, with one mark before the text.
NO_CHANGE = {"character map": b"", "mark before the text": True, "fewer spaces": False, "marks for spaces": True}


def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def prove(model) -> frozenset[str]:
    """Vocabulary strings w such that the pre-token "mark + w" is one token by itself.

    Raises ValueError for a vocabulary in which merges could cross the border before a mark, or whose
    normalisation changes more than spaces: the shortcut would not be exact there.
    """
    strings = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    usual = [
        s
        for i, s in enumerate(strings)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    if any(re.search(f"[^{MARK}]{MARK}", s) for s in usual):
        raise ValueError("a vocabulary string holds a space mark after another character")
    if normaliser(model.serialized_model_proto()) != NO_CHANGE:
        raise ValueError("the model normalises texts")
    words = [s[1:] for s in usual if s.startswith(MARK) and len(s) > 1 and MARK not in s[1:]]
    return frozenset(w for w, ids in zip(words, model.encode(words)) if len(ids) == 1)


@functools.lru_cache(maxsize=4)
def _counter(path: str):
    """One counter for each worker process and model; the proof is made once, before the first text."""
    model = processor(path)
    return model, prove(model), {}


def count(text: str, path: str) -> int:
    """Tokens of one text."""
    if not text:
        return 0
    model, whole, known = _counter(path)
    parts = text.replace(MARK, " ").split(" ")
    total, rest, gap = 0, [], 1  # gap: marks before the part; the library puts one before the text
    for part in parts:
        if not part:
            gap += 1
            continue
        if gap == 1 and part in whole:
            total += 1
        else:
            key = part if gap == 1 else " " * (gap - 1) + part
            n = known.get(key)
            if n is None:
                rest.append(key)
            else:
                total += n
        gap = 1
    marks = gap - 1  # at the end of the text, with no word after them
    if marks:
        total += len(model.encode(" " * (marks - 1))) if marks > 1 else 1
    if rest:
        distinct = list(dict.fromkeys(rest))
        counts = dict(zip(distinct, map(len, model.encode(distinct, num_threads=1))))
        total += sum(map(counts.__getitem__, rest))
        if len(known) < REMEMBERED:
            known.update((k, n) for k, n in counts.items() if len(k) < 64)
    return total


def _counted(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "_bytes"):
            texts = batch.column(batch.schema.get_field_index("_bytes"))
            sizes = pa.array([len(t) for t in texts.to_pylist()], pa.int64())
            tokens = [count(t.decode(), path) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens])],
                names=["key", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every whole text, without begin, end or other added tokens.

    Null and empty texts have no bytes and no tokens. Special strings inside a text are ordinary text, as the
    library treats them. Each row is counted on its own, so keys may be null or repeat; other columns are
    ignored. ``model_path`` must be readable on the executors; each worker loads it once. Nothing is shuffled.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()
    taken = docs.select(F.col(key).alias("key"), bytes_of(text).alias("_bytes"))
    counted = taken.mapInArrow(
        _counted(model_path, limit), f"key {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return counted.withColumnRenamed("key", key)
