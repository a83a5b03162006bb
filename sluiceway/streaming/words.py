"""Running word count of a message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.joins import drop_words
from sluiceway.operators.words import CYRILLIC, words
from sluiceway.streaming import batches
from sluiceway.streaming.generations import Generations


def batch_size(sink: batches.BatchFunction) -> batches.BatchFunction:
    """The number of messages of each micro-batch, as a one-row frame."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch.agg(F.count(F.lit(1)).alias("messages")), batch_id)

    return write


def start_word_count(
    messages: DataFrame,
    text: str,
    stop_words: DataFrame | None,
    sink: batches.BatchFunction,
    checkpoint: str,
    pattern: str = CYRILLIC,
    interval: str | None = "5 seconds",
) -> StreamingQuery:
    """Counts since the start, most frequent word first, after every micro-batch.

    The state holds the whole vocabulary; stop words leave when the counts are written.
    """
    counts = words(messages, text, pattern).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def write(totals: DataFrame, batch_id: int) -> None:
        kept = totals if stop_words is None else drop_words(totals, "word", stop_words)
        sink(kept.orderBy(F.desc("n"), "word"), batch_id)

    return batches.start(counts, checkpoint, write, "complete", interval)


def count_store(spark: SparkSession, path: str, fan: int = 8) -> Generations:
    """The running count of every word: of several, the largest, since counts only grow."""
    return Generations(spark, path, "word string, n bigint", lambda rows: rows.groupBy("word").agg(F.max("n").alias("n")), fan=fan)


def keep_word_counts(
    messages: DataFrame, text: str, path: str, checkpoint: str, pattern: str = CYRILLIC, interval: str | None = "5 seconds", fan: int = 8
) -> StreamingQuery:
    """Keep the counts since the start in ``path``; a batch writes the counts that it has changed and sorts nothing."""
    counts = words(messages, text, pattern).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def write(changed: DataFrame, batch_id: int) -> None:
        count_store(changed.sparkSession, path, fan).append(changed.select("word", "n"), batch_id)

    return batches.start(counts, checkpoint, write, "update", interval)


def read_word_counts(spark: SparkSession, path: str, stop_words: DataFrame | None = None) -> DataFrame:
    """The counts that ``keep_word_counts`` keeps, most frequent word first."""
    counts = count_store(spark, path).read()
    return (counts if stop_words is None else drop_words(counts, "word", stop_words)).orderBy(F.desc("n"), "word")
