"""Word counts over text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import tokens
from sluiceway.operators.joins import drop_words

# Fixed value: words written in Cyrillic letters only.
CYRILLIC = "[А-ЯЁа-яё]+"


def words(df: DataFrame, text: Column | str, pattern: str = CYRILLIC) -> DataFrame:
    """One row per blank-separated word that matches the pattern as a whole."""
    text = F.col(text) if isinstance(text, str) else text
    return df.select(F.explode(tokens(text)).alias("word")).where(F.col("word").rlike(f"^(?:{pattern})$"))


def word_count(
    df: DataFrame, text: Column | str, stop_words: DataFrame | None = None, pattern: str = CYRILLIC
) -> DataFrame:
    """Occurrences per word, without the stop words.

    Words are counted first, so stop words are removed from the vocabulary and not from the token stream,
    and a frequent word reaches the join as one row.
    """
    counts = words(df, text, pattern).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts if stop_words is None else drop_words(counts, "word", stop_words)
