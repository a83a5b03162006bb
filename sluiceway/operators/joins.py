"""Join shapes: enrichment chains, families of tables, and membership in a key or word table.

No side is forced into a broadcast. Spark broadcasts a side whose size it knows to be below
``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles both and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chain_left(base: DataFrame, others: Sequence[DataFrame], on: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Left-join several tables on the same keys.

    Columns in ``drop`` are removed from the other tables before the join. All joins share the shuffle of
    the base. A key that repeats in another table repeats the base row.
    """
    for other in others:
        base = base.join(other.drop(*[c for c in drop if c not in on]), on=list(on), how="left")
    return base


def union_families(families: dict[int, DataFrame], name: str = "type") -> DataFrame:
    """Stack tables of the same columns, each marked with its family number."""
    stacked = None
    for number, df in families.items():
        marked = df.withColumn(name, F.lit(number).cast("int"))
        stacked = marked if stacked is None else stacked.unionByName(marked)
    return stacked


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in another table."""
    return df.join(keys.select(*on).distinct(), on=list(on), how="left_semi")


def drop_words(df: DataFrame, column: str, words: DataFrame, word: str = "word") -> DataFrame:
    """Rows whose text, lower-cased, is not in a word table."""
    listed = words.select(F.lower(word).alias("_word")).distinct()
    return df.join(listed, F.lower(df[column]) == listed["_word"], "left_anti")
