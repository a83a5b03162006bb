"""A corpus pipeline of five of the operators, stage by stage through Parquet.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All stages but the
last return the columns of ``documents``; the last adds where each document goes. ``run`` applies the stages
to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import decontamination, mixing, near_copies, quality_rules, sharding
from sluiceway.plans.registry import table
from sluiceway.session import hand_over

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified rules keep."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the least id.

    Texts link if op2's SimHash links them, or if they share 0.8 of their five-word shingles.
    """
    return near_copies.keep_first(docs, shingle=5, similarity=0.8, fingerprinted=True).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; the others go whole."""
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontamination.find_passages(docs, benchmark, carry=tuple(COLUMNS))
    return found.where(~found["contaminated"]).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of the documents at the fitted rates, so that the domains have their target shares of tokens."""
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    mixed = mixing.mix(docs, labelled, carry=tuple(COLUMNS))
    return mixed.where("chosen").select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Size, checksum, shard and slot of every remaining document."""
    return sharding.assign(docs, shards=16)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

#: SQL cannot express fingerprints, fitted rates and packing; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = hand_over(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
