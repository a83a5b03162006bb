"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import (
    decontamination,
    hard_negatives,
    lexical_search,
    mixing,
    piece_merging,
    pseudonyms,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
)
from sluiceway.llm import token_counts as counting
from sluiceway.llm.oracles import op1_sql, op6_sql, op8_sql, op10_sql, op11_sql, op13_sql
from sluiceway.plans.registry import Query, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; cutoffs certified per language."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule_failed"
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text under the 32k piece vocabulary."""
    import public_tokenizers

    return counting.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; shards have nearly equal bytes and keep equal texts together."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, rate and decision of every document."""
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), labelled)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside passages of 13 words that a smaller document holds."""
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    space = quality_classifier.fit(*quality_classifier.labelled_sample(docs, labels))
    scored = quality_classifier.scores(docs, space)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside passages of the benchmark, and the items found."""
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        "contaminated",
    )


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced. The key of a real run comes from a secret store."""
    replaced = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), secret="key of the test tables")
    return replaced.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_replaced"), F.array_join("pii_kinds", ",").alias("kinds"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document outside strings of 50 bytes that a smaller document holds."""
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", F.col("n_units").alias("n_bytes"), "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_piece_merging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text under the 32k piece vocabulary, and the text that they decode to."""
    import public_tokenizers

    done = piece_merging.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50; some labels are shifted first."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", shifted), F.col("key") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_quality_rules": Query(op1_quality_rules, op1_sql()),
    "op2_simhash": Query(op2_simhash, None),
    "op3_token_counts": Query(op3_token_counts, None),
    "op4_sharding": Query(op4_sharding, None),
    "op5_mixing": Query(op5_mixing, None),
    "op6_substring_dedup": Query(op6_substring_dedup, op6_sql()),
    "op7_quality_classifier": Query(op7_quality_classifier, None),
    "op8_decontamination": Query(op8_decontamination, op8_sql()),
    "op9_pseudonyms": Query(op9_pseudonyms, None),
    "op10_suffix_dedup": Query(op10_suffix_dedup, op10_sql()),
    "op11_lexical_search": Query(op11_lexical_search, op11_sql()),
    "op12_piece_merging": Query(op12_piece_merging, None),
    "op13_hard_negatives": Query(op13_hard_negatives, op13_sql()),
}
