"""Quality rules with certified cutoffs.

Each rule compares a number of a text with a cutoff. A cutoff is used in a stratum only if an exact
binomial test on labelled documents certifies that it rejects few good ones:

* the false rejection rate of a stratum is limited to ``risk``; every rule gets an equal part of it, so
  that the union of the rules stays below the limit;
* for k rejected of n good documents the p-value of "the rate is above the limit" is the binomial
  distribution function at k; a cutoff passes if it is at most the level of its test. This is the same as a
  one-sided exact (Clopper-Pearson) upper bound below the limit;
* the error ``delta`` is divided by the number of (stratum, rule) pairs. Within a pair the cutoffs are
  tested in a fixed order from lenient to strict and the first failure ends the sequence, which needs no
  further correction. The strictest cutoff that passes is used.

The cutoffs are parameters, not fitted, so all labelled documents serve as the holdout. Documents that the base
rules reject are not counted: the limit is on what the certified rules add. Strata without
enough labelled documents certify nothing there, and only the base rules apply.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.common import let, words
from sluiceway.session import hand_over

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]


@dataclass(frozen=True)
class Rule:
    """Reject a document if ``numerator`` > cutoff * ``denominator``; cutoffs run from lenient to strict."""

    name: str
    numerator: str
    denominator: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols", "n_words", (2.0, 1.0, 0.5, 0.25, 0.125)),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", (0.875, 0.75, 0.625, 0.5)),
    Rule("repeated_words", "n_repeat_words", "n_words", (0.5, 0.375, 0.25)),
    Rule("capitals", "n_upper", "word_chars", (0.75, 0.5, 0.375, 0.25)),
    Rule("marks", "n_marks", "n_words", (2.0, 1.0, 0.5, 0.25)),
)
RISK, DELTA, BASE_WORDS = 0.025, 0.05, 50


def _count(text: Column, kind: str) -> Column:
    """Characters of a class in a text."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", "")).cast("long")


def _repeat_words(ws: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are sorted by a 64-bit hash, so equal ones are neighbours: n log n for any text. Two different
    windows of a text of a million words share a hash with a chance below 1e-7.
    """
    hashed = F.slice(
        F.transform(
            ws, lambda w, i: F.struct(F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("p"))
        ),
        1,
        F.greatest(F.size(ws) - 2, F.lit(0)),
    )

    def repeated(sorted_windows: Column) -> Column:
        return F.transform(
            F.filter(
                sorted_windows,
                lambda x, i: F.coalesce(x["h"] == F.get(sorted_windows, i - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(sorted_windows, i + 1)["h"], F.lit(False)),
            ),
            lambda x: x["p"],
        )

    starts = F.sort_array(let(F.sort_array(hashed), repeated))
    step = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
    )
    return step["n"]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of each text as long columns (see MEASURES); null and empty texts give zeros.

    Columns of the input with such a name are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(
        words(F.col(text)),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            _repeat_words(ws).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda ls: F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        ),
    )
    taken = docs.drop("_w", "_l").withColumns({"_w": of_words, "_l": of_lines})
    return taken.withColumns(
        {
            **{c: F.col(f"_w.{c}") for c in ("n_words", "word_chars", "n_repeat_words")},
            **{c: F.col(f"_l.{c}") for c in ("n_lines", "n_dup_lines")},
            "n_symbols": _count(body, "#*$%&|<>"),
            "n_upper": _count(body, "A-Z"),
            "n_marks": _count(body, "!"),
        }
    ).drop("_w", "_l")


def base_failed() -> Column:
    """The fixed base rule: too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_at_most(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, rate), summed over log terms.

    Only meant for k <= n * rate, where the value can be small; beyond, 1.0 is returned, which fails any test.
    """
    odds = math.log(rate / (1 - rate))
    first = n.cast("double") * math.log1p(-rate)
    terms = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("log"), F.exp(first).alias("sum")),
        lambda a, i: let(
            a["log"] + F.log((n - i + 1) / i) + F.lit(odds), lambda t: F.struct(t.alias("log"), (a["sum"] + F.exp(t)).alias("sum"))
        ),
    )
    return F.when(k > n * F.lit(rate), F.lit(1.0)).otherwise(terms["sum"])


def _exceeds(rule: Rule, cutoff: Column) -> Column:
    return F.col(rule.numerator) > cutoff * F.col(rule.denominator)


def certified_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: tuple[Rule, ...] = RULES,
    risk: float = RISK,
    delta: float = DELTA,
    key: str = "doc_id",
    good: str = "quality",
) -> DataFrame:
    """One row per stratum and rule with a certified cutoff: ``stratum, rule, cutoff, n_good, n_rejected``.

    ``labels`` holds ``key`` and ``good`` (1: good). Repeated labels of a key count once, with the largest
    label; null labels and keys are ignored. A null stratum is a stratum of its own.
    """
    limit = risk / len(rules)
    labelled = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(good).alias("_good")).where("_good = 1")
    holdout = (
        measured.where(~base_failed())
        .select(key, F.col(stratum).alias("stratum"), *MEASURES)
        .join(labelled.select(key), key, "left_semi")
    )
    counts = holdout.groupBy("stratum").agg(
        F.count("*").alias("n_good"),
        *[
            F.count_if(_exceeds(r, F.lit(c))).alias(f"{r.name}_{i}")
            for r in rules
            for i, c in enumerate(r.cutoffs)
        ],
    )
    tests = counts.withColumn("n_strata", F.count("*").over(Window.partitionBy())).select(
        "stratum",
        "n_strata",
        "n_good",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(r.name).alias("rule"),
                        F.lit(i).alias("step"),
                        F.lit(c).alias("cutoff"),
                        F.col(f"{r.name}_{i}").alias("n_rejected"),
                    )
                    for r in rules
                    for i, c in enumerate(r.cutoffs)
                ]
            )
        ),
    )
    # A handful of rows per stratum from here on.
    sequence = Window.partitionBy("stratum", "rule").orderBy("step")
    passed = (
        tests.withColumn("p", binomial_at_most(F.col("n_rejected"), F.col("n_good"), limit))
        .withColumn("ok", F.col("p") <= F.lit(delta) / (F.col("n_strata") * len(rules)))
        .withColumn("failed", F.sum((~F.col("ok")).cast("int")).over(sequence))
        .where("failed = 0")
    )
    return passed.groupBy("stratum", "rule").agg(
        F.max_by("cutoff", "step").alias("cutoff"),
        F.max("n_good").alias("n_good"),
        F.max_by("n_rejected", "step").alias("n_rejected"),
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: tuple[Rule, ...] = RULES,
    risk: float = RISK,
    delta: float = DELTA,
    key: str = "doc_id",
    text: str = "text",
    good: str = "quality",
) -> DataFrame:
    """Measures and verdict of every document: ``key, stratum, <measures>, base_failed, rule_failed, kept``.

    ``rule_failed`` names the first rule that rejects the document, or is null. Null and empty texts have no
    words and fail the base rule. Rows with a null or repeated key are judged each on its own. Other columns
    of the inputs are ignored. The measures are written to the shared folder, because the cutoffs and the
    verdicts both read them.
    """
    measured = hand_over(
        measures(docs.select(key, F.col(stratum).alias("_stratum"), F.col(text).alias("_text")), "_text").drop("_text"),
        "quality-measures",
    ).withColumnRenamed("_stratum", stratum)
    cutoffs = certified_cutoffs(measured, labels, stratum, rules, risk, delta, key, good)
    return with_verdict(measured, cutoffs, stratum, rules).select(
        key, stratum, *MEASURES, "base_failed", "rule_failed", "kept"
    )


def with_verdict(measured: DataFrame, cutoffs: DataFrame, stratum: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``base_failed, rule_failed, kept`` to rows that hold the measures."""
    wide = cutoffs.groupBy("stratum").pivot("rule", [r.name for r in rules]).agg(F.first("cutoff"))
    # Cutoffs are one row per stratum; Spark sees the size of the aggregate and broadcasts it by itself if small.
    joined = measured.join(
        wide.select(F.col("stratum").alias("_of"), *[F.col(r.name).alias(f"_{r.name}") for r in rules]),
        F.col(stratum).eqNullSafe(F.col("_of")),
        "left",
    )
    failing = F.coalesce(
        *[F.when(_exceeds(r, F.col(f"_{r.name}")), F.lit(r.name)) for r in rules], F.lit(None).cast("string")
    )
    return (
        joined.withColumns({"base_failed": base_failed(), "rule_failed": failing})
        .withColumn("kept", ~F.col("base_failed") & F.col("rule_failed").isNull())
        .drop("_of", *[f"_{r.name}" for r in rules])
    )


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """The documents that base rules and certified rules keep, with all their columns.

    Measured rows go through the shared folder with their columns, about the size of the input: cutoffs need
    the numbers of all labelled documents before the first verdict. No text is shuffled.
    """
    own = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    key, text, good = options.get("key", "doc_id"), options.get("text", "text"), options.get("good", "quality")
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()])
    measured = hand_over(measures(given, own[text]), "quality-measures")
    settings = {k: v for k, v in options.items() if k in ("rules", "risk", "delta")}
    known = labels.select(F.col(key).alias(own[key]), good)
    numbers = measured.select(own[key], own[stratum], *MEASURES)
    cutoffs = certified_cutoffs(numbers, known, own[stratum], key=own[key], good=good, **settings)
    kept = with_verdict(measured, cutoffs, own[stratum], options.get("rules", RULES)).where("kept")
    return kept.select(*[F.col(n).alias(c) for c, n in own.items()])
