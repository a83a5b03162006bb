"""Mixing to target weights with soft domain membership.

A classifier learned from a labelled table gives each document a posterior over domains. Document rates are
then fitted by projected gradient: nonnegative, and such that the expected tokens of each domain, the sum of
rate * tokens * posterior, match the target weights.

The classifier is a table of terms: a term is a word of the text or one of a few bucketed measures of it, and
the table holds how often documents of each domain contain the term (Bernoulli naive Bayes). The first domain
is the background; each other domain contributes the terms that set it off most, ``TERMS`` at most. Terms that
are merely rarer in it are not used: they follow from the length of texts. The table is estimated on a bounded
sample of labelled documents, ``SAMPLE`` per domain.

Posteriors are kept in hundredths, so documents fall into at most ``cells(domains)`` different ones, and the
gradient runs on token sums per cell. An iterate is determined by the residuals so far: the rate of a document
is a nested expression of its posterior, so neither the iterations nor the final rates need a join.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import let, once
from sluiceway.session import hand_over

SAMPLE, TERMS, GRID = 4000, 64, 100
#: Least gain p * log(p / background) of a term, in nats.
LEAST_GAIN = 0.03
#: Labelled documents of its domain that a term must occur in; fewer are chance.
LEAST_SEEN = 5
#: Times a term must be more frequent in its domain than in the background. Words that are merely a little
#: more frequent, such as those of a language, come together, and naive Bayes would count them many times.
LEAST_LIFT = 5.0
ITERATIONS, TOLERANCE = 24, 1e-3

#: Target shares of tokens by domain in production; the first domain is the background.
WEIGHTS = {"good": 0.96, "poor": 0.04, "toxic": 0.0}


def label_domains(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, domain`` from quality and toxicity labels; toxic wins, then poor. Unlabelled rows are left out."""
    seen = labels.where(F.col(key).isNotNull() & F.coalesce("quality", "toxic").isNotNull())
    once = seen.groupBy(key).agg(F.max("toxic").alias("_toxic"), F.min("quality").alias("_quality"))
    domain = F.when(F.col("_toxic") == 1, "toxic").when(F.col("_quality") == 0, "poor").otherwise("good")
    return once.select(key, domain.alias("domain"))


def cells(domains: int) -> int:
    """How many different posteriors in hundredths there are: the bound on the rows of the gradient."""
    return math.comb(GRID + domains - 1, domains - 1)


def _share(part: Column, of: Column, steps: int) -> Column:
    return F.least(F.floor(steps * part / F.greatest(of, F.lit(1))), F.lit(steps)).cast("string")


def _described(text: Column) -> Column:
    """Struct ``n_tokens, terms`` of a text; terms are distinct. A null or empty text has no words."""
    body = F.coalesce(text, F.lit(""))
    count = lambda kind: F.length(F.regexp_replace(body, f"[^{kind}]+", ""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.length(line) > 0)

    def terms(ws: Column) -> Column:
        n = F.size(ws)
        known = F.array_distinct(ws)
        of_lines = let(lines, lambda ls: _share(F.size(ls) - F.size(F.array_distinct(ls)), F.size(ls), 4))
        measures = F.array(
            F.concat(F.lit("symbols:"), _share(count("#*$%&|<>"), n, 8)),
            F.concat(F.lit("marks:"), _share(count("!"), n, 4)),
            F.concat(F.lit("capitals:"), _share(count("A-Z"), F.length(body), 5)),
            F.concat(F.lit("lines:"), of_lines),
            F.concat(F.lit("doubled:"), _share(F.size(F.filter(ws, lambda w, i: w == F.get(ws, i - 1))), n, 16)),
            F.concat(
                F.lit("variety:"),
                F.least(F.floor(F.log2(n + 1)), F.lit(9)).cast("string"),
                F.lit(":"),
                _share(F.size(known), n, 10),
            ),
        )
        return F.struct(n.cast("long").alias("n_tokens"), F.concat(measures, known).alias("terms"))

    return let(F.array_remove(F.split(F.lower(body), r"[^\p{L}\p{N}]+"), ""), terms)


def fit_terms(
    docs: DataFrame,
    labelled: DataFrame,
    domains: list[str],
    sample: int = SAMPLE,
    n_terms: int = TERMS,
    key: str = "doc_id",
    text: str = "text",
) -> tuple[dict[str, float], list[tuple[str, list[float]]]]:
    """(log score of each domain without any term, [(term, score added by it for each domain)]).

    Up to ``sample`` documents of each domain, those with the least hash of their key, are described; the
    priors come from all labelled rows. Only the chosen terms reach the driver.
    """
    labelled = labelled.where(F.col("domain").isin(domains))
    priors = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not priors:
        return {d: 0.0 if i == 0 else -1e6 for i, d in enumerate(domains)}, []
    picks = functools.reduce(
        DataFrame.unionByName,
        [
            labelled.where(F.col("domain") == d).orderBy(F.xxhash64(key), key).limit(sample).select(key, "domain")
            for d in domains
        ],
    )
    described = hand_over(
        docs.select(key, F.col(text).alias("_text"))
        .join(F.broadcast(picks), key)  # at most `sample` short rows per domain
        .select("domain", _described(F.col("_text"))["terms"].alias("terms")),
        "mixing-sample",
    )
    sizes = {r["domain"]: r["n"] for r in described.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = [sizes.get(d, 0) for d in domains]
    counts = hand_over(
        described.select("domain", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(*[F.count_if(F.col("domain") == d).alias(f"n_{i}") for i, d in enumerate(domains)]),
        "mixing-terms",
    )
    share = lambda i: (F.col(f"n_{i}") + 0.5) / (n[i] + 1)
    gain = lambda i: share(i) * F.log(share(i) / share(0))
    gained = counts.withColumns({f"_g{i}": gain(i) for i in range(1, len(domains))})
    chosen = {}
    for i in range(1, len(domains)):
        telling = (F.col(f"_g{i}") >= LEAST_GAIN) & (F.col(f"n_{i}") >= LEAST_SEEN) & (share(i) >= LEAST_LIFT * share(0))
        top = gained.where(telling).orderBy(F.desc(f"_g{i}"), "term").limit(n_terms)
        chosen |= {r["term"]: r for r in top.collect()}
    total = sum(priors.values())
    base = {d: math.log((priors.get(d, 0) + 0.5) / (total + len(domains))) for d in domains}
    table = []
    for r in chosen.values():
        p = [(r[f"n_{i}"] + 0.5) / (n[i] + 1) for i in range(len(domains))]
        for d, q in zip(domains, p):
            base[d] += math.log(1 - q)
        table.append((r["term"], [math.log(q / (1 - q)) for q in p]))
    return base, table


def posteriors(
    docs: DataFrame, base: Mapping[str, float], table: list[tuple[str, list[float]]], domains: list[str], text: str = "_text"
) -> DataFrame:
    """Add ``n_tokens`` and ``p_0, p_1, ...``: the posterior of each domain in hundredths; they add up to 100."""
    lexicon = F.array(*[F.lit(t) for t, _ in table]) if table else F.array().cast("array<string>")
    scores = [F.array(*[F.lit(s[i]) for _, s in table]) if table else F.array().cast("array<double>") for i in range(len(domains))]
    described = docs.withColumn("_d", _described(F.col(text)))
    found = F.transform(F.array_intersect("_d.terms", lexicon), lambda t: F.array_position(lexicon, t).cast("int") - 1)
    placed = described.select("*", F.col("_d.n_tokens").alias("n_tokens"), found.alias("_found")).drop("_d")

    def log(domain: str, added: Column) -> Column:
        return F.aggregate("_found", F.lit(base[domain]), lambda a, i: a + F.get(added, i))

    logs = [log(d, s) for d, s in zip(domains, scores)]
    scored = placed.withColumns({f"_s{i}": c for i, c in enumerate(logs)})
    names = [F.col(f"_s{i}") for i in range(len(domains))]
    top = F.greatest(*names) if len(names) > 1 else names[0]
    weights = scored.withColumns({f"_e{i}": F.exp(c - top) for i, c in enumerate(names)}).withColumn("_top", top)
    total = functools.reduce(Column.__add__, [F.col(f"_e{i}") for i in range(len(domains))])
    floors = [F.floor(GRID * F.col(f"_e{i}") / total).cast("int") for i in range(len(domains))]
    rest = F.lit(GRID) - functools.reduce(Column.__add__, floors)
    first_top = [
        (F.col(f"_s{i}") == F.col("_top"))
        & ~functools.reduce(Column.__or__, [F.lit(False)] + [F.col(f"_s{j}") == F.col("_top") for j in range(i)])
        for i in range(len(domains))
    ]
    out = weights.withColumns(
        {f"p_{i}": f + F.when(t, rest).otherwise(0) for i, (f, t) in enumerate(zip(floors, first_top))}
    )
    return once(out).drop("_found", "_top", *[f"_{x}{i}" for x in "se" for i in range(len(domains))])


def fit_rates(found: DataFrame, domains: list[str], weights: Mapping[str, float]) -> tuple[Column, dict[str, float]]:
    """The rate of a row with ``p_*`` as an expression, and the expected share of tokens of each domain.

    The first domain, the background, is taken whole; it sets the size of the result. The others get their
    weight relative to it, or all they have if that is less, since documents are not repeated. The residual of
    a domain is measured against its present tokens, which keeps the steps well scaled for rare domains. The
    steps end when no total moves by more than TOLERANCE of the domain's own tokens any more, however rare it is.
    """
    names = [f"p_{i}" for i in range(len(domains))]
    table = hand_over(found.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "mixing-cells")
    part = [F.col(n) / GRID for n in names]
    sums = lambda rate: [F.coalesce(F.sum(rate * F.col("tokens") * p), F.lit(0.0)) for p in part]
    have = list(table.agg(*sums(F.lit(1.0))).first())
    first = weights[domains[0]]
    if not (first and have[0]):
        return F.lit(1.0), {d: h / max(sum(have), 1e-9) for d, h in zip(domains, have)}
    target = [min(weights[d] / first * have[0], h) for d, h in zip(domains, have)]
    present = [i for i in range(len(domains)) if have[i] > 0]
    # The steps converge below 2 / the largest eigenvalue of the scaled membership products, bounded by a row sum.
    products = table.agg(*[F.sum(F.col("tokens") * part[i] * part[j]) for i in present for j in present]).first()
    rows = [products[k * len(present) : (k + 1) * len(present)] for k in range(len(present))]
    step = 1 / max(sum(v / math.sqrt(have[i] * have[j]) for v, j in zip(row, present)) for row, i in zip(rows, present))
    rate, got, before = F.lit(1.0), have, None
    for _ in range(ITERATIONS):
        if before and all(abs(g - b) <= TOLERANCE * h for g, b, h in zip(got, before, have)):
            break
        off = [(g - t) / h if h > 0 else 0.0 for g, t, h in zip(got, target, have)]
        change = functools.reduce(Column.__add__, [F.lit(step * o) * p for o, p in zip(off, part)])
        rate = F.greatest(F.lit(0.0), rate - change)
        before, got = got, list(table.agg(*sums(rate)).first())
    # Shares do not change with a common factor. If no rate reaches 1, the largest becomes 1; and what is left of
    # the tolerance must not cost documents of the background.
    top = table.agg(F.max(rate)).first()[0]
    factor = (1 + 5 * TOLERANCE) / min(1.0, top or 1.0)
    return rate * F.lit(factor), {d: g / max(sum(got), 1e-9) for d, g in zip(domains, got)}


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    key: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    seed: int = 11,
) -> DataFrame:
    """``key, <carry>, n_tokens, p_<domain>..., rate, chosen`` of every row.

    ``labelled`` holds ``key`` and ``domain``; ``weights`` name the domains and their target shares of tokens.
    Tokens are words of letters and digits. A row is chosen with a chance equal to its rate, decided by a hash
    of key, text and seed, so equal rows share their fate and a repeated run decides alike. Rows with a rate
    of 1 or more are always chosen, once. Null and empty texts have no tokens and are judged by their measures. Without any
    labelled document every row belongs to the first domain. An empty table gives no rows.
    """
    domains = list(weights)
    own = {c: f"_in_{i}" for i, c in enumerate(dict.fromkeys([key, *carry]))}
    base, terms = fit_terms(docs, labelled.where(F.col(key).isNotNull()), domains, key=key, text=text)
    taken = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in own.items()],
        F.col(f"`{text}`").alias("_text"),
        F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"), F.lit(seed)).alias("_draw"),
    )
    found = posteriors(taken, base, terms, domains).drop("_text")
    if not carry:
        found = hand_over(found, "mixing-posteriors")
        cells_of = found
    else:  # whole rows are not written twice; the posteriors are computed once for the rates, once for the rows
        cells_of = found.select("n_tokens", *[f"p_{i}" for i in range(len(domains))])
    rate, _ = fit_rates(cells_of, domains, weights)
    chance = (F.shiftrightunsigned("_draw", 11) / F.lit(float(1 << 53))).cast("double")
    rated = found.withColumn("rate", rate)
    return rated.select(
        *[F.col(n).alias(c) for c, n in own.items()],
        "n_tokens",
        *[(F.col(f"p_{i}") / GRID).alias(f"p_{d}") for i, d in enumerate(domains)],
        "rate",
        ((chance < F.col("rate")) & (F.col("_once") >= 0)).alias("chosen"),
    )
