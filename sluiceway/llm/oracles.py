"""The queries as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from sluiceway.llm import quality_rules

#: Fixed value: what words consist of.
WORD = r"[^\x20\x09-\x0D]+"


def op1_sql() -> str:
    """Measures by counting over unnested words and lines; cutoffs by the binomial sum with lgamma."""
    rules = quality_rules.RULES
    limit = quality_rules.RISK / len(rules)
    grid = ", ".join(f"('{r.name}', {i}, {c})" for r in rules for i, c in enumerate(r.cutoffs))
    numerator = "CASE rule " + " ".join(f"WHEN '{r.name}' THEN {r.numerator}" for r in rules) + " END"
    denominator = "CASE rule " + " ".join(f"WHEN '{r.name}' THEN {r.denominator}" for r in rules) + " END"
    order = "CASE rule " + " ".join(f"WHEN '{r.name}' THEN {i}" for i, r in enumerate(rules)) + " END"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS text FROM documents),
words AS (SELECT row_id, regexp_extract_all(text, '{WORD}') AS ws FROM docs),
windows AS (
  SELECT row_id, unnest(range(1, len(ws) - 1)) AS p,
         unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) AS w FROM words WHERE len(ws) > 2),
starts AS (SELECT row_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, w) > 1),
repeated AS (SELECT row_id, count(DISTINCT p + o) AS n FROM starts, (VALUES (0), (1), (2)) AS offsets(o) GROUP BY row_id),
lines AS (
  SELECT row_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM docs),
measured AS (
  SELECT row_id, doc_id, lang, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^!]+', '', 'g'))::BIGINT AS n_marks
  FROM docs JOIN words USING (row_id) JOIN lines USING (row_id) LEFT JOIN repeated USING (row_id)),
judged AS (
  SELECT *, n_words < {quality_rules.BASE_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
grid(rule, step, cutoff) AS (VALUES {grid}),
counted AS (
  SELECT lang, rule, step, cutoff, count(*) AS n, count(*) FILTER (WHERE {numerator} > cutoff * {denominator}) AS k
  FROM judged, grid WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k > n * {limit} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({limit}) + (n - i) * ln(1 - {limit})))) END
    <= {quality_rules.DELTA} / ((SELECT count(DISTINCT coalesce(lang, '')) FROM counted) * {len(rules)}) AS ok FROM counted),
passed AS (
  SELECT * FROM tested QUALIFY sum((NOT ok)::INT) OVER (PARTITION BY lang, rule ORDER BY step) = 0),
cutoffs AS (SELECT lang, rule, arg_max(cutoff, step) AS cutoff FROM passed GROUP BY ALL),
failing AS (
  SELECT row_id, arg_min(rule, {order}) AS rule_failed
  FROM judged JOIN cutoffs ON judged.lang IS NOT DISTINCT FROM cutoffs.lang
  WHERE {numerator} > cutoff * {denominator} GROUP BY row_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rule_failed IS NULL AS kept, rule_failed
FROM judged LEFT JOIN failing USING (row_id)
"""


def op6_sql() -> str:
    """All windows of 13 words with the least document that each starts in; removed words by position."""
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
windows AS (
  SELECT row_id, doc_id, unnest(range(1, len(ws) - 11)) AS p,
         unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS w
  FROM docs WHERE len(ws) >= 13),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
hit AS (SELECT row_id, p FROM windows JOIN firsts USING (w) WHERE first < doc_id),
gone AS (SELECT DISTINCT row_id, unnest(range(p, p + 13)) AS i FROM hit),
placed AS (SELECT row_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM docs),
kept AS (SELECT row_id, string_agg(word, ' ' ORDER BY i) AS t FROM placed ANTI JOIN gone USING (row_id, i) GROUP BY row_id),
counted AS (SELECT row_id, count(*) AS n FROM gone GROUP BY row_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_id) LEFT JOIN counted USING (row_id)
"""


def op10_sql() -> str:
    """All strings of 50 bytes, in hexadecimal digits, with the least document that each starts in; removed bytes by position."""
    return """
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, len(h) // 2 AS n FROM docs),
windows AS (SELECT row_id, doc_id, p, substr(h, 2 * p - 1, 100) AS w
            FROM (SELECT *, unnest(range(1, n - 48)) AS p FROM sized WHERE n >= 50)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
hit AS (SELECT row_id, p FROM windows JOIN firsts USING (w) WHERE first < doc_id),
gone AS (SELECT DISTINCT row_id, unnest(range(p, p + 50)) AS i FROM hit),
counted AS (
  SELECT row_id, count(*) AS removed, count(*) FILTER (before IS NULL OR before < i - 1) AS spans
  FROM (SELECT *, lag(i) OVER (PARTITION BY row_id ORDER BY i) AS before FROM gone) GROUP BY row_id),
placed AS (SELECT row_id, h, unnest(range(1, n + 1)) AS i FROM sized JOIN counted USING (row_id)),
kept AS (SELECT row_id, string_agg(substr(h, 2 * i - 1, 2), '' ORDER BY i) AS t FROM placed ANTI JOIN gone USING (row_id, i) GROUP BY row_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN removed IS NULL THEN h ELSE coalesce(t, '') END)) AS kept_sha256
FROM sized LEFT JOIN counted USING (row_id) LEFT JOIN kept USING (row_id)
"""


def op8_sql() -> str:
    """Windows joined by their word lists."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce({words}, []) AS ws FROM documents),
items AS (SELECT item_id, {words} AS ws FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT *, least(13, len(ws)) AS size FROM items WHERE len(ws) > 0),
phrases AS (
  SELECT DISTINCT item_id, size, w FROM (
    SELECT item_id, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: ws[i:i + size - 1])) AS w FROM sized)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
  SELECT row_id, size, unnest(range(1, len(ws) - size + 2)) AS p,
         unnest(list_transform(range(1, len(ws) - size + 2), lambda i: ws[i:i + size - 1])) AS w
  FROM docs, sizes WHERE len(ws) >= size),
found AS (SELECT row_id, p, size, item_id FROM windows JOIN phrases USING (size, w)),
hits AS (SELECT row_id, count(DISTINCT i) AS n_hit FROM (SELECT row_id, unnest(range(p, p + size)) AS i FROM found) GROUP BY 1),
of_items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT row_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN hits USING (row_id) LEFT JOIN of_items USING (row_id)
"""


def op11_sql() -> str:
    """Term counts of all documents joined with the terms of the items."""
    terms = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce({terms}, []) AS ts FROM documents),
items AS (SELECT row_number() OVER () AS item, item_id, list_distinct({terms}) AS ts FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT item, item_id, unnest(ts) AS t FROM items),
totals AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM docs),
counts AS (
  SELECT row_id, t, count(*) AS tf FROM (SELECT row_id, unnest(ts) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY t),
scored AS (
  SELECT item, any_value(item_id) AS item_id, row_id, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(ts) * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN counts USING (t) JOIN weights USING (t) JOIN docs USING (row_id), totals
  WHERE doc_id IS NOT NULL GROUP BY item, row_id)
SELECT item_id, row_number() OVER w AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW w AS (PARTITION BY item ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 50
"""


def op13_sql() -> str:
    """All anchors against all rows, ranked twice."""
    return """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM rows_ a, rows_ b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""
