"""Quality rules: measures by brute force, the binomial test, cutoffs and verdicts."""

import collections
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    seen = collections.Counter(zip(ws, ws[1:], ws[2:]))
    repeated = {i + o for i in range(len(ws) - 2) if seen[tuple(ws[i : i + 3])] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
        len(lines), sum("A" <= c <= "Z" for c in text), text.count("!"),
    )


def test_measures(documents):
    texts = ["a b c a b c", "a a a a", "x\nx\n\n x\nx", "# $ A|B !!", "é ü z\r\nq", None, "", "a b", "p q r p q s p q r"]
    rows = q.measures(documents(*texts)).select("text", *q.MEASURES).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {t: brute(t) for t in texts}


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab \n#A!\t", max_size=60), min_size=1, max_size=8, unique=True))
def test_measures_of_any_text(spark, texts):
    rows = q.measures(spark.createDataFrame([(t,) for t in texts], "text string")).select("text", *q.MEASURES).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {t: brute(t) for t in texts}


@pytest.mark.parametrize(("k", "n", "rate"), [(0, 0, 0.1), (0, 700, 0.005), (3, 1200, 0.005), (40, 20_000, 0.005), (5, 50, 0.2)])
def test_binomial_sum(spark, k, n, rate):
    got = spark.range(1).select(q.binomial_at_most(F.lit(k).cast("long"), F.lit(n).cast("long"), rate)).first()[0]
    assert got == pytest.approx(sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1)), rel=1e-9)


def corpus(spark, n_good, n_bad_good):
    """n_good good texts of which n_bad_good carry symbols, and one junk text for the rule to reject."""
    plain = " ".join(f"w{i}" for i in range(60))
    docs = [(i, plain + (" " + " ".join(f"#{j}" for j in range(50)) if i < n_bad_good else f" {i}"), "en") for i in range(n_good)]
    docs.append((n_good, plain + " " + " ".join(f"|{i}" for i in range(100)), "en"))
    docs.append((n_good + 1, plain + " " + " ".join(f"|{i}" for i in range(100)), "fr"))
    labels = spark.createDataFrame([(i, 1) for i in range(n_good)], "doc_id long, quality int")
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels


def test_certified_cutoff_rejects_junk_in_its_stratum_only(spark):
    docs, labels = corpus(spark, 600, 0)
    kept = {r.doc_id: r.kept for r in q.judge(docs, labels, risk=0.1).collect()}
    assert not kept[600] and kept[601]  # no labels in French certify nothing there
    assert sum(kept.values()) == 601


def test_cutoff_that_rejects_good_documents_is_not_used(spark):
    docs, labels = corpus(spark, 600, 60)
    kept = {r.doc_id: r.kept for r in q.judge(docs, labels, risk=0.1).collect()}
    assert all(kept[i] for i in range(600))


def test_too_few_labels_certify_nothing(spark):
    docs, labels = corpus(spark, 40, 0)
    assert all(r.kept for r in q.judge(docs, labels).collect())


def test_keep_equals_judge(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = q.judge(docs, labels).where("kept").select("doc_id")
    assert sorted(r[0] for r in q.keep(docs, labels).select("doc_id").collect()) == sorted(r[0] for r in judged.collect())


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0)], "doc_id long, quality int")
    rows = q.judge(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert [r.n_words for r in rows if r.doc_id == 5] == [30_000]
    assert q.keep(odd, labels).columns == odd.columns
    assert q.judge(odd.limit(0), labels.limit(0)).count() == 0
