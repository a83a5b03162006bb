"""Mixing: the fitted rates against a plain projected gradient, decisions, odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import mixing as m


def test_expected_shares(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    labels = m.label_domains(spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/labels.parquet"))
    rows = m.mix(docs, labels).toPandas()
    assert len(rows) == docs.count() and (rows.rate >= 0).all()
    assert ((rows.p_good + rows.p_poor + rows.p_toxic - 1).abs() < 1e-9).all()
    assert rows[rows.rate >= 1].chosen.all() and not rows[rows.rate == 0].chosen.any()
    known = rows.merge(labels.toPandas(), on="doc_id")
    assert (known[known.domain == "good"].rate >= 1).mean() > 0.95
    assert known[known.domain == "toxic"].chosen.mean() < 0.4  # few labels at this size


def test_rates_solve_the_least_squares(spark):
    """Two domains, crisp and mixed cells: the rates must meet reachable targets."""
    cells = [(100, 0, 600.0), (0, 100, 300.0), (50, 50, 100.0)]
    found = spark.createDataFrame(cells, "p_0 int, p_1 int, n_tokens double")
    rate, shares = m.fit_rates(found, ["a", "b"], {"a": 0.8, "b": 0.2})
    assert shares["b"] == pytest.approx(0.2, abs=0.01)
    rates = [r[0] for r in found.select(rate).collect()]
    assert rates[0] >= 1 > rates[2] > rates[1] >= 0
    _, shares = m.fit_rates(found, ["a", "b"], {"a": 1.0, "b": 0.0})
    assert shares["b"] < 0.1  # the mixed cell cannot be split
    rate, _ = m.fit_rates(found.where("p_0 = 0"), ["a", "b"], {"a": 0.8, "b": 0.2})
    assert [r[0] for r in found.select(rate).collect()] == [1.0] * 3  # no background: nothing to mix with


def plain(p, tokens, weights, steps=20_000):
    """Projected gradient on rows, in numpy: the expected share of each domain, and the rates."""
    have = p.T @ tokens
    target = np.minimum(np.array(weights) / weights[0] * have[0], have)
    step = 1 / ((p.T * tokens) @ p / np.sqrt(np.outer(have, have))).sum(1).max()
    rate = np.ones(len(p))
    for _ in range(steps):
        rate = np.maximum(0, rate - step * (p @ ((p.T @ (rate * tokens) - target) / have)))
    got = p.T @ (rate * tokens)
    return got / got.sum(), rate


@pytest.mark.parametrize("weights", [{"good": 0.96, "poor": 0.04, "toxic": 0.0}, {"good": 0.8, "poor": 0.15, "toxic": 0.05}])
def test_shares_of_a_whole_table_against_a_plain_gradient(spark, weights):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = m.mix(docs, m.label_domains(spark.read.parquet(f"{folder}/labels.parquet")), weights).toPandas()
    p = rows[[f"p_{d}" for d in weights]].to_numpy()
    tokens = rows.n_tokens.to_numpy(float)
    shares, _ = plain(p, tokens, list(weights.values()))
    expected = p.T @ (np.minimum(rows.rate, 1) * tokens)
    assert np.abs(expected / expected.sum() - shares).max() < 0.01
    drawn = p.T @ (rows.chosen * tokens)
    assert np.abs(drawn / drawn.sum() - shares).max() < 0.05  # one draw of a thousand documents


def test_rates_do_not_depend_on_how_rare_a_domain_is(spark):
    """The same posteriors get about the same rates where the unwanted domain is a thousandth of all tokens."""
    rates = []
    for scale in (1.0, 1000.0):
        cells = [(100, 0, 10_000.0 * scale), (0, 100, 900.0), (10, 90, 100.0)]
        found = spark.createDataFrame(cells, "p_0 int, p_1 int, n_tokens double")
        rate, _ = m.fit_rates(found, ["a", "b"], {"a": 1.0, "b": 0.0})
        rates.append([r[0] for r in found.select(rate).collect()])
    assert rates[0][1] < 0.02 and rates[1][1] < 0.02 and abs(rates[0][2] - rates[1][2]) < 0.05


def test_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 1, None), (5, None, None), (None, 1, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.domain for r in m.label_domains(labels).collect()} == {1: "toxic", 2: "poor", 3: "toxic", 4: "good"}


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, "good"), (3, "poor"), (None, "good"), (3, None)], "doc_id long, domain string")
    carry = tuple(c for c in odd.columns if c not in ("rate", "n_tokens"))
    mixed = m.mix(odd, labels, carry=carry)
    assert mixed.count() == odd.count() and mixed.where("chosen").count() <= odd.count()
    assert m.mix(odd, labels.limit(0)).agg(F.min("rate")).first()[0] >= 1.0
    assert m.mix(odd.limit(0), labels).count() == 0
