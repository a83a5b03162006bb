"""The pipeline from end to end: every stage's rows against plain Python or SQL on that stage's own input."""

import duckdb
import pytest
from test_near_copies import brute

import corpus_pipeline as c
from sluiceway.llm import mixing
from sluiceway.llm.oracles import op1_sql, op8_sql


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage as lists of rows, by name."""
    sf_dir = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in c.STAGES:
        made = c.hand_over(stage(spark, docs, sf_dir), "tested-stage")
        out[name] = (docs.collect(), made.collect())
        if name != c.STAGES[-1][0]:
            assert made.columns == docs.columns
        docs = made
    return out


def by_sql(sql, documents, columns):
    con = duckdb.connect()
    con.register("given", documents)
    con.execute("CREATE TABLE documents AS SELECT * FROM given")
    for name in ("labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
    return con.execute(f"SELECT {columns} FROM ({sql})").fetchall()


def frame(rows):
    import pandas as pd

    return pd.DataFrame([r.asDict() for r in rows])


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_names():
    assert [n for n, _ in c.STAGES] == ["quality rules", "near-dedup", "benchmark decontamination", "mixing to target weights", "sharding"]


def test_quality(stages):
    given, made = stages["quality rules"]
    assert ids(made) == sorted(i for i, kept in by_sql(op1_sql(), frame(given), "doc_id, kept") if kept)


def test_near_dedup(stages):
    given, made = stages["near-dedup"]
    assert ids(made) == sorted(set(brute({r.doc_id: r.text for r in given}).values()))


def test_decontamination(stages):
    given, made = stages["benchmark decontamination"]
    assert ids(made) == sorted(i for i, bad in by_sql(op8_sql(), frame(given), "doc_id, contaminated") if not bad)


def test_mixing(spark, stages):
    given, made = stages["mixing to target weights"]
    docs = spark.createDataFrame(given)
    labels = mixing.label_domains(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rates = {r.doc_id: (r.rate, r.chosen) for r in mixing.mix(docs, labels).collect()}
    assert ids(made) == sorted(i for i, (_, chosen) in rates.items() if chosen)
    assert {i for i, (rate, _) in rates.items() if rate >= 1} <= set(ids(made))
    domains = {r.doc_id: r.domain for r in labels.collect()}
    good = [i for i in ids(given) if domains.get(i) == "good"]
    assert sum(i in set(ids(made)) for i in good) > 0.95 * len(good)


def test_sharding(stages):
    given, made = stages["sharding"]
    sizes = {r.doc_id: len((r.text or "").encode()) + 1 for r in given}
    assert {r.doc_id: r["size"] for r in made} == sizes and len(made) == len(given)
    loads = [sum(r["size"] for r in made if r.shard == s) for s in range(16)]
    assert max(loads) - min(loads) <= 0.05 * max(loads)
    assert all(sorted(r.slot for r in made if r.shard == s) == list(range(sum(r.shard == s for r in made))) for s in range(16))


def test_run_is_the_stages_in_order(spark, stages):
    assert sorted(map(tuple, c.run(spark, "/root/testdata/sf0.01").select("doc_id", "size", "shard", "slot").collect())) == sorted(
        (r.doc_id, r["size"], r.shard, r.slot) for r in stages["sharding"][1]
    )
