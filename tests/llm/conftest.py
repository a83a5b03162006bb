import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Build a documents table from texts, or from (id, text) pairs."""

    def build(*rows, schema=SCHEMA):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], schema
        )

    return build


@pytest.fixture
def odd(documents):
    """Null, empty, tied, repeated and very long rows, and extra columns whose names clash with working columns."""
    from pyspark.sql import functions as F

    long_text = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = documents(
        (1, None), (2, ""), (None, "some words here"), (3, "a b c d"), (3, "a b c d"), (4, " \n\t "), (5, long_text), (6, "x" * 70_000)
    )
    clash = ["key", "digest", "begin", "fp", "mask", "root", "_w", "_bytes", "n_words", "rate", "shard", "slot", "items", "spans", "_found", "_once"]
    return rows.withColumns({c: F.lit("clash") for c in clash})
