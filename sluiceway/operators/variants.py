"""Values of mixed types: which types a table holds is observed, and the type of each column follows from that."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

_NUMBERS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE")
_NESTED = ("OBJECT", "ARRAY")


def to_variant(df: DataFrame, column: str) -> DataFrame:
    """JSON text as a variant; text that is no JSON becomes null."""
    return df.withColumn(column, F.try_parse_json(column))


def observed_types(df: DataFrame, column: str) -> DataFrame:
    """``key, kind, n``: how often a field of a variant column holds a value of each kind. Nulls inside count as VOID.

    One aggregation that combines before the shuffle; a field adds a few rows however many rows the table has.
    """
    fields = df.select(F.col(column).alias("_variant")).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_variant").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z_]+", 0)
    return fields.groupBy("key", kind.alias("kind")).agg(F.count("*").alias("n"))


def choose(observed: Iterable[Row]) -> dict[str, str]:
    """The type of each field: its only kind; double for different numbers; string where kinds differ otherwise.

    Objects and arrays, also beside nulls, stay variants.
    """
    kinds: dict[str, set[str]] = {}
    for row in observed:
        kinds.setdefault(row["key"], set()).add(row["kind"])
    chosen = {}
    for key, found in sorted(kinds.items()):
        found = found - {"VOID"}
        if found and found <= set(_NESTED):
            chosen[key] = "variant"
        elif found and found <= {"TINYINT", "SMALLINT", "INT", "BIGINT"}:
            chosen[key] = "bigint"
        elif found and found <= set(_NUMBERS):
            chosen[key] = "double"
        elif len(found) == 1:
            chosen[key] = found.pop().lower()
        else:
            chosen[key] = "string"
    return chosen


def flatten_variant(df: DataFrame, column: str, types: dict[str, str] | None = None) -> DataFrame:
    """Replace a variant column by one typed column per field; without ``types`` they are observed first."""
    types = choose(observed_types(df, column).collect()) if types is None else types
    path = {key: f'$["{key}"]' if "'" in key else f"$['{key}']" for key in types}
    fields = [F.try_variant_get(column, path[key], kind).alias(key) for key, kind in types.items()]
    return df.select(*[c for c in df.columns if c != column], *fields)
