"""Messages to typed rows: JSON, CSV lines, XML item lists, and back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import from_base64url, tokens, utf8


def message_text(df: DataFrame, column: str = "value", encoding: str = "utf8") -> Column:
    """The text of a message column that holds bytes, text, or URL-safe base64 text."""
    if encoding == "base64url":
        return utf8(from_base64url(column))
    if encoding != "utf8":
        raise ValueError(f"encoding must be 'utf8' or 'base64url', not {encoding!r}")
    return utf8(column) if df.schema[column].dataType.typeName() == "binary" else F.col(column)


def parse_json(df: DataFrame, column: str, schema: str, encoding: str = "utf8", into: str | None = None) -> DataFrame:
    """Parse a JSON message column with a DDL schema.

    The fields replace all columns, or become one struct column ``into`` next to them. A message that is
    no JSON gives null fields.
    """
    parsed = F.from_json(message_text(df, column, encoding), schema)
    if into is not None:
        return df.withColumn(into, parsed)
    return df.select(parsed.alias("_record")).select("_record.*")


def parse_json_list(df: DataFrame, column: str, field: str, item_schema: str, encoding: str = "utf8") -> DataFrame:
    """One row per object in an array field of a JSON message."""
    record = F.from_json(message_text(df, column, encoding), f"{field} array<struct<{item_schema}>>")
    return df.select(F.explode(record[field]).alias("_item")).select("_item.*")


def json_field(column: str, path: str) -> Column:
    """Text of one JSON field, such as ``$.payload.ddl``."""
    return F.get_json_object(column, path)


def to_json_lines(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON object text."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def wrap_text(df: DataFrame, column: str = "value", name: str = "comment") -> DataFrame:
    """Plain text messages as a one-column record."""
    return df.select(message_text(df, column).alias(name))


def to_messages(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Rows as (key, value) text messages for a message sink."""
    return df.select(F.col(key).cast("string").alias("key"), value.cast("string").alias("value"))


def parse_or_drop(
    df: DataFrame, fields: dict[str, Column], valid: Callable[[Column], Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows into (typed rows, untouched bad rows).

    A row is good when no field is null and ``valid``, given the record, holds.
    """
    record = F.struct(*[c.alias(name) for name, c in fields.items()])
    # A generator of one row: filters on the record stay behind it, so each line is parsed once.
    parsed = df.select("*", F.explode(F.array(record)).alias("_record"))
    good = F.lit(True) if valid is None else F.coalesce(valid(F.col("_record")), F.lit(False))
    for name in fields:
        good = good & F.col("_record")[name].isNotNull()
    return parsed.where(good).select("_record.*"), parsed.where(~good).drop("_record")


def parse_lines(
    df: DataFrame,
    line: Column,
    types: Sequence[tuple[str, str]],
    valid: Callable[[Column], Column] | None = None,
    separator: str = ",",
) -> tuple[DataFrame, DataFrame]:
    """Separated text lines to (typed rows, untouched bad rows).

    Fields are trimmed; a line with a missing or unreadable field is bad. The type ``timestamp`` expects
    ``yyyy-MM-dd HH:mm:ss``.
    """
    fields = {}
    for i, (name, kind) in enumerate(types):
        text = F.trim(F.get("_parts", F.lit(i)))
        if kind == "timestamp":
            fields[name] = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
        else:
            fields[name] = text.try_cast(kind)
    good, bad = parse_or_drop(df.withColumn("_parts", tokens(line, separator)), fields, valid)
    return good, bad.drop("_parts")


def xml_items(df: DataFrame, column: str, item_schema: str, path: Sequence[str], names: dict[str, str] | None = None) -> DataFrame:
    """One row per repeated element of an XML document column.

    ``path`` leads from below the root to the repeated element, for example ``("body", "items", "item")``;
    ``names`` renames the item's fields.
    """
    schema = f"array<struct<{item_schema}>>"
    for step in reversed(path[1:]):
        schema = f"struct<{step}: {schema}>"
    document = F.from_xml(F.col(column), f"{path[0]} {schema}")
    items = document
    for step in path:
        items = items[step]
    rows = df.select(F.explode(items).alias("_item")).select("_item.*")
    return rows.withColumnsRenamed(names) if names else rows
