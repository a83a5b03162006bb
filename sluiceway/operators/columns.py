"""Column clean-up: names, choice types, mappings, defaults and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from sluiceway.functions.clock import path_value


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case all column names; names that differ only in case are an error."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("columns differ only in case")
    return df.toDF(*names)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns in place; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def strip_aggregate_names(df: DataFrame) -> DataFrame:
    """``max(x)`` becomes ``x``."""
    found = {c: c[c.index("(") + 1 : -1] for c in df.columns if c.endswith(")") and "(" in c}
    return df.withColumnsRenamed(found)


def split_path_parts(df: DataFrame, parts: dict[str, str]) -> DataFrame:
    """Replace raw path parts by their values: ``{"partition_1": "year"}`` turns ``year-2021`` into 2021."""
    return df.withColumns({name: path_value(part) for part, name in parts.items()}).drop(*parts)


def resolve_choice(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    """Flatten columns that hold a struct with one field per type to the first field that is set.

    Fields are tried in the order ``to`` first, then as declared. A column of plain type is only cast.
    """
    flat = {}
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, StructType):
            fields = sorted(kind.fieldNames(), key=lambda f: f != to)
            flat[c] = F.coalesce(*[F.col(c)[f].try_cast(to) for f in fields])
        else:
            flat[c] = F.col(c).try_cast(to)
    return df.withColumns(flat)


def apply_mapping(df: DataFrame, mappings: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Project to (source, target, type) entries; values that do not fit become null."""
    return df.select(*[F.col(source).try_cast(kind).alias(target) for source, target, kind in mappings])


def drop_null_fields(df: DataFrame) -> DataFrame:
    """Drop the columns of the null type, inside structs too."""
    kept = []
    for field in df.schema.fields:
        if isinstance(field.dataType, NullType):
            continue
        if isinstance(field.dataType, StructType):
            empty = [f.name for f in field.dataType.fields if isinstance(f.dataType, NullType)]
            if len(empty) == len(field.dataType.fields):
                continue
            column = F.col(field.name)
            kept.append((column.dropFields(*empty) if empty else column).alias(field.name))
        else:
            kept.append(F.col(field.name))
    return df.select(*kept)


def with_load_time(df: DataFrame, name: str = "loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls in numeric columns become 0."""
    return df.fillna(0, subset=list(columns))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.dropna("any", subset=list(columns))


def zero_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty or missing text becomes ``'0'``."""
    return df.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("0")) for c in columns})


def fan_out(df: DataFrame, outputs: dict[str, Sequence[str | Column]]) -> dict[str, DataFrame]:
    """Several projections of one parsed frame, by name."""
    return {name: df.select(*columns) for name, columns in outputs.items()}
