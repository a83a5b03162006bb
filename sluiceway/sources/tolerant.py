"""Typed loads that lose no row: what does not fit its type goes to the rejects, with its place and the reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESCUED = "_rescued"


def typed(rows: DataFrame, schema: str, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Text columns to the types of ``schema``: (good rows, rejects); together they are all rows.

    Columns are matched by name whatever its case. A row with a value that does not fit, or without one that is ``NOT NULL``, is
    a reject: the columns of ``carry``, the whole row as JSON in ``_rescued``, and ``reasons``, an array of (column, value,
    reason). Columns that the schema does not name go to ``_rescued`` of the good rows, as JSON; it is null where all are null.
    """
    declared = rows.sparkSession.createDataFrame([], schema).schema
    wanted = {f.name.lower() for f in declared}
    given = {c.lower(): c for c in rows.columns if c not in carry}
    extra = [c for low, c in given.items() if low not in wanted]

    def text(name: str) -> Column:
        return F.col(f"`{given[name.lower()]}`") if name.lower() in given else F.lit(None).cast("string")

    values = {f.name: text(f.name).try_cast(f.dataType) for f in declared}
    checks = []
    for f in declared:
        reason = F.when(text(f.name).isNotNull() & values[f.name].isNull(), F.lit(f"no {f.dataType.simpleString()}"))
        if not f.nullable:
            reason = F.coalesce(reason, F.when(text(f.name).isNull(), F.lit("missing")))
        told = F.struct(F.lit(f.name).alias("column"), text(f.name).cast("string").alias("value"), reason.alias("reason"))
        checks.append(F.when(reason.isNotNull(), told))
    checked = rows.withColumn("_reasons", F.filter(F.array(*checks), lambda c: c.isNotNull()))
    rest = F.lit(None).cast("string")
    if extra:
        some = F.coalesce(*[F.col(f"`{c}`").cast("string") for c in extra]).isNotNull()
        rest = F.when(some, F.to_json(F.struct(*[F.col(f"`{c}`") for c in extra])))
    kept = [F.col(f"`{c}`") for c in carry]
    good = checked.where(F.size("_reasons") == 0).select(*kept, *[v.alias(n) for n, v in values.items()], rest.alias(RESCUED))
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in given.values()]))
    bad = checked.where(F.size("_reasons") > 0).select(*kept, whole.alias(RESCUED), F.col("_reasons").alias("reasons"))
    return good, bad


def read_csv_tolerant(spark: SparkSession, path: str, schema: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """Delimited files with a header: (good rows, rejects), each with ``file`` and ``block``, where it was read.

    The header names the columns, so their order may differ from the schema's, and it may have more or fewer.
    """
    lines = spark.read.options(header="true", inferSchema="false", enforceSchema="false", **options).csv(path)
    placed = lines.withColumns({"file": F.col("_metadata.file_name"), "block": F.col("_metadata.file_block_start")})
    return typed(placed, schema, ["file", "block"])
