"""Change-data messages: unwrapping of envelopes and the latest state per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELETED = "d"


def unwrap_changes(df: DataFrame, row_schema: str, column: str = "value") -> DataFrame:
    """Envelope JSON to (op, ts_ms, pos, source_table, before, after, row).

    ``row`` is the state after the change, or for a delete the state before it. Tombstones and messages
    that are no envelope are dropped.
    """
    envelope = (
        f"payload struct<before: struct<{row_schema}>, after: struct<{row_schema}>, "
        "source: struct<name: string, file: string, pos: bigint, row: int, snapshot: boolean, db: string, `table`: string>, "
        "op: string, ts_ms: bigint>"
    )
    text = F.col(column).cast("string")
    payload = df.select(F.from_json(text, envelope)["payload"].alias("p")).where(F.col("p.op").isNotNull())
    return payload.select(
        "p.op",
        "p.ts_ms",
        F.col("p.source.pos").alias("pos"),
        F.col("p.source.table").alias("source_table"),
        "p.before",
        "p.after",
        F.coalesce("p.after", "p.before").alias("row"),
    )


def schema_changes(df: DataFrame, column: str = "value") -> DataFrame:
    """DDL statements among the messages."""
    ddl = F.coalesce(F.get_json_object(column, "$.payload.ddl"), F.get_json_object(column, "$.ddl"))
    return df.select(ddl.alias("ddl")).where(F.col("ddl").isNotNull())


def newest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts_ms", "pos")) -> DataFrame:
    """The newest change of each key, deletes included.

    ``keys`` are fields of ``row``. Each task first reduces its changes to one per key, so a key that
    changes all the time costs no more than the others.
    """
    key_columns = [F.col(f"row.{k}").alias(k) for k in keys]
    # op and row follow the order columns, so that equal positions still give one fixed answer.
    newest = F.max(F.struct(*order, "op", "row")).alias("_newest")
    return changes.groupBy(*key_columns).agg(newest).select("_newest.*")


def latest_state(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts_ms", "pos")) -> DataFrame:
    """The current rows: the newest change of each key, without deleted keys."""
    return newest_per_key(changes, keys, order).where(F.col("op") != DELETED).select("row.*")
