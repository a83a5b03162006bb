"""Latest state per key from a stream of change messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.changes import DELETED, newest_per_key
from sluiceway.streaming import batches
from sluiceway.streaming.generations import Generations


def change_store(spark: SparkSession, path: str, schema: str, keys: Sequence[str], order: Sequence[str], fan: int = 8) -> Generations:
    """The newest change of every key, deletes included."""
    return Generations(spark, path, schema, lambda rows: newest_per_key(rows, keys, order), fan=fan)


def start_latest_changes(
    changes: DataFrame,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    order: Sequence[str] = ("ts_ms", "pos"),
    interval: str | None = "5 seconds",
    fan: int = 8,
) -> StreamingQuery:
    """Keep the newest change of each key as state, and add the keys that changed in each batch to the table in ``path``."""
    newest = newest_per_key(changes, keys, order)
    schema = schema_text(newest)

    def write(changed: DataFrame, batch_id: int) -> None:
        change_store(changed.sparkSession, path, schema, keys, order, fan).append(changed, batch_id)

    return batches.start(newest, checkpoint, write, "update", interval)


def schema_text(df: DataFrame) -> str:
    """The columns of a frame as a schema text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def read_latest_state(
    spark: SparkSession, path: str, keys: Sequence[str], row_schema: str, order: Sequence[str] = ("ts_ms", "pos"), order_type: str = "bigint"
) -> DataFrame:
    """The current rows of the table that ``start_latest_changes`` keeps; deleted keys are left out."""
    schema = ", ".join([*(f"`{c}` {order_type}" for c in order), "op string", f"row struct<{row_schema}>"])
    return change_store(spark, path, schema, keys, order).read().where(f"op <> '{DELETED}'").select("row.*")
