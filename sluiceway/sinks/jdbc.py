"""Relational databases: bulk replace, and append of streamed batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway.sinks.ledger import insert_once

BULK_BATCH = 3000
BULK_PARTITIONS = 32
ROW_BATCH = 1000


def write_options(url: str, table: str, batch_size: int = BULK_BATCH, **options: str) -> dict[str, str]:
    """Writer options; an overwrite keeps the table definition and replaces the rows."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "truncate": "true", **options}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_size: int = BULK_BATCH,
    partitions: int = BULK_PARTITIONS,
    **options: str,
) -> None:
    """Write with a fixed number of connections, rows spread evenly over them."""
    writer = df.repartition(partitions).write.format("jdbc")
    writer.options(**write_options(url, table, batch_size, **options)).mode(mode).save()


def append_batch(url: str, table: str, batch_size: int = ROW_BATCH, partitions: int = 8, **options: str):
    """A ``foreachBatch`` function that appends each micro-batch, once.

    The table has two columns more, ``batch_id`` and ``part``: its own ledger of what is in it (see ``insert_once``). A part is
    written by one task on one connection, which the database commits as a whole.
    """

    def append(rows: DataFrame) -> None:
        writer = rows.write.format("jdbc").options(**write_options(url, table, batch_size, **options))
        writer.mode("append").save()

    def ledger(spark: SparkSession, batch_id: int) -> DataFrame:
        query = f"SELECT DISTINCT part FROM {table} WHERE batch_id = {int(batch_id)}"
        connection = {"url": url, "query": query, **options}
        return spark.read.format("jdbc").options(**connection).load()

    return insert_once(append, ledger, partitions)
