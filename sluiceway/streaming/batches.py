"""What streams share: triggers, checkpoints and sinks that tolerate a repeated batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BatchFunction = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame,
    checkpoint: str,
    write: BatchFunction,
    output_mode: str = "append",
    interval: str | None = "5 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Run ``write`` for every micro-batch; without an interval, process what is there and stop.

    Offsets and state live in the checkpoint folder, which must be on shared storage.
    """
    writer = stream.writeStream.foreachBatch(write).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id}"


def to_folder(path: str) -> BatchFunction:
    """One sub-folder per micro-batch. A repeated batch replaces its folder, so nothing is counted twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def to_console(rows: int = 20) -> BatchFunction:
    """Print the first ``rows`` rows of each micro-batch: a preview, not a full output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.show(rows, truncate=False)

    return write


def to_messages(fmt: str = "kafka", **options: str) -> BatchFunction:
    """(metric, values) rows as key/value messages; each task keeps one connection for its rows.

    The format is told the number of the batch as the option ``batch``; one that knows it, as ``spool`` does, takes a repeated
    batch once. Others take it again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        text = F.concat_ws(",", F.col("metric"), F.to_json("values"))
        messages = batch.select(F.col("metric").alias("key"), text.alias("value"))
        messages.write.format(fmt).options(**options, batch=str(batch_id)).mode("append").save()

    return write


def fan_out_to(outputs: dict[str, tuple[list, BatchFunction]]) -> BatchFunction:
    """Several projections of each micro-batch, each to its own sink: ``{name: (columns, sink)}``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for columns, sink in outputs.values():
                sink(batch.select(*columns), batch_id)
        finally:
            batch.unpersist()

    return write


def merged(*sinks: BatchFunction) -> BatchFunction:
    """Write each micro-batch to several sinks."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def running_total(stream: DataFrame, keys: list[str], total) -> DataFrame:
    """Sum per key since the stream began; use complete or update mode."""
    return stream.groupBy(*keys).agg(F.sum(total).alias("total"))


def append_parsed(stream: DataFrame, table_path: str, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """Append parsed rows to a Parquet table, each row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start(table_path)


def append_to_table(stream: DataFrame, table: str, checkpoint: str, interval: str | None = "5 seconds") -> StreamingQuery:
    """Append parsed rows to a catalog table, created when missing."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).toTable(table)
