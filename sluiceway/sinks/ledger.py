"""Inserts and loads that can be repeated: what is done is noted with the rows, and a second run does only what is open."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BatchFunction = Callable[[DataFrame, int], None]


def insert_once(append: Callable[[DataFrame], None], ledger: Callable[[SparkSession, int], DataFrame], parts: int = 8) -> BatchFunction:
    """A ``foreachBatch`` function that appends the rows of a batch once, also if a run died half way.

    Rows get ``batch_id`` and ``part``, a hash of the row that is the same on every run, and a part is written by one task. The
    target itself is the ledger: ``ledger(spark, batch_id)`` reads the column ``part`` of what it holds of a batch. Parts found
    there are left out. ``append`` must put the rows of a task into the target wholly or not at all.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in batch.columns]), F.lit(parts)).cast("int")
        marked = batch.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "part": part})
        done = ledger(batch.sparkSession, batch_id).select(F.col("part").cast("int").alias("_done")).distinct()
        open_ = marked.join(F.broadcast(done), F.col("part") == F.col("_done"), "left_anti")  # at most ``parts`` numbers
        append(open_.repartition(parts, "part"))

    return write


class ChunkLoad:
    """A load of a partitioned target in chunks of partition values, which goes on where it was stopped.

    ``path`` holds the log of the load: one small file per finished chunk. A chunk is written to a staging folder first and
    then moved, partition by partition, over the target; only then it is logged. A run that died leaves a chunk unlogged, and
    the next run does that chunk again from its staging folder, if that is complete, or from the rows. The chunks are those
    that the load was begun with.
    """

    def __init__(self, spark: SparkSession, path: str, target: str, column: str):
        self.spark, self.path, self.target, self.column = spark, path.rstrip("/"), target.rstrip("/"), column
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._fs = self._jvm.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def run(self, rows: DataFrame, chunks: DataFrame, at_most: int | None = None) -> int:
        """Load the open chunks and return how many were loaded.

        ``chunks`` has the partition column and ``chunk``, as ``value_chunks`` gives; it is written once, when the load begins.
        ``at_most`` stops after so many chunks.
        """
        plan = self._plan(chunks)
        loaded = 0
        for chunk in self.open_chunks(plan):
            if at_most is not None and loaded == at_most:
                break
            self._load(rows, plan.where(F.col("chunk") == chunk), chunk)
            loaded += 1
        return loaded

    def done(self) -> set[int]:
        folder = self._jvm.Path(f"{self.path}/done")
        if not self._fs.exists(folder):
            return set()
        return {int(s.getPath().getName()) for s in self._fs.listStatus(folder)}

    def open_chunks(self, plan: DataFrame) -> list[int]:
        numbers = {r["chunk"] for r in plan.select("chunk").distinct().collect()}
        return sorted(numbers - self.done())

    def _plan(self, chunks: DataFrame) -> DataFrame:
        place = f"{self.path}/plan"
        if not self._fs.exists(self._jvm.Path(f"{place}/_SUCCESS")):
            chunks.select(self.column, "chunk").write.mode("overwrite").parquet(place)
        return self.spark.read.parquet(place)

    def _load(self, rows: DataFrame, values: DataFrame, chunk: int) -> None:
        staged = f"{self.path}/staging/{chunk}"
        if not self._fs.exists(self._jvm.Path(f"{staged}/_SUCCESS")):
            wanted = rows.join(values.select(self.column), self.column, "left_semi")
            # A value with most of the rows is written by several tasks.
            spread = wanted.repartition(F.col(f"`{self.column}`"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(4)))
            spread.write.mode("overwrite").partitionBy(self.column).parquet(staged)
        for entry in self._fs.listStatus(self._jvm.Path(staged)):
            name = entry.getPath().getName()
            if "=" not in name:
                continue
            place = self._jvm.Path(f"{self.target}/{name}")
            self._fs.delete(place, True)
            self._fs.mkdirs(place.getParent())
            if not self._fs.rename(entry.getPath(), place):
                raise OSError(f"{name} could not be moved to {self.target}")
        self._note(chunk)
        self._fs.delete(self._jvm.Path(staged), True)

    def _note(self, chunk: int) -> None:
        stream = self._fs.create(self._jvm.Path(f"{self.path}/done/{chunk}"), True)
        stream.write(bytearray(json.dumps({"chunk": chunk, "run": uuid.uuid4().hex}).encode()))
        stream.close()
