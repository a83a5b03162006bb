"""Row numbers without a task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.session import hand_over


def number_rows(df: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of each ``within`` group from 0 in the given order, as a long column ``name``.

    Rows are range-partitioned over groups and order, so a group with most of the rows spreads over many
    tasks; each task sorts its range, and only (partition, group) counts are added up. Rows that tie in
    everything get distinct numbers in an arbitrary order. The sorted rows go through the shared folder.
    """
    placed = hand_over(
        df.repartitionByRange(*within, *order)
        .sortWithinPartitions(*within, *order)
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}),
        "numbered",
    )
    parts = placed.groupBy("_part", *within).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_of_{c}") for c in within],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col("_part") == F.col("_p")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return placed.join(offsets, same).withColumn(name, F.col("_at") + F.col("_shift")).select(*df.columns, name)
