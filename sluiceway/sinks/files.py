"""Partitioned Parquet and delimited text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], mode: str = "append", sort: Sequence[str] = ()
) -> None:
    """Parquet in one folder per value of the columns.

    ``mode='overwrite'`` replaces the whole target, ``'overwrite_partitions'`` only the folders written. Rows
    of one folder are brought together first, and a large folder is split over several tasks.
    """
    df = df.hint("rebalance", *columns)
    if sort:
        df = df.sortWithinPartitions(*columns, *sort)
    writer = df.write.option("compression", "snappy").partitionBy(*columns)
    if mode == "overwrite_partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.option("partitionOverwriteMode", "static").mode(mode)
    writer.parquet(path)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", stamp: dt.datetime | None = None, **options: str
) -> str:
    """Delimited text with a header; with ``stamp`` into a sub-folder named by the time. Returns the folder."""
    if stamp is not None:
        path = f"{path.rstrip('/')}/{stamp:%Y-%m-%d_%H-%M-%S}"
    df.write.mode(mode).options(header="true", **options).csv(path)
    return path
