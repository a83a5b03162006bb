"""Relational databases: bounds in one query, then a scan in parallel ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Default: one range per core of a mid-size cluster (executors x cores).
NUM_PARTITIONS = 72
FETCH_SIZE = 5000


def bounds_options(url: str, table: str, column: str, **options: str) -> dict[str, str]:
    """Reader options of the query for the smallest and largest value of a column."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    return {"url": url, "query": query, **options}


def scan_options(
    url: str,
    table: str,
    column: str,
    lo: object,
    hi: object,
    num_partitions: int = NUM_PARTITIONS,
    fetch_size: int = FETCH_SIZE,
    **options: str,
) -> dict[str, str]:
    """Reader options of a scan in ranges of a numeric, date or timestamp column.

    Rows outside the bounds and rows without a value are still read, by the first and last range.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lo),
        "upperBound": str(hi),
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
        **options,
    }


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str, **options: str) -> tuple:
    """Smallest and largest value of a column: one query, one row."""
    row = spark.read.format("jdbc").options(**bounds_options(url, table, column, **options)).load().first()
    return row[0], row[1]


def read_jdbc_partitioned(spark: SparkSession, url: str, table: str, column: str, **options) -> DataFrame:
    """Scan a table in parallel ranges between the bounds of a column.

    An empty table has no bounds and is read by a single query.
    """
    connection = {k: v for k, v in options.items() if k not in ("num_partitions", "fetch_size")}
    lo, hi = jdbc_bounds(spark, url, table, column, **connection)
    if lo is None:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **connection).load()
    return spark.read.format("jdbc").options(**scan_options(url, table, column, lo, hi, **options)).load()
