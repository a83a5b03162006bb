"""Catalog tables: typed append, overwrite of tables and partitions, load, truncate, drop, recover."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.sources.tables import read_csv


def conform(df: DataFrame, schema: StructType | str, ignore_unknown: bool = True) -> DataFrame:
    """The declared columns with the declared types; missing columns are null.

    A column that is not declared is left out, or an error without ``ignore_unknown``. A value that does not
    fit its declared type ends the job: a table must not lose values without a trace. Use ``try_cast`` before.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = {c.lower(): c for c in df.columns}
    unknown = sorted(set(have) - {f.name.lower() for f in declared})
    if unknown and not ignore_unknown:
        raise ValueError(f"columns not declared: {', '.join(unknown)}")
    return df.select(
        *[
            F.col(have[f.name.lower()]).cast(f.dataType).alias(f.name)
            if f.name.lower() in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in declared
        ]
    )


def append_table(
    df: DataFrame,
    table: str,
    schema: str,
    ignore_unknown: bool = True,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Append typed rows; the table is created when it is missing, with ``path`` as an external one."""
    writer = conform(df, schema, ignore_unknown).write.mode("append").format("parquet")
    if path:
        writer = writer.option("path", path)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """An insert into a catalog table takes this setting from the session only."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _as_stored(df: DataFrame, table: str) -> DataFrame:
    """Columns in the order of the table, because an insert goes by position."""
    return df.select(*df.sparkSession.table(table).columns)


def insert_into(df: DataFrame, table: str) -> None:
    _as_stored(df, table).write.mode("append").insertInto(table)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace all rows of a table."""
    with _overwrite_mode(df.sparkSession, "static"):
        _as_stored(df, table).write.insertInto(table, overwrite=True)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace only the partitions that the new rows belong to, in one write."""
    spark = df.sparkSession
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not keys:
        raise ValueError(f"{table} has no partition columns")
    with _overwrite_mode(spark, "dynamic"):
        _as_stored(df, table).hint("rebalance", *keys).write.insertInto(table, overwrite=True)


def create_table(spark: SparkSession, table: str, schema: str, path: str | None = None, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Create an empty table when it is missing; with ``path`` an external one."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING {fmt}{parts}{place}")


def create_table_as(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet", compression: str = "snappy") -> None:
    """Create a table from rows, when it is missing."""
    writer = df.write.format(fmt).option("compression", compression).mode("ignore")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def load_data(
    spark: SparkSession, csv: str, table: str, partition: dict[str, str] | None = None, overwrite: bool = False
) -> None:
    """Load delimited files with a header into a table, or into one of its partitions."""
    fixed = partition or {}
    stored = spark.table(table).schema
    in_file = StructType([f for f in stored.fields if f.name not in fixed])
    rows = read_csv(spark, csv, in_file.simpleString()[len("struct<") : -1].replace(":", " "))
    rows = rows.withColumns({name: F.lit(value).cast(stored[name].dataType) for name, value in fixed.items()})
    if not overwrite:
        insert_into(rows, table)
    elif fixed:
        overwrite_partitions(rows, table)
    else:
        overwrite_table(rows, table)


def _is_external(spark: SparkSession, table: str) -> bool:
    return spark.catalog.getTable(table).tableType == "EXTERNAL"


def _partitions_of(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The partitions that the catalog knows, as column to value."""
    return [
        {unquote(k): unquote(v) for k, v in (level.split("=", 1) for level in row[0].split("/"))}
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    ]


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def truncate_table(spark: SparkSession, table: str, partition: dict[str, str | Sequence[str]] | None = None) -> None:
    """Delete all rows, or those of the matching partitions, of an external table too.

    ``partition`` maps some or all of the partition columns to a value or a list of values; every partition
    that agrees in these columns is emptied. None matching is no error.
    """
    external = _is_external(spark, table)
    if not partition:
        if external:
            overwrite_table(spark.createDataFrame([], spark.table(table).schema), table)
        else:
            spark.sql(f"TRUNCATE TABLE {table}")
        return
    wanted = {k: {v} if isinstance(v, str) else set(v) for k, v in partition.items()}
    matching = [p for p in _partitions_of(spark, table) if all(p[k] in values for k, values in wanted.items())]
    for found in matching:
        where = "PARTITION (" + ", ".join(f"`{k}` = {_quoted(v)}" for k, v in found.items()) + ")"
        if external:  # Spark truncates managed tables only
            _empty_folder(spark, _location(spark, table, where))
        else:
            spark.sql(f"TRUNCATE TABLE {table} {where}")
    if external and matching:
        spark.catalog.refreshTable(table)


def _location(spark: SparkSession, table: str, where: str) -> str:
    """The folder of a partition, as the catalog knows it; it need not lie below that of the table."""
    told = spark.sql(f"DESCRIBE EXTENDED {table} {where}")
    return told.where("col_name = 'Location'").select("data_type").first()[0]


def _empty_folder(spark: SparkSession, folder: str) -> None:
    """Delete the files of a folder: calls to the store, no Spark job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        for entry in fs.listStatus(path):
            fs.delete(entry.getPath(), True)


def drop_table(spark: SparkSession, table: str, purge_data: bool = True) -> None:
    """Remove a table if it exists; ``purge_data`` deletes the rows of an external table as well."""
    if purge_data and spark.catalog.tableExists(table) and _is_external(spark, table):
        truncate_table(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders that were written beside the table."""
    spark.catalog.recoverPartitions(table)
