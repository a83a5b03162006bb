"""Catalog tables, partitioned folders, raw zones, delimited, JSON and XML files, and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.functions.clock import path_value
from sluiceway.operators.columns import lower_names


def read_table(
    spark: SparkSession, name: str, partitions: dict[str, str] | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """A catalog table, or a Parquet folder when the name holds a slash.

    ``partitions`` keeps only the matching partition folders; the others are not listed or read. The partition
    columns of a folder are text, so ``month=08`` stays ``08`` and can be written on under the same name; a
    ``schema`` says otherwise for the columns it names. Without a ``schema``, the columns are those of one matching file.
    No matching folder gives an empty frame.
    """
    wanted = partitions or {}
    df = lower_names(spark.table(name) if "/" not in name else _read_folder(spark, name.rstrip("/"), wanted, schema))
    for column, value in wanted.items():
        df = df.where(F.col(column) == value)
    return df


def _read_folder(spark: SparkSession, folder: str, wanted: dict[str, str], schema: StructType | str | None) -> DataFrame:
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    file = _first_file(spark, folder, wanted)
    sample = file or _first_file(spark, folder, {})
    if sample is None:
        if declared is None:
            raise FileNotFoundError(f"{folder} holds no file that tells its columns")
        return spark.createDataFrame([], declared)
    levels = [level.split("=", 1)[0] for level in sample.split("/")[:-1] if "=" in level]
    held = spark.read.parquet(folder + sample).schema if declared is None else declared
    named = {f.name for f in held}
    whole = StructType([*held, *(StructField(level, StringType()) for level in levels if level not in named)])
    if file is None:
        return spark.createDataFrame([], whole)
    # Only the folders of this pattern are listed; escaped values hold no character that means something in a pattern.
    depth = max((i + 1 for i, level in enumerate(levels) if level in wanted), default=0)
    pattern = "".join(f"/{level}={_escaped(spark, wanted[level]) if level in wanted else '*'}" for level in levels[:depth])
    return spark.read.schema(whole).option("basePath", folder).parquet(folder + pattern)


def _first_file(spark: SparkSession, folder: str, wanted: dict[str, str]) -> str | None:
    """The first file of a folder that lies in the wanted partitions, as its path below the folder.

    Only one path is walked down where the partitions are named.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def below(at) -> str | None:
        entries = fs.listStatusIterator(at)
        while entries.hasNext():
            entry = entries.next()
            name = entry.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if entry.isFile():
                return entry.getPath().toString()
            level = name.split("=", 1)[0]
            if "=" in name and level in wanted:
                named = hadoop.Path(at, f"{level}={_escaped(spark, wanted[level])}")
                return below(named) if fs.exists(named) else None
            if found := below(entry.getPath()):
                return found
        return None

    root = fs.makeQualified(hadoop.Path(folder))
    found = below(root) if fs.exists(root) else None
    return found and found[len(root.toString()) :]


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as it stands in the name of a folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def with_position(spark: SparkSession, folder: str) -> DataFrame:
    """A Parquet folder with ``file``, ``row`` (its number in the file) and ``position``, its number in the order of the files.

    Only the sizes of the files are added up in one task. Files written by a sorted job are in order by their names.
    """
    rows = spark.read.parquet(folder).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    sizes = rows.groupBy("file").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    skipped = sizes.select(F.col("file").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"))
    return rows.join(skipped, F.col("file") == F.col("_of")).withColumn("position", F.col("row") + F.col("_skip")).drop("_of", "_skip")


def read_raw_zone(
    spark: SparkSession, root: str, parts: dict[str, str], fmt: str = "parquet", schema: str | None = None, **options: str
) -> DataFrame:
    """Files in folders such as ``root/year-2021/month-08/day-03``, with the folder values as columns.

    ``parts`` lists the folder levels in order with the wanted value, or ``*`` for all:
    ``{"year": "2021", "month": "08", "day": "*"}``. Only the matching folders are listed.
    """
    pattern = "/".join(f"{name}-{value}" for name, value in parts.items())
    reader = spark.read.format(fmt).options(**options)
    df = lower_names((reader.schema(schema) if schema else reader).load(f"{root.rstrip('/')}/{pattern}"))
    folders = F.split(F.col("_metadata.file_path"), "/")
    # The file name is the last item, so the levels end one before it.
    level = {name: F.get(folders, F.size(folders) - 1 - len(parts) + i) for i, name in enumerate(parts)}
    return df.withColumns({name: path_value(part) for name, part in level.items()})


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, **options: str) -> DataFrame:
    """Delimited text with a declared schema; pass ``multiLine='true'`` for quoted line breaks."""
    return spark.read.options(header=str(header).lower(), **options).schema(schema).csv(path)


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """XML files with one row per element, split over tasks like text files."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def run_sql(spark: SparkSession, sql: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text over the catalog and over named frames.

    Frames are written ``{name}`` in the text; values and, through ``IDENTIFIER(:name)``, table names are
    parameters, so no text is pasted into the statement.
    """
    return spark.sql(sql, args=args, **frames)


def select_all(spark: SparkSession, table: str) -> DataFrame:
    """``SELECT *`` from a table named by a parameter."""
    return run_sql(spark, "SELECT * FROM IDENTIFIER(:table)", {"table": table})
