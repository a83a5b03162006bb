"""Message sources: one frame with a binary ``value`` column, bounded or streaming, from any broker or folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_messages(spark: SparkSession, fmt: str, streaming: bool, schema: str | None = None, **options: str) -> DataFrame:
    """Messages as a ``value`` column of bytes.

    ``fmt`` is ``kafka`` (options ``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets``, ...), ``text``
    (one message per line) or any other source with a ``value`` column. The same code reads a stream or
    a bounded set, so a pipeline switches mode with one flag.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**options)
    df = (reader.schema(schema) if schema else reader).load()
    return df.withColumn("value", F.col("value").cast("binary"))


def read_topic(
    spark: SparkSession, servers: str, topics: list[str], streaming: bool = True, offsets: str = "latest", **options: str
) -> DataFrame:
    """Kafka topics; ``offsets`` is ``earliest`` or ``latest``. Consumed offsets live in the query's checkpoint."""
    return read_messages(
        spark,
        "kafka",
        streaming,
        **{"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": offsets, **options},
    )


def read_folder_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_batch: int | None = None, **options: str) -> DataFrame:
    """New files of a folder as a stream of typed rows; a path to one file is a stream of that file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    if found and len(found) == 1 and found[0].isFile():
        # A stream lists folders: that of the file, where all other names are passed over.
        path, options = str(place.getParent().toString()), {**options, "pathGlobFilter": place.getName()}
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
