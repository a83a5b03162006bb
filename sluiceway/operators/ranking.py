"""Top lists, distinct values and chunks of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.session import hand_over


def top_k(df: DataFrame, by: str, k: int = 5, tiebreak: str | None = None) -> DataFrame:
    """The k rows with the largest value; each task keeps its own k first."""
    order = [F.desc(by)] + ([F.asc(tiebreak)] if tiebreak else [])
    return df.orderBy(*order).limit(k)


def top_k_per(df: DataFrame, group: list[str], by: str, k: int = 5, tiebreak: str | None = None) -> DataFrame:
    """The k largest rows of each group, with their ``rank`` from 1.

    Spark keeps only k rows of a group per task before the shuffle.
    """
    order = [F.desc(by)] + ([F.asc(tiebreak)] if tiebreak else [])
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def top_names(df: DataFrame, by: str, name: str, metric: str, k: int = 5) -> DataFrame:
    """One row (metric, values): the names of the k largest rows, largest first."""
    best = top_k(df, by, k, name).select(F.struct((-F.col(by)).alias("o"), F.col(name).alias("n")).alias("r"))
    ranked = F.array_sort(F.collect_list("r"))
    return best.agg(F.transform(ranked, lambda r: r["n"].cast("string")).alias("values")).select(
        F.lit(metric).alias("metric"), "values"
    )


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value and the row count, in one pass."""
    return df.agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n")
    )


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def value_chunks(df: DataFrame, column: str, size: int = 99) -> DataFrame:
    """Distinct values in order, cut into chunks of ``size``: (value, chunk) with chunks from 0.

    The distinct values are spread over tasks by range and written once, so that each keeps its range.
    Values are numbered within a range, and only the sizes of the ranges are added up in one task.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.select(column).distinct().repartitionByRange(ranges, column)
    values = hand_over(spread.withColumn("_range", F.spark_partition_id()), "value-ranges")
    sizes = values.groupBy(F.col("_range").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    skipped = sizes.select("_of", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(column)) + F.col("_skip")
    return values.join(skipped, F.col("_range") == F.col("_of")).select(
        column, F.floor((number - 1) / size).cast("int").alias("chunk")
    )
