"""Ordered work per key without one task per key.

A window partitioned by device alone puts all rows of a device into one task, so one busy device decides
how long the job takes. The operators here cut every device into time slices:

1. each (key, slice) is reduced to one small summary row with map-side combine;
2. a window over the summaries, a few rows per key, finds what each slice inherits from its neighbours;
3. the inherited values join the detail as one extra *edge row* per (key, slice), which sorts in front
   of the slice, so that an ordinary window over (key, slice) gives the answer of a window over the key.

The detail is shuffled once, and no task holds more than one slice of one key. ``fit_slice`` measures
which slice length keeps the largest slice below a row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sluiceway.functions.clock import duration_micros, micros, order_value

SLICE, TIME, EDGE = "_slice", "_time", "_edge"

# Later than every real time, and far enough from the bigint limit for frame arithmetic.
END_OF_TIME = 2**62


def add_slice(df: DataFrame, time: str, width: str) -> DataFrame:
    """Add the time in microseconds and the number of its slice, counted from 1970 in both directions."""
    size = duration_micros(width)
    return df.withColumn(TIME, micros(df, time)).withColumn(SLICE, F.expr(f"({TIME} - pmod({TIME}, {size})) div {size}"))


def row_order(sliced: DataFrame, tiebreak: Sequence[str]) -> Column:
    """Sort value of a row within its key, for ``min_by`` and ``max_by``."""
    return order_value(sliced, F.col(TIME), tiebreak)


def summarise(sliced: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return sliced.groupBy(*keys, SLICE).agg(*aggs)


def over_slices(keys: Sequence[str], newest_first: bool = False) -> WindowSpec:
    """Window over the summary rows of a key; rows without a time come first in time."""
    order = F.desc_nulls_last(SLICE) if newest_first else F.asc_nulls_first(SLICE)
    return Window.partitionBy(*keys).orderBy(order)


def before_this(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def up_to_this(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_edges(sliced: DataFrame, edges: DataFrame) -> DataFrame:
    """Detail rows plus the edge rows; ``EDGE`` is 0 on edge rows and 1 on detail rows."""
    return sliced.withColumn(EDGE, F.lit(1)).unionByName(
        edges.withColumn(EDGE, F.lit(0)), allowMissingColumns=True
    )


def in_slice(keys: Sequence[str], tiebreak: Sequence[str], newest_first: bool = False) -> WindowSpec:
    """Window over one slice with its edge row in front."""
    names = [TIME, *tiebreak]
    order = [F.desc_nulls_last(c) if newest_first else F.asc_nulls_first(c) for c in names]
    return Window.partitionBy(*keys, SLICE).orderBy(F.col(EDGE), *order)


def detail_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(F.col(EDGE) == 1).select(*columns)


def largest_slices(df: DataFrame, keys: Sequence[str], time: str, width: str) -> DataFrame:
    """Row count per (key, slice), the largest first."""
    return add_slice(df, time, width).groupBy(*keys, SLICE).count().orderBy(F.desc("count"))


def fit_slice(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    max_rows: int,
    widths: Sequence[str] = ("30 days", "1 day", "6 hours", "1 hour", "10 minutes", "1 minute"),
) -> str:
    """The longest of the widths whose largest (key, slice) has at most ``max_rows`` rows.

    One pass over key and time; only one number per width reaches the driver. Raises when even the
    shortest width is too long.
    """
    shortest = min(widths, key=duration_micros)
    fine = add_slice(df, time, shortest).groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("n"))
    step = duration_micros(shortest)
    # The small counts are copied once per width and added up for all widths together.
    wider = [
        F.struct(F.lit(w).alias("width"), F.floor(F.col(SLICE) * step / duration_micros(w)).alias("coarse")) for w in widths
    ]
    per_slice = fine.select(*keys, "n", F.inline(F.array(*wider))).groupBy(*keys, "width", "coarse").agg(F.sum("n").alias("n"))
    found = {r["width"]: r["n"] for r in per_slice.groupBy("width").agg(F.max("n").alias("n")).collect()}
    largest = {w: found.get(w, 0) for w in widths}
    for width in sorted(widths, key=duration_micros, reverse=True):
        if largest[width] <= max_rows:
            return width
    raise ValueError(f"a {shortest} slice still holds {largest[shortest]} rows; add a shorter width")
