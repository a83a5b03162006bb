"""Fixed time windows per device: averages, extremes, last values and counter growth."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.clock import duration_micros, micros, order_value


@dataclass(frozen=True)
class Last:
    """Value of the latest row of the window."""

    column: str


@dataclass(frozen=True)
class Growth:
    """Latest value minus earliest value; with ``zero_guard`` 0 when the latest value is 0."""

    column: str
    zero_guard: bool = True


def any_set(column: str) -> Column:
    """1 when the 0/1 column was set in any row of the window: the mean, rounded up, of such a column."""
    return F.max(column).cast("int")


def mean(column: str, digits: int = 0) -> Column:
    return F.round(F.avg(column), digits)


def tumble(
    df: DataFrame,
    keys: Sequence[str],
    time: Column | str,
    width: str,
    spec: dict[str, Column | Last | Growth],
    order: Sequence[str] = (),
    as_text: bool = True,
) -> DataFrame:
    """Aggregate per key and time window; the window becomes the columns ``start`` and ``end``.

    ``spec`` maps output names to aggregates. ``Last`` and ``Growth`` need ``order``: a time column, and
    columns that decide between rows of one time. Everything is combined before the shuffle, so a busy device
    sends at most one row per task and window.
    """
    by_edge = {name: agg for name, agg in spec.items() if isinstance(agg, Last | Growth)}
    if by_edge and not order:
        raise ValueError("Last and Growth need the order columns")
    needed = sorted({agg.column for agg in by_edge.values()})
    grown = sorted({agg.column for agg in by_edge.values() if isinstance(agg, Growth)})
    position = order_value(df, micros(df, order[0]), order[1:]) if by_edge else None
    aggs = [agg.alias(name) for name, agg in spec.items() if name not in by_edge]
    aggs += [F.max_by(c, position).alias(f"_last_{c}") for c in needed]
    aggs += [F.min_by(c, position).alias(f"_first_{c}") for c in grown]

    grouped = df.groupBy(*keys, F.window(time, width).alias("_window")).agg(*aggs)

    def result(name: str) -> Column:
        agg = by_edge.get(name)
        if agg is None:
            return F.col(name)
        last = F.col(f"_last_{agg.column}")
        if isinstance(agg, Last):
            return last.alias(name)
        growth = last - F.col(f"_first_{agg.column}")
        if agg.zero_guard:
            growth = F.when(last == 0, F.lit(0)).otherwise(growth)
        return growth.alias(name)

    return unpack_window(grouped, "_window", as_text).select(*keys, "start", "end", *[result(n) for n in spec])


def unpack_window(df: DataFrame, column: str = "window", as_text: bool = True) -> DataFrame:
    """Turn a window struct into ``start`` and ``end``, as text or as timestamps."""
    start, end = F.col(f"{column}.start"), F.col(f"{column}.end")
    if as_text:
        start, end = start.cast("string"), end.cast("string")
    return df.withColumns({"start": start, "end": end}).drop(column)


def sliding_sum(
    df: DataFrame, keys: Sequence[str], time: str, value: Column | str, size: str, slide: str, name: str = "total"
) -> DataFrame:
    """Sum per key over overlapping windows of ``size`` that start every ``slide``.

    Rows are first summed into panes of one ``slide``; only panes are copied into the size/slide windows
    that hold them. ``size`` must be a multiple of ``slide``. On a stream the time column needs a watermark,
    and a window leaves the state when the watermark passes its end.
    """
    if duration_micros(size) % duration_micros(slide):
        raise ValueError(f"{size} is no multiple of {slide}")
    value = F.col(value) if isinstance(value, str) else value
    panes = df.groupBy(*keys, F.window(time, slide).alias("_pane")).agg(F.sum(value).alias("_part"))
    if df.isStreaming:
        placed = panes.groupBy(*keys, F.window("_pane", size, slide).alias("window"))
    else:
        step = F.expr(f"INTERVAL {slide}")
        first = F.col("_pane.start") - F.expr(f"INTERVAL {size}") + step
        starts = F.explode(F.sequence(first, F.col("_pane.start"), step))
        spread = panes.select(*keys, "_part", starts.alias("start"))
        span = F.struct("start", (F.col("start") + F.expr(f"INTERVAL {size}")).alias("end"))
        placed = spread.withColumn("window", span).groupBy(*keys, "window")
    return placed.agg(F.sum("_part").alias(name)).select("window", *keys, name)
