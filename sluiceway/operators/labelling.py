"""Labels that look ahead in time, and values filled back from later rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.clock import duration_micros
from sluiceway.operators import slices


def label_ahead(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    label: str,
    lookback: str = "1 day",
    sources: Sequence[int] = (1, 2),
    targets: Sequence[int] = (0, 3),
    slice_width: str = "1 day",
) -> DataFrame:
    """Give the rows before an event the label of that event.

    A row whose label is in ``targets`` takes the label of the next strictly later row of its key with a
    label in ``sources``, when that row is at most ``lookback`` away. Of events at one time the smallest
    label counts. Times lie in the years 1685 to 2255, and there are at most 1024 sources.
    """
    sliced = slices.add_slice(df, time, slice_width)
    ranked = sorted(sources)
    # Time and rank of the label in one number, which Spark aggregates by hash; a struct would be sorted.
    code = F.coalesce(*[F.when(F.col(label) == s, F.lit(i)) for i, s in enumerate(ranked)])
    event = F.when(F.col(slices.TIME).isNotNull(), F.col(slices.TIME) * 1024 + code)
    summary = slices.summarise(sliced, keys, F.min(event).alias("_event"))
    later = slices.before_this(slices.over_slices(keys, newest_first=True))
    edges = summary.select(
        *keys,
        slices.SLICE,
        F.min("_event").over(later).alias("_event"),
        F.lit(slices.END_OF_TIME).cast("bigint").alias(slices.TIME),
    )

    rows = slices.with_edges(sliced.withColumn("_event", event), edges)
    # Newest first, so that the frame only grows; a range frame leaves out rows of the same time.
    strictly_later = (
        Window.partitionBy(*keys, slices.SLICE)
        .orderBy(F.desc(slices.TIME))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    upcoming = F.min("_event").over(strictly_later)
    near = F.shiftright("_next", 10) - duration_micros(lookback) <= F.col(slices.TIME)
    of_next = F.get(F.array(*[F.lit(s) for s in ranked]), F.col("_next").bitwiseAND(1023).cast("int"))
    relabelled = F.when(F.col(label).isin(*targets) & near, of_next.cast(df.schema[label].dataType)).otherwise(F.col(label))
    return slices.detail_only(
        rows.withColumn("_next", upcoming).withColumn(label, relabelled), df.columns
    )


def backfill(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    cols: Sequence[str],
    tiebreak: Sequence[str] = (),
    slice_width: str = "1 day",
    fallback: str = "last_known",
) -> DataFrame:
    """Fill nulls from the next later known value of the key.

    Nulls behind the last known value take that value (``fallback='last_known'``) or the value of the
    key's oldest row (``'oldest_row'``). A column without any known value stays null.
    """
    if fallback not in ("last_known", "oldest_row"):
        raise ValueError(f"fallback must be 'last_known' or 'oldest_row', not {fallback!r}")
    sliced = slices.add_slice(df, time, slice_width)
    order = slices.row_order(sliced, tiebreak)
    aggs = []
    for c in cols:
        when_known = F.when(F.col(c).isNotNull(), order)
        aggs.append(F.min_by(c, when_known).alias(f"_first_{c}"))
        if fallback == "last_known":
            aggs.append(F.max_by(c, when_known).alias(f"_last_{c}"))
        else:
            aggs.append(F.min_by(c, order).alias(f"_oldest_{c}"))
    summary = slices.summarise(sliced, keys, *aggs)

    later = slices.before_this(slices.over_slices(keys, newest_first=True))
    whole_key = slices.over_slices(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def inherited(c: str):
        if fallback == "last_known":
            final = F.last(f"_last_{c}", True).over(whole_key)
        else:
            final = F.first(f"_oldest_{c}").over(whole_key)
        return F.coalesce(F.last(f"_first_{c}", True).over(later), final).alias(c)

    edges = summary.select(*keys, slices.SLICE, *[inherited(c) for c in cols])
    rows = slices.with_edges(sliced, edges)
    from_later = slices.up_to_this(slices.in_slice(keys, tiebreak, newest_first=True))
    filled = rows.withColumns({c: F.last(c, True).over(from_later) for c in cols})
    return slices.detail_only(filled, df.columns)


def row_rank(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    name: str = "rank",
    tiebreak: Sequence[str] = (),
    slice_width: str = "1 day",
) -> DataFrame:
    """Number the rows of a key in time order, from 0."""
    sliced = slices.add_slice(df, time, slice_width)
    summary = slices.summarise(sliced, keys, F.count(F.lit(1)).alias("_rows"))
    earlier = slices.before_this(slices.over_slices(keys))
    edges = summary.select(
        *keys, slices.SLICE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_skip")
    )
    rows = slices.with_edges(sliced, edges)
    window = slices.in_slice(keys, tiebreak)
    # The edge row is row 1 of its slice.
    rank = F.first("_skip").over(slices.up_to_this(window)) + F.row_number().over(window) - 2
    return slices.detail_only(rows.withColumn(name, rank), [*df.columns, name])
