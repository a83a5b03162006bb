"""Cumulative device counters: repair of outliers and differences between readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.operators import slices

_PREVIOUS, _KNOWN = "_previous_", "_known"


def _with_previous(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    time: str,
    tiebreak: Sequence[str],
    slice_width: str,
    known_range: bool,
) -> DataFrame:
    """Attach the previous reading of the key, and on request its first and last known values."""
    sliced = slices.add_slice(df, time, slice_width)
    order = slices.row_order(sliced, tiebreak)
    aggs = [F.max_by(c, order).alias(f"_newest_{c}") for c in cols]
    if known_range:
        for c in cols:
            when_known = F.when(F.col(c).isNotNull(), order)
            aggs.append(F.min_by(c, when_known).alias(f"_first_{c}"))
            aggs.append(F.max_by(c, when_known).alias(f"_last_{c}"))
    summary = slices.summarise(sliced, keys, *aggs)

    in_time = slices.over_slices(keys)
    edge = {c: F.lag(f"_newest_{c}").over(in_time) for c in cols}
    if known_range:
        whole_key = in_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        edge[_KNOWN] = F.struct(
            *[F.first(f"_first_{c}", True).over(whole_key).alias(f"first_{c}") for c in cols],
            *[F.last(f"_last_{c}", True).over(whole_key).alias(f"last_{c}") for c in cols],
        )
    edges = summary.withColumns(edge).select(*keys, slices.SLICE, *edge)

    rows = slices.with_edges(sliced, edges)
    window = slices.in_slice(keys, tiebreak)
    found = {f"{_PREVIOUS}{c}": F.lag(c).over(window) for c in cols}
    if known_range:
        found[_KNOWN] = F.first(_KNOWN).over(slices.up_to_this(window))
    return rows.withColumns(found).where(F.col(slices.EDGE) == 1)


def repair_counter(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    time: str,
    tiebreak: Sequence[str] = (),
    slice_width: str = "1 day",
) -> DataFrame:
    """Replace readings outside the range of the key's first and last known value.

    A counter only grows, so a reading above the last or below the first known value of its key (device
    and month, say) is an outlier. It becomes the previous raw reading of the key, null on the first row.
    Equal times are ordered by ``tiebreak``.
    """
    rows = _with_previous(df, cols, keys, time, tiebreak, slice_width, known_range=True)

    def repaired(c: str) -> Column:
        known = F.col(_KNOWN)
        outside = (F.col(c) > known[f"last_{c}"]) | (F.col(c) < known[f"first_{c}"])
        return F.when(outside, F.col(f"{_PREVIOUS}{c}")).otherwise(F.col(c))

    return rows.select(*[repaired(c).alias(c) if c in cols else c for c in df.columns])


def counter_diff(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    time: str,
    tiebreak: Sequence[str] = (),
    slice_width: str = "1 day",
    keep_slice: bool = False,
) -> DataFrame:
    """Replace counters by the growth since the previous reading of the key.

    The first row of a key, and a row next to an unknown reading, keeps the raw value. With ``keep_slice`` the number of
    the slice stays as a column: rows of one key and slice lie in one task, so grouping by both needs no further shuffle.
    """
    rows = _with_previous(df, cols, keys, time, tiebreak, slice_width, known_range=False)

    def growth(c: str) -> Column:
        return F.coalesce(F.col(c) - F.col(f"{_PREVIOUS}{c}"), F.col(c))

    return rows.select(*[growth(c).alias(c) if c in cols else c for c in df.columns], *([slices.SLICE] if keep_slice else []))
