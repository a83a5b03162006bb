"""Date and time functions, and the run-month parameter of the batch jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000


def previous_month(run_date: dt.date) -> tuple[str, str]:
    """(year, month) strings of the month before the run date; January gives December of the year before."""
    last = run_date.replace(day=1) - dt.timedelta(days=1)
    return f"{last.year:04d}", f"{last.month:02d}"


def epoch_ms(c: Column | str) -> Column:
    """Epoch milliseconds to timestamp, cut to whole seconds; null for text that is no number."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_seconds(F.floor(c.try_cast("bigint") / 1000).cast("bigint"))


def text_time(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp; null when the text does not match."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(pattern))


def month_date(c: Column | str, pattern: str = "yyyy-MM") -> Column:
    """Year-month text to the first date of the month; null when the text does not match."""
    return text_time(c, pattern).cast("date")


def korean_date(c: Column | str) -> Column:
    """Dates such as ``2020년 9월 3일`` to ``2020-09-03``."""
    return F.date_format(text_time(c, "yyyy'년' M'월' d'일'"), "yyyy-MM-dd")


def path_value(c: Column | str) -> Column:
    """Value of a path part: ``year-2021`` gives ``2021``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.get(F.split(c, "-"), F.lit(1))


def micros(df: DataFrame, column: str) -> Column:
    """A time column as bigint microseconds, whatever its type.

    Integers are epoch milliseconds; text and dates are converted as the session's time zone reads them.
    """
    kind = df.schema[column].dataType.typeName()
    if kind in _INTEGERS:
        return F.col(column).cast("bigint") * 1000
    if kind == "string":
        return F.unix_micros(F.try_to_timestamp(column))
    return F.unix_micros(F.col(column).cast("timestamp"))


# Larger than the span of bigint, so that the second number never carries into the first.
_ORDER_STEP = "20000000000000000000BD"
_EARLIEST = -(2**62)
_INTEGERS = ("long", "integer", "short", "byte")


def order_value(df: DataFrame, time: Column, tiebreak: Sequence[str]) -> Column:
    """Sort value of a row for ``min_by`` and ``max_by``: a bigint time, then the tie-break columns.

    Nulls come first. Time alone stays a bigint, and with one integer tie-break column both go into one
    decimal, because only number buffers let Spark aggregate by hash; a struct, needed for other
    tie-breaks, means sorting every row before the shuffle.
    """
    known = F.coalesce(time, F.lit(_EARLIEST))
    if not tiebreak:
        return known
    if len(tiebreak) == 1 and df.schema[tiebreak[0]].dataType.typeName() in _INTEGERS:
        step = known.cast("decimal(19,0)") * F.expr(_ORDER_STEP)
        tie = F.coalesce(F.col(tiebreak[0]).cast("bigint"), F.lit(-(2**63)))
        return (step + tie.cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.struct(known, *[F.col(c) for c in tiebreak])


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def duration_micros(text: str) -> int:
    """``'10 minutes'`` or ``'1 day 6 hours'`` as microseconds."""
    words = text.lower().split()
    total = 0
    for amount, unit in zip(words[::2], words[1::2], strict=True):
        total += int(amount) * _UNITS[unit.rstrip("s")] * MICROS
    return total
