"""Ranges of equal depth: predicates that cut a table into parts with about the same number of rows."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Range:
    """Rows with low < value <= high; without a bound the range is open. ``inside`` cuts one heavy value by a second column.

    ``cut`` is the quantile that the range lies up to; that of a range in front of a heavy value is the heavy value.
    """

    column: str
    low: object = None
    high: object = None
    inside: Range | None = None
    nulls: bool = False
    cut: object = field(default=None, compare=False)

    def sql(self) -> str:
        """The range as a predicate that databases understand."""
        if self.inside is not None:
            return f"{self.column} = {_literal(self.high)} AND ({self.inside.sql()})"
        parts = [f"{self.column} > {_literal(self.low)}"] if self.low is not None else []
        parts += [f"{self.column} <= {_literal(self.high)}"] if self.high is not None else []
        text = " AND ".join(parts) or f"{self.column} IS NOT NULL"
        return f"{text} OR {self.column} IS NULL" if self.nulls else text

    def matches(self) -> Column:
        return F.coalesce(F.expr(self.sql()), F.lit(False))


def _literal(value: object) -> str:
    if isinstance(value, bool | int | float) or value.__class__.__name__ == "Decimal":
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def depth_ranges(df: DataFrame, column: str, n: int, second: str | None = None, accuracy: int = 10_000) -> list[Range]:
    """About ``n`` ranges of a number, date or time column that hold about the same number of rows, whatever its distribution.

    The cuts are quantiles of a sketch that every task fills and that merges; they are off by rows / ``accuracy``. A value that
    several neighbouring cuts fall on holds more than its share. It becomes a range of its own, and with ``second``, it is cut
    again by the quantiles of that column. Rows without a value go to the first range. Each row matches exactly one range.
    """
    if n < 1:
        raise ValueError("at least one range")
    kind = df.schema[column].dataType
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    cuts = (df.agg(F.percentile_approx(_number(column, kind), shares, accuracy)).first()[0] if n > 1 else []) or []
    cuts = [_value(c, kind) for c in cuts]
    ranges: list[Range] = []
    low, at = None, 0
    while at < len(cuts):
        times = cuts.count(cuts[at])
        heavy = times > 1
        if heavy and (low is None or low != cuts[at]):
            # What lies between the cut before and the heavy value is a range without it.
            below = _value(_before(cuts[at]), kind)
            if low is None or below > low:
                ranges.append(Range(column, low, below, cut=cuts[at]))
                low = below
        if heavy and second is not None:
            mine = df.where(F.col(column) == F.lit(cuts[at]))
            ranges += [Range(column, None, cuts[at], r, cut=cuts[at]) for r in depth_ranges(mine, second, times, None, accuracy)]
        else:
            ranges.append(Range(column, low, cuts[at], cut=cuts[at]))
        low = cuts[at]
        at += times
    ranges.append(Range(column, low, None))
    first = ranges[0]
    if first.inside is None:
        ranges[0] = replace(first, nulls=True)
        return ranges
    return [Range(column, None, _value(_before(first.high), kind), None, True, first.cut), *ranges]


def _number(column: str, kind) -> Column:
    name = kind.simpleString()
    if name == "date":
        return F.unix_date(column)
    if name.startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column)


def _before(value):
    """The largest value of the type below a value."""
    import datetime as dt
    import math
    from decimal import Decimal

    if isinstance(value, dt.datetime):
        return value - dt.timedelta(microseconds=1)
    if isinstance(value, dt.date):
        return value - dt.timedelta(days=1)
    if isinstance(value, Decimal):
        return value.next_minus()
    return math.nextafter(value, -math.inf) if isinstance(value, float) else value - 1


def _value(number, kind):
    import datetime as dt

    if isinstance(number, dt.date):
        return number
    name = kind.simpleString()
    if name == "date":
        return dt.date(1970, 1, 1) + dt.timedelta(days=int(number))
    if name.startswith("timestamp"):
        return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(number))
    return number


def in_ranges(df: DataFrame, ranges: list[Range], name: str = "range") -> DataFrame:
    """Add the number of the range that a row lies in."""
    number = F.coalesce(*[F.when(r.matches(), F.lit(i)) for i, r in enumerate(ranges)])
    return df.withColumn(name, number)
