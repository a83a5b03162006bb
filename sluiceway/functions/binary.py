"""Device payload decoding: little-endian bytes, bit positions, packed pairs and code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INT32_LIMIT = 2**31


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(c: Column | str) -> Column:
    """A packed value as a number; six decimals keep fractions of text, and no integer is rounded."""
    return _col(c).try_cast("decimal(30,6)")


def decode_le(parts: Sequence[Column | str], bits32: bool = False) -> Column:
    """Join byte columns, lowest byte first, into one bigint.

    A byte outside 0..255, or text that is no number, makes the whole value null. ``bits32`` also nulls values that a signed
    32-bit integer cannot hold.
    """
    if len(parts) > 7:
        raise ValueError("at most seven bytes fit a bigint without a sign")
    columns = [_col(part).try_cast("bigint") for part in parts]
    total = seen = columns[0]
    for position, byte in enumerate(columns[1:], start=1):
        total = total.bitwiseOR(F.shiftleft(byte, 8 * position))
        seen = seen.bitwiseOR(byte)
    # All bytes are in range exactly when the union of their bits is.
    valid = seen.between(0, 255)
    if bits32 and len(columns) >= 4:
        valid = valid & (total < INT32_LIMIT)
    return F.when(valid, total)


def bits(value: Column | str, count: int, align: str = "left") -> list[Column]:
    """The first ``count`` binary digits of a value as 0/1 integers.

    ``left`` counts from the most significant set digit, so 5 gives 1,0,1,0,0,... ``positional`` pads
    to ``count`` digits first, so 5 in 8 digits gives 0,0,0,0,0,1,0,1. Missing digits and null are 0.
    """
    if align not in ("left", "positional"):
        raise ValueError(f"align must be 'left' or 'positional', not {align!r}")
    digits = F.bin(_col(value).try_cast("bigint"))
    if align == "positional":
        digits = F.lpad(digits, count, "0")
    return [F.when(F.substring(digits, i + 1, 1) == "1", 1).otherwise(0) for i in range(count)]


def with_bits(df, columns: dict[str, tuple[str, int]], align: str = "left"):
    """Replace each source column by its bit columns: ``{"tcprcmode": ("tcp", 7)}`` gives tcp0..tcp6."""
    new = {}
    for source, (prefix, count) in columns.items():
        for i, digit in enumerate(bits(source, count, align)):
            new[f"{prefix}{i}"] = digit
    return df.withColumns(new).drop(*columns)


def packed_bits(columns: dict[str, tuple[str, int]], align: str = "left") -> Column:
    """The digits that ``with_bits`` makes columns of, as the bits of one bigint: the first digit of the first column is bit 0."""
    if align not in ("left", "positional"):
        raise ValueError(f"align must be 'left' or 'positional', not {align!r}")
    if sum(count for _, count in columns.values()) > 63:
        raise ValueError("at most 63 digits fit a bigint without a sign")
    total, place = F.lit(0).cast("bigint"), 0
    for source, (_, count) in columns.items():
        digits = F.bin(_col(source).try_cast("bigint"))
        if align == "positional":
            digits = F.lpad(digits, count, "0")
        number = F.conv(F.reverse(F.substring(digits, 1, count)), 2, 10).cast("bigint")
        total = total.bitwiseOR(F.shiftleft(F.coalesce(number, F.lit(0)), place))
        place += count
    return total


def low_part(value: Column | str, base: int = 256) -> Column:
    """Remainder of a packed pair, as int; null for text that is no number."""
    return F.round(_number(value) % base).try_cast("int")


def high_part(value: Column | str, base: int = 256) -> Column:
    """Quotient of a packed pair, rounded half up (384 / 256 gives 2), as int; null for text that is no number."""
    return F.round(_number(value) / base).try_cast("int")


def array_pair(array: Column | str, index: int) -> tuple[Column, Column]:
    """(low, high) of item ``index``; both null when the array is shorter."""
    item = F.get(_col(array), F.lit(index))
    return low_part(item), high_part(item)


def bucket_ranges(value: Column | str, ranges: Sequence[tuple[float | None, float | None, int]]) -> Column:
    """Code of the first closed range that holds the value; null when none does.

    A ``None`` bound is open: ``[(None, 19, 0), (20, 30, 1)]``.
    """
    value = _col(value)
    result = None
    for low, high, code in ranges:
        if low is None:
            inside = value <= high
        elif high is None:
            inside = value >= low
        else:
            inside = value.between(low, high)
        result = F.when(inside, code) if result is None else result.when(inside, code)
    return result


def pair_label(low: Column | str, high: Column | str, codes: dict[tuple[int, int], int], other: int) -> Column:
    """Label of a (low, high) code pair; every other pair, null included, gets ``other``."""
    result = None
    for (low_code, high_code), label in codes.items():
        hit = (_col(low) == low_code) & (_col(high) == high_code)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return F.lit(other) if result is None else result.otherwise(other)


def code_of(value: Column | str, codes: dict[str, str], other: str | None = None) -> Column:
    """CASE lookup of a text value in a small literal table."""
    result = None
    for text, code in codes.items():
        hit = _col(value) == text
        result = F.when(hit, code) if result is None else result.when(hit, code)
    return F.lit(other) if result is None else result.otherwise(F.lit(other))
