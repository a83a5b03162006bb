"""Text clean-up, message encodings and pattern capture."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utf8(c: Column | str) -> Column:
    """Bytes to text."""
    return F.decode(_col(c), "UTF-8")


def from_base64url(c: Column | str) -> Column:
    """URL-safe base64 text to bytes."""
    return F.unbase64(F.translate(_col(c).cast("string"), "-_", "+/"))


def to_base64url(c: Column | str) -> Column:
    """Text or bytes to URL-safe base64 text, without the line breaks that Spark puts in."""
    return F.translate(F.base64(_col(c).cast("binary")), "+/\r\n", "-_")


def clean_number(c: Column | str, to: str = "bigint") -> Column:
    """Number text with thousands commas; null when it is no number."""
    return F.trim(F.replace(_col(c), F.lit(","), F.lit(""))).try_cast(to)


# Fixed value: the sentence of a star rating in the Korean store pages.
RATING_PATTERN = "만점에 ([0-9]+)개"


def rating(c: Column | str, pattern: str = RATING_PATTERN) -> Column:
    """Number of stars in a rating sentence; null when there is none."""
    return F.regexp_extract(_col(c), pattern, 1).try_cast("int")


def one_line(c: Column | str) -> Column:
    """Line breaks to blanks."""
    return F.replace(_col(c), F.lit("\n"), F.lit(" "))


def blank_to(c: Column | str, default: Column | str | int) -> Column:
    """The text, or a default when it is empty or null."""
    default = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(_col(c), F.lit("")), default)


def joined(c: Column | str, separator: str = ",") -> Column:
    """Array to separated text."""
    return F.concat_ws(separator, _col(c))


def tokens(c: Column | str, separator: str = " ") -> Column:
    """Split on a literal separator."""
    plain = all(ch.isalnum() or ch in " ,;:=/-_&\t" for ch in separator)
    return F.split(_col(c), separator if plain else f"\\Q{separator}\\E")


# The named patterns that a capture template may use.
CAPTURE_PATTERNS = {
    "WORD": r"\b\w+\b",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "INT": r"[+-]?[0-9]+",
    "NUMBER": r"[+-]?[0-9]+(?:\.[0-9]+)?",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
}

_FIELD = re.compile(r"%\{(\w+)(?::(\w+))?\}")


def capture_pattern(template: str) -> tuple[str, list[str]]:
    """A template such as ``%{WORD:host} took %{INT:ms} ms`` as a regular expression with a group per named field, and the names."""
    names: list[str] = []

    def group(match: re.Match) -> str:
        body = CAPTURE_PATTERNS[match.group(1)]
        if match.group(2) is None:
            return f"(?:{body})"
        names.append(match.group(2))
        return f"({body})"

    pattern = _FIELD.sub(group, template)
    if re.compile(pattern).groups != len(names):
        raise ValueError("write (?:...) for groups outside the named fields")
    return pattern, names


def capture_fields(df: DataFrame, column: str, template: str) -> DataFrame:
    """Add one text column per named field of a template such as ``%{WORD:host} took %{INT:ms} ms``.

    Text around the fields is a regular expression without capture groups of its own (use ``(?:...)``).
    A line that does not match gives null in every field.
    """
    pattern, names = capture_pattern(template)
    matched = F.col(column).rlike(pattern)
    return df.withColumns(
        {name: F.when(matched, F.regexp_extract(column, pattern, i + 1)) for i, name in enumerate(names)}
    )
