"""Browser-history analysis: host part, path keyword and search term of a url."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Host endings, in the order in which a later match replaces an earlier one.
HOST_SUFFIXES = (".com", ".kr", ".net", ".art", ".wiki", ".tv", ".gg", ".org", ".me", ".io", ".top")

# Fixed values: (text that marks a search, length skipped after its start, texts that may end the term).
# The first marker that occurs decides. A skip of None means "behind the longer form `search?q=`".
SEARCH_MARKERS = (
    ("search?query=", 13, ("&",)),
    ("search?q", None, ("&",)),
    ("search_query", 12, ("&",)),
    ("query", 5, ("&",)),
    ("&q", 3, ("&oq", "&ie")),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_domain(url: Column | str, suffixes: Sequence[str] = HOST_SUFFIXES) -> Column:
    """Text up to the first occurrence of a suffix, suffix included; the last listed suffix present wins."""
    url = _col(url)
    result = F.lit("")
    for suffix in suffixes:
        found = F.instr(url, suffix) > 0
        result = F.when(found, F.concat(F.substring_index(url, suffix, 1), F.lit(suffix))).otherwise(result)
    return result


def url_keyword(url: Column | str, suffixes: Sequence[str] = HOST_SUFFIXES) -> Column:
    """Text between the first and second occurrence of a suffix, when longer than one character.

    Each later listed suffix that qualifies replaces the earlier result.
    """
    url = _col(url)
    result = F.lit("")
    for suffix in suffixes:
        found = F.instr(url, suffix)
        rest = F.substring_index(F.substring(url, found + len(suffix), F.length(url)), suffix, 1)
        result = F.when((found > 0) & (F.length(rest) > 1), rest).otherwise(result)
    return result


def percent_decode(text: Column | str) -> Column:
    """Percent-decoded text; a malformed escape stays as it is. A plus sign becomes a blank."""
    return F.try_url_decode(F.regexp_replace(_col(text), "%(?![0-9A-Fa-f]{2})", "%25"))


def search_term(keyword: Column | str) -> Column:
    """Search words in a path keyword, by the first marker of ``SEARCH_MARKERS`` that occurs.

    The term runs to the first end text anywhere in the keyword, so an ``&`` before the marker gives an
    empty term. Without any marker the term is empty.
    """
    text = percent_decode(keyword)
    result = F.lit("")
    for marker, skip, ends in reversed(SEARCH_MARKERS):
        at = F.instr(text, marker)
        if skip is None:
            full = F.instr(text, f"{marker}=")
            start = F.when(full > 0, full + len(marker) + 1).otherwise(F.lit(len(marker) + 1))
        else:
            start = at + skip
        end = F.length(text) + 1
        for stop in reversed(ends):
            end = F.when(F.instr(text, stop) > 0, F.instr(text, stop)).otherwise(end)
        term = F.when(end > start, F.substring(text, start, end - start)).otherwise("")
        result = F.when(at > 0, F.translate(term, "+", " ")).otherwise(result)
    return F.coalesce(result, F.lit(""))


def query_parameter(url: Column | str, name: str) -> Column:
    """A named query parameter, percent-decoded, for well-formed urls; null when absent or malformed."""
    raw = F.try_parse_url(_col(url), F.lit("QUERY"), F.lit(name))
    return percent_decode(raw)
