"""Browser history with host, keyword and search term."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluiceway.functions.urls import search_term, url_domain, url_keyword


def analyse_history(history: DataFrame, url: str = "url") -> DataFrame:
    """Add ``domain``, ``keyword`` and ``search``; empty text where there is none."""
    parts = history.withColumns({"domain": url_domain(url), "keyword": url_keyword(url)})
    return parts.withColumn("search", search_term("keyword"))
