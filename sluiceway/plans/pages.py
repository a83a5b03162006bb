"""Saved web pages: reviews, comments, titles and links as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.clock import korean_date
from sluiceway.functions.text import blank_to, one_line, rating
from sluiceway.operators.html import Element, extract_html

# Class and attribute names of the store's review pages, and of the comment pages.
REVIEW = Element("div", {"class": "d15Mdf bAhLNe"})
REVIEW_FIELDS = {
    "name": Element(None, {"class": "X43Kjb"}),
    "stars": Element("div", {"role": "img"}, "aria-label"),
    "day": Element(None, {"class": "p2TkOb"}),
    "helpful": Element(None, {"class": "jUL89d y92BAb"}),
    "full_text": Element("span", {"jsname": "fbQN7e"}),
    "short_text": Element("span", {"jsname": "bN97Pc"}),
    "reply": Element("div", {"class": "LVQB0b"}),
}
COMMENT = Element("yt-formatted-string")


def reviews(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per review: name, ratings, date, helpful, comment, developer_comment."""
    found = extract_html(pages, html, REVIEW, REVIEW_FIELDS)
    kept = [c for c in pages.columns if c != html]
    return found.select(
        *kept,
        "name",
        rating("stars").alias("ratings"),
        korean_date("day").alias("date"),
        blank_to("helpful", "0").try_cast("int").alias("helpful"),
        blank_to("full_text", F.col("short_text")).alias("comment"),
        one_line("reply").alias("developer_comment"),
    )


def comments(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per comment text."""
    return extract_html(pages, html, COMMENT, {"comment": COMMENT})


def titles(pages: DataFrame, html: str = "html") -> DataFrame:
    title = Element("title")
    return extract_html(pages, html, title, {"title": title})


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    anchor = Element("a")
    return extract_html(pages, html, anchor, {"href": Element("a", read="href"), "label": anchor})
