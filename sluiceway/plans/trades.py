"""Property-trade feed: XML item lists to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import clean_number
from sluiceway.operators.records import xml_items

# Field names of the public feed, and our names.
TRADE_FIELDS = {
    "거래금액": "price",
    "건축년도": "build_year",
    "년": "year",
    "법정동": "dong",
    "아파트": "apartment",
    "월": "month",
    "일": "day",
    "전용면적": "area",
    "지번": "jibun",
    "지역코드": "code",
    "층": "floor",
}
ITEM_PATH = ("body", "items", "item")


def trades(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per trade; the price as a number, all other fields as text."""
    schema = ", ".join(f"`{name}` string" for name in TRADE_FIELDS)
    rows = xml_items(documents, column, schema, ITEM_PATH, TRADE_FIELDS)
    return rows.withColumn("price", clean_number(F.col("price")))
