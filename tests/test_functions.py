"""Hand-computed rows for the column functions."""

import datetime as dt

import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.functions import binary, clock, text, urls
from sluiceway.plans.mart import ERROR_LABELS, OTHER_ERROR
from sluiceway.plans.telemetry import STATE_RANGES


def one(spark, column, value, ddl):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(column).first()[0]


@pytest.mark.parametrize(
    ("parts", "free", "bits32"),
    [
        ((1, 0, 0, 0), 1, 1),
        ((0, 1, 0, 0), 256, 256),
        ((255, 255, 255, 127), 2147483647, 2147483647),
        ((0, 0, 0, 128), 2147483648, None),
        ((300, 0, 0, 0), None, None),
        ((0, -1, 0, 0), None, None),
        ((0, None, 0, 0), None, None),
    ],
)
def test_little_endian(spark, parts, free, bits32):
    df = spark.createDataFrame([parts], "a int, b int, c int, d int")
    names = ["a", "b", "c", "d"]
    assert tuple(df.select(binary.decode_le(names), binary.decode_le(names, bits32=True)).first()) == (free, bits32)


@pytest.mark.parametrize(
    ("value", "align", "digits"),
    [
        (5, "left", [1, 0, 1, 0, 0, 0, 0, 0]),
        (5, "positional", [0, 0, 0, 0, 0, 1, 0, 1]),
        (0, "left", [0] * 8),
        (255, "left", [1] * 8),
        (None, "left", [0] * 8),
        (None, "positional", [0] * 8),
    ],
)
def test_bits(spark, value, align, digits):
    assert one(spark, F.array(*binary.bits("v", 8, align)), value, "int") == digits


def test_bits_rejects_other_alignment():
    with pytest.raises(ValueError):
        binary.bits("v", 8, "right")


def test_packed_pair(spark):
    df = spark.createDataFrame([([259, 259, 384],)], "a array<int>")
    got = df.select(*binary.array_pair("a", 0), *binary.array_pair("a", 2), *binary.array_pair("a", 9)).first()
    assert tuple(got) == (3, 1, 128, 2, None, None)


def test_state_ranges(spark):
    golden = {19: 0, 20: 1, 30: 1, 31: 2, 45: 2, 46: None, 50: None, 51: 3, 59: 3, 60: 4, 79: 4, 80: None, None: None}
    df = spark.createDataFrame([(v,) for v in golden], "v int")
    got = {r[0]: r[1] for r in df.select("v", binary.bucket_ranges("v", STATE_RANGES)).collect()}
    assert got == golden


def test_error_labels(spark):
    df = spark.createDataFrame([(3, 0), (12, 0), (3, 1), (None, None)], "lo int, hi int")
    got = [r[0] for r in df.select(binary.pair_label("lo", "hi", ERROR_LABELS, OTHER_ERROR)).collect()]
    assert got == [1, 2, 3, 3]


@pytest.mark.parametrize(
    ("day", "expected"),
    [
        (dt.date(2021, 9, 15), ("2021", "08")),
        (dt.date(2021, 1, 31), ("2020", "12")),
        (dt.date(2021, 2, 1), ("2021", "01")),
        (dt.date(2024, 3, 31), ("2024", "02")),
    ],
)
def test_previous_month(day, expected):
    assert clock.previous_month(day) == expected


def test_times(spark):
    assert str(one(spark, clock.epoch_ms("v"), 1704067207999, "bigint")) == "2024-01-01 00:00:07"
    assert one(spark, clock.korean_date("v"), "2020년 9월 3일", "string") == "2020-09-03"
    assert one(spark, clock.korean_date("v"), "gestern", "string") is None
    assert one(spark, clock.month_date("v"), "2021-08", "string") == dt.date(2021, 8, 1)
    assert one(spark, clock.text_time("v"), "2020-01-01 13:00:01", "string") == dt.datetime(2020, 1, 1, 13, 0, 1)
    assert one(spark, clock.path_value("v"), "year-2021", "string") == "2021"
    assert clock.duration_micros("1 day 6 hours") == 30 * 3600 * 1_000_000


def test_text(spark):
    assert one(spark, text.clean_number("v"), "  82,500", "string") == 82500
    assert one(spark, text.clean_number("v"), "n/a", "string") is None
    assert one(spark, text.rating("v"), "별표 5개 만점에 4개를 받았습니다.", "string") == 4
    assert one(spark, text.rating("v"), "no stars", "string") is None
    assert one(spark, text.one_line("v"), "a\nb", "string") == "a b"
    assert one(spark, text.blank_to("v", "0"), "", "string") == "0"
    assert one(spark, text.tokens("v", "."), "a.b", "string") == ["a", "b"]
    assert one(spark, text.joined("v"), ["a", "b"], "array<string>") == "a,b"


def test_capture_fields(spark):
    df = spark.createDataFrame([("drop table db1.t2;",), ("select 1",)], "line string")
    got = text.capture_fields(df, "line", r"drop\s+table\s+(?:if\s+exists\s+)?%{WORD:db}\.%{WORD:name}")
    assert rows(got.select("db", "name")) == [("db1", "t2"), (None, None)]
    with pytest.raises(ValueError):
        text.capture_fields(df, "line", r"(a)%{WORD:x}")


# Url, host, keyword, search term.
HISTORY = [
    ("https://www.a.com/search?q=red+shoes&x=1", "https://www.a.com", "/search?q=red+shoes&x=1", "red shoes"),
    ("https://b.net/search?query=%EB%82%A0%EC%94%A8", "https://b.net", "/search?query=%EB%82%A0%EC%94%A8", "날씨"),
    ("https://c.io/", "https://c.io", "", ""),
    ("https://d.co.kr/a.com/b", "https://d.co.kr", "/a.com/b", ""),
    ("https://y.com/results?search_query=cat+video", "https://y.com", "/results?search_query=cat+video", "=cat video"),
    ("https://e.org/x?query=abc&z=1", "https://e.org", "/x?query=abc&z=1", "=abc"),
    ("https://g.com/url?sa=t&q=hello+w&oq=he&ie=UTF", "https://g.com", "/url?sa=t&q=hello+w&oq=he&ie=UTF", "hello w"),
    ("https://g.com/url?sa=t&q=hello&ie=U", "https://g.com", "/url?sa=t&q=hello&ie=U", "hello"),
    ("https://g.com/url?sa=t&q=last", "https://g.com", "/url?sa=t&q=last", "last"),
    ("https://h.com/p%zz?query=1", "https://h.com", "/p%zz?query=1", "=1"),
    ("https://h.com/p%zz?query=a%20b", "https://h.com", "/p%zz?query=a%20b", "=a b"),
    ("https://i.com/a.com/c", "https://i.com", "/a", ""),
    ("https://j.com/x&y/search?q=k%2Bl", "https://j.com", "/x&y/search?q=k%2Bl", ""),
    ("nohost", "", "", ""),
    (None, "", "", ""),
]


@pytest.mark.parametrize("golden", HISTORY, ids=lambda g: str(g[0]))
def test_history(spark, golden):
    from sluiceway.plans.history import analyse_history

    df = spark.createDataFrame([(golden[0],)], "url string")
    assert tuple(analyse_history(df).select("url", "domain", "keyword", "search").first()) == golden


def test_query_parameter(spark):
    assert one(spark, urls.query_parameter("v", "q"), "https://a.com/x?q=a%20b&c=1", "string") == "a b"
    assert one(spark, urls.query_parameter("v", "z"), "https://a.com/x?q=1", "string") is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 255), st.integers(0, 255)), min_size=1, max_size=30))
def test_two_byte_words_against_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r[0] for r in df.select(binary.decode_le(["a", "b"])).collect()]
    assert got == [int.from_bytes(bytes(p), "little") for p in pairs]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=120), min_size=1, max_size=10))
def test_base64url_against_python(spark, texts):
    import base64

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    coded = df.select(text.to_base64url("t").alias("c"))
    assert [r[0] for r in coded.collect()] == [base64.urlsafe_b64encode(t.encode()).decode() for t in texts]
    assert [r[0] for r in coded.select(text.utf8(text.from_base64url("c"))).collect()] == texts
