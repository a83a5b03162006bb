"""Hand-made messages, pages and change events."""

import json
import time
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.operators import changes, columns, html, records
from sluiceway.operators.html import Element, extract_html, page_records
from sluiceway.operators.joins import chain_left, drop_words, keep_keys, union_families
from sluiceway.operators.ranking import top_k_per, top_names, value_chunks
from sluiceway.operators.words import word_count
from sluiceway.plans.pages import comments, reviews
from sluiceway.plans.trades import trades
from sluiceway.sources.messages import read_messages
from sluiceway.sources.tables import read_raw_zone, read_xml, run_sql
from sluiceway.streaming.orders import order_metrics, parse_orders


def test_order_lines(spark):
    lines = [
        "2020-01-01 13:00:01,1,80,EPE,710,51.00,B",
        "2020-01-01 13:00:02, 2, 81, ABC, 10, 2.5, S",
        "20:25:28,3,80,EPE,710,51.00,B",
        "2020-01-01 13:00:01,4,80,EPE,710,51.00,X",
        "2020-01-01 13:00:01,5,80,EPE",
        "2020-01-01 13:00:01,6,80,EPE,many,51.00,B",
        "",
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    good, bad = parse_orders(df)
    assert [r["orderid"] for r in good.orderBy("orderid").collect()] == [1, 2]
    assert good.where("orderid = 2").first()["side"] == "S"
    assert sorted(r[0] for r in bad.collect()) == sorted(lines[2:])


def test_null_line_is_bad(spark):
    good, bad = parse_orders(spark.createDataFrame([(None,)], "value string"))
    assert (good.count(), bad.count()) == (0, 1)


def test_order_metrics(spark):
    lines = [f"2020-01-01 1{h}:00:00,{i},{c},{s},{a},2.0,{b}" for i, (h, c, s, a, b) in enumerate(
        [(0, 1, "OLD", 900, "B"), (2, 2, "X", 5, "S"), (2, 3, "Y", 7, "B"), (2, 2, "Y", 1, "B")]
    )]
    good, _ = parse_orders(spark.createDataFrame([(v,) for v in lines], "value string"))
    got = {r["metric"]: r["values"] for r in order_metrics(good).collect()}
    assert got == {"BUYS": ["3"], "SELLS": ["1"], "TOP5CLIENTS": ["1", "3", "2"], "TOP5STOCKS": ["Y", "X"]}


def test_json_messages(spark):
    df = spark.createDataFrame([(b'{"stock_price": 1.5, "timestamp": "2020-01-01 00:00:00.123456"}',), (b"no json",)], "value binary")
    got = records.parse_json(df, "value", "stock_price double, timestamp timestamp")
    assert [r[0] for r in got.collect()] == [1.5, None]
    assert str(got.first()[1]) == "2020-01-01 00:00:00.123456"


def test_json_list_in_base64url(spark):
    import base64

    text = base64.urlsafe_b64encode(json.dumps({"message": [{"number": 1}, {"number": 2}]}).encode()).decode()
    df = spark.createDataFrame([(text,)], "value string")
    assert rows(records.parse_json_list(df, "value", "message", "number int", "base64url")) == [(1,), (2,)]


def test_choice_and_mapping(spark):
    df = spark.createDataFrame([((1, None), "7"), ((None, 2.5), "x"), (None, None)], "c struct<int: int, double: double>, s string")
    assert [r[0] for r in columns.resolve_choice(df, ["c"]).collect()] == [1.0, 2.5, None]
    assert [r[0] for r in columns.apply_mapping(df, [("s", "n", "int")]).collect()] == [7, None, None]
    empty = df.withColumn("nothing", F.lit(None)).withColumn("part", F.struct(F.lit(None).alias("a"), F.lit(1).alias("b")))
    assert columns.drop_null_fields(empty).schema.simpleString().endswith("part:struct<b:int>>")
    with pytest.raises(ValueError):
        columns.lower_names(spark.range(1).selectExpr("id AS a", "id AS B", "id AS b2").toDF("a", "B", "b"))
    assert columns.strip_aggregate_names(spark.range(3).agg(F.max("id"))).columns == ["id"]


def test_words(spark):
    df = spark.createDataFrame([("Привет мир и мир hello  Мир7",)], "t string")
    stop = spark.createDataFrame([("И",)], "word string")
    assert rows(word_count(df, "t", stop)) == [("Привет", 1), ("мир", 2)]


def test_membership(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert rows(keep_keys(df, df.where("k = 'b'"), ["k"])) == [("b",), ("b",)]
    assert rows(drop_words(df, "k", spark.createDataFrame([("B",)], "word string"))) == [("a",), (None,)]


def test_left_chain_repeats_rows(spark):
    base = spark.createDataFrame([("a", 1, "x")], "k string, v int, year string")
    other = spark.createDataFrame([("a", 5, "y"), ("a", 6, "y")], "k string, w int, year string")
    assert rows(chain_left(base, [other], ["k"], ["year"])) == [("a", 1, "x", 5), ("a", 1, "x", 6)]
    assert rows(union_families({2: base, 3: base}).select("type")) == [(2,), (3,)]


def test_ranking(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 3), ("x", "c", 3), ("y", "d", 0)], "g string, n string, v int")
    assert rows(top_k_per(df, ["g"], "v", 2, "n").select("n", "rank")) == [("b", 1), ("c", 2), ("d", 1)]
    assert top_names(df, "v", "n", "TOP", 3).first()["values"] == ["b", "c", "a"]


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_value_chunks(spark, kind):
    values = [f"{i:05d}" for i in range(0, 5000, 7)] if kind == "string" else list(range(0, 50000, 70))
    df = spark.createDataFrame([(v,) for v in values + values[:50]] + [(None,)], f"v {kind}")
    got = {r[0]: r[1] for r in value_chunks(df, "v", 99).collect()}
    order = [None, *sorted(values)]
    assert got == {v: i // 99 for i, v in enumerate(order)}


def test_xml(spark, tmp_path):
    item = "<item><거래금액>  82,500</거래금액><년>2020</년><아파트>가</아파트></item>"
    document = f"<response><header/><body><items>{item}{item.replace('82,500', '1,000')}</items></body></response>"
    df = spark.createDataFrame([(document,)], "value string")
    assert rows(trades(df).select("price", "year", "apartment", "floor")) == [(1000, "2020", "가", None), (82500, "2020", "가", None)]
    (tmp_path / "feed.xml").write_text(document)
    assert read_xml(spark, str(tmp_path / "feed.xml"), "item", "`년` string").count() == 2


REVIEW_PAGE = """<html><div class="d15Mdf bAhLNe"><div><span class="X43Kjb">Kim &amp; Co</span>
<div role="img" aria-label="별표 5개 만점에 4개를 받았습니다."></div><span class="p2TkOb">2020년 9월 3일</span>
<div class="jUL89d y92BAb">12</div></div><span jsname="bN97Pc">short</span><span jsname="fbQN7e">long <b>text</b></span>
<div class="LVQB0b">thank<br>
you</div></div><div class="other"></div>
<div class="bAhLNe d15Mdf"><span class="X43Kjb">Lee</span><div role="img" aria-label="?"></div><span jsname="bN97Pc">only short</span>
<span jsname="fbQN7e"></span></div></html>"""


def test_reviews(spark):
    df = spark.createDataFrame([(1, REVIEW_PAGE), (2, "<html></html>"), (3, None)], "id int, html string")
    assert rows(reviews(df)) == [
        (1, "Kim & Co", 4, "2020-09-03", 12, "long text", "thank you"),
        (1, "Lee", None, None, 0, "only short", None),
    ]


def test_comments_and_broken_pages(spark):
    page = "<yt-formatted-string>a<i>b</i></yt-formatted-string><yt-formatted-string>unclosed"
    assert rows(comments(spark.createDataFrame([(page,)], "html string"))) == [("ab",), ("unclosed",)]
    nested = page_records("<div class='c'><div>x</div>y</div>z", Element("div", {"class": "c"}), {"t": Element("div")})
    assert nested == [{"t": "xy"}]
    image = Element("img")
    df = spark.createDataFrame([("<p><img src='a'><img src='b'></p>",)], "html string")
    assert rows(extract_html(df, "html", image, {"src": Element("img", read="src")})) == [("a",), ("b",)]


class Plain(HTMLParser):
    """The same records with a whole search at every tag: what the linear collector must equal."""

    def __init__(self, container, fields):
        super().__init__(convert_charrefs=True)
        self.container, self.fields, self.records, self.stack = container, fields, [], []

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        for at in range(len(self.stack) - 1, -1, -1):
            there = self.stack[at][0]
            if tag in html.ENDED_BY.get(there, ()):
                del self.stack[at:]
            elif there in html.HOLDS_ITS_OWN:
                break
        above = [(t, a) for t, a, _, _ in self.stack]

        def fits(wanted):
            left = list(wanted.within)
            for t, a in above:
                if left and left[0].matches(t, a):
                    left.pop(0)
            return not left and wanted.matches(tag, attrs)

        record = dict.fromkeys(self.fields) if fits(self.container) else None
        if record is not None:
            self.records.append(record)
        reading = []
        for r in [r for _, _, r, _ in [*self.stack, (tag, attrs, record, [])] if r is not None]:
            for name, wanted in self.fields.items():
                if r[name] is None and fits(wanted):
                    r[name] = attrs.get(wanted.read) if wanted.read != "text" else ""
                    if wanted.read == "text":
                        reading.append((r, name))
        if tag not in html.VOID:
            self.stack.append((tag, attrs, record, reading))

    def handle_data(self, data):
        for _, _, _, reading in self.stack:
            for r, name in reading:
                r[name] += data

    def handle_endtag(self, tag):
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                del self.stack[at:]
                return


_TAG = st.sampled_from(["div", "p", "li", "ul", "td", "tr", "table", "b", "br", "img", "dt", "dd"])
_TOKENS = st.one_of(
    st.builds("<{} class='{}' id='{}'>".format, _TAG, st.sampled_from(["c", "c d", "e", ""]), st.sampled_from("12")),
    st.builds("</{}>".format, _TAG),
    st.builds("<{}>".format, _TAG),
    st.sampled_from(["x", "y ", "&amp;"]),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(_TOKENS, max_size=40))
def test_html_equals_a_plain_search(tokens):
    page = "".join(tokens)
    inner = Element("b", within=(Element("div", {"class": "c"}), Element("p")))
    fields = {"all": Element("div"), "id": Element("p", read="id"), "item": Element("li", {"class": "c"}), "inner": inner, "img": Element("img")}
    for container in (Element("div", {"class": "c"}), Element("li"), Element("p", within=(Element("table"),)), Element("br")):
        plain = Plain(container, fields)
        plain.feed(page)
        plain.close()
        assert page_records(page, container, fields) == plain.records


@pytest.mark.parametrize("unit", ["<div>x", "<li>x", "<p>x<div>", "<div class='c'><b>x</b>", "</b>x<div>"])
def test_broken_pages_take_linear_time(unit):
    begun = time.process_time()
    fields = {"t": Element("b"), "u": Element("i"), "h": Element("div", read="href")}
    page_records(unit * 16_000, Element("div", {"class": "c"}), fields)
    assert time.process_time() - begun < 1.5


def envelope(op, key, name, ts, pos, before=None):
    row = {"id": key, "first_name": name}
    after = None if op == "d" else row
    return json.dumps({"schema": {}, "payload": {"before": before or (row if op == "d" else None), "after": after,
                                                 "source": {"pos": pos, "table": "t"}, "op": op, "ts_ms": ts}})


def test_changes(spark):
    messages = [
        envelope("c", 1, "a", 10, 1), envelope("u", 1, "b", 10, 2), envelope("c", 1, "a", 10, 1),
        envelope("c", 2, "x", 10, 3), envelope("d", 2, "x", 11, 4), envelope("r", 3, "snap", 5, 0), "tombstone", None,
        '{"payload": {"ddl": "DROP TABLE t"}}',
    ]
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    unwrapped = changes.unwrap_changes(df, "id int, first_name string")
    assert unwrapped.count() == 6
    assert rows(changes.latest_state(unwrapped, ["id"])) == [(1, "b"), (3, "snap")]
    assert rows(changes.schema_changes(df)) == [("DROP TABLE t",)]


def test_raw_zone(spark, tmp_path):
    for month in ("07", "08"):
        for day in ("01", "02"):
            spark.range(3).selectExpr("id AS Id").write.parquet(f"{tmp_path}/year-2021/month-{month}/day-{day}")
    df = read_raw_zone(spark, str(tmp_path), {"year": "2021", "month": "08", "day": "*"})
    assert df.columns == ["id", "year", "month", "day"]
    assert rows(df.select("year", "month", "day").distinct()) == [("2021", "08", "01"), ("2021", "08", "02")]
    assert df.count() == 6


def test_sql_with_frames_and_parameters(spark):
    df = spark.range(5)
    assert run_sql(spark, "SELECT id FROM {t} WHERE 1 = 1 AND id > :low", {"low": 2}, t=df).count() == 2


def test_bounded_messages(spark, tmp_path):
    (tmp_path / "m.txt").write_text("a\nb\n")
    df = read_messages(spark, "text", False, path=str(tmp_path))
    assert df.schema["value"].dataType.typeName() == "binary"
    assert rows(records.wrap_text(df)) == [("a",), ("b",)]


def test_pages_leave_arrow_a_few_at_a_time():
    pages = pa.array(["x" * 10, None, "y" * (html.STEP_BYTES + 1), "z"] + ["w"] * 600, pa.string())
    parts = list(html._steps(pages))
    assert pa.concat_arrays(parts).equals(pages)
    sizes = [sum(len(t or "") for t in p.to_pylist()) for p in parts]
    assert all(len(p) <= html.STEP and (size <= html.STEP_BYTES or len(p) == 1) for p, size in zip(parts, sizes))
    assert [len(p) for p in html._steps(pa.array([], pa.string()))] == [0]


def test_pages_of_many_steps(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 7 <> 0 THEN concat('<b>', id, '</b><b>', repeat('é', int(id % 50)), '</b>') END AS html").coalesce(1)
    got = html.extract_html(df, "html", html.Element("b"), {"t": html.Element("b")})
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    wanted = [(i, t) for i in range(3000) if i % 7 for t in (str(i), "é" * (i % 50))]
    assert sorted((r.id, r.t) for r in got.collect()) == sorted(wanted)
