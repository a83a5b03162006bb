"""Registered queries over text, messages, pages and change events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.clock import korean_date, month_date
from sluiceway.functions.text import capture_fields, clean_number, from_base64url, joined, rating, to_base64url, utf8
from sluiceway.operators import changes
from sluiceway.operators.columns import fan_out
from sluiceway.operators.html import Element, extract_html
from sluiceway.operators.records import json_field, parse_json, parse_json_list, to_json_lines, to_messages, wrap_text
from sluiceway.operators.words import word_count
from sluiceway.plans import pages as page_jobs
from sluiceway.plans.history import analyse_history
from sluiceway.plans.registry import query, table, table_path
from sluiceway.plans.trades import TRADE_FIELDS, trades
from sluiceway.session import shared_folder
from sluiceway.sources.messages import read_folder_stream
from sluiceway.sources.tables import with_position
from sluiceway.streaming import batches
from sluiceway.streaming.changes import read_latest_state, start_latest_changes
from sluiceway.streaming.words import keep_word_counts, read_word_counts

# Short function words of the four languages in ``documents``.
STOP_WORDS = "the of and to in a is it that for der die das und ist ein le la les de des et que el los en y un una".split()
LATIN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"

_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_WORDS_SQL = f"""
    WITH w AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    SELECT word, count(*) AS n FROM w WHERE regexp_full_match(word, '{LATIN}') AND lower(word) NOT IN ({_STOP_SQL}) GROUP BY 1"""


def stop_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")


@query(_WORDS_SQL)
def word_count_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT6-7, AGG13, SCL26-27, JN6: words of whole texts, without stop words."""
    return word_count(table(spark, sf_dir, "documents"), "text", stop_words(spark), LATIN)


@query(_WORDS_SQL)
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3, STR5, SRT3: the same counts as the state of a stream."""
    folder = shared_folder(spark, "word-count")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    messages = read_folder_stream(spark, table_path(sf_dir, "documents"), schema)
    keep_word_counts(messages, "text", f"{folder}/counts", f"{folder}/checkpoint", LATIN, None).awaitTermination()
    return read_word_counts(spark, f"{folder}/counts", stop_words(spark))


@query(f"SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS position FROM ({_WORDS_SQL})")
def stream_word_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3, SRT3: where each word stands in the stored report, most frequent word first."""
    folder = shared_folder(spark, "word-order")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    messages = read_folder_stream(spark, table_path(sf_dir, "documents"), schema)
    keep_word_counts(messages, "text", f"{folder}/counts", f"{folder}/checkpoint", LATIN, None).awaitTermination()
    read_word_counts(spark, f"{folder}/counts", stop_words(spark)).write.parquet(f"{folder}/report")
    return with_position(spark, f"{folder}/report").select("word", "n", "position")


def sensor_messages(events: DataFrame) -> DataFrame:
    data = F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("user_id").cast("double").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"),
        F.col("value").alias("temperature"),
    )
    return events.select(F.to_json(F.struct(F.col("event_type").alias("tags"), data.alias("data"))).cast("binary").alias("value"))


SENSOR_SCHEMA = "tags string, data struct<timestamp: bigint, x: double, y: double, temperature: double>"


def sensor_routes(messages: DataFrame) -> dict[str, DataFrame]:
    return fan_out(
        parse_json(messages, "value", SENSOR_SCHEMA),
        {
            "position": ["tags", "data.x", "data.y"],
            "temperature": ["tags", "data.timestamp", "data.temperature"],
        },
    )


_K = "CAST(json_extract(props, '$.k') AS DOUBLE)"


@query(f"SELECT event_type AS tags, CAST(user_id AS DOUBLE) AS x, {_K} AS y FROM events")
def json_route_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL20, SCL22, PRJ12-13: first projection of a parsed message."""
    return sensor_routes(sensor_messages(table(spark, sf_dir, "events")))["position"]


_TEMPERATURES = "SELECT event_type AS tags, epoch_us(ts) // 1000000 AS \"timestamp\", value AS temperature FROM events"


@query(_TEMPERATURES)
def json_route_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL22, PRJ13: second projection of the same message."""
    return sensor_routes(sensor_messages(table(spark, sf_dir, "events")))["temperature"]


@query(
    f"""
    SELECT 'temperature' AS output, event_type AS tags, NULL::DOUBLE AS x, NULL::DOUBLE AS y, epoch_us(ts) // 1000000 AS "timestamp", value AS temperature FROM events
    UNION ALL SELECT 'position', event_type, CAST(user_id AS DOUBLE), {_K}, NULL, NULL FROM events"""
)
def stream_message_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR9-10, PRJ13, SRC14: a stream fans out to two tables; the code is that of the batch job."""
    folder = shared_folder(spark, "sensor-tables")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    events = read_folder_stream(spark, table_path(sf_dir, "events"), schema)
    parsed = parse_json(sensor_messages(events), "value", SENSOR_SCHEMA)
    outputs = {
        "position": (["tags", "data.x", "data.y"], batches.to_folder(f"{folder}/position")),
        "temperature": (["tags", "data.timestamp", "data.temperature"], batches.to_folder(f"{folder}/temperature")),
    }
    batches.start(parsed, f"{folder}/checkpoint", batches.fan_out_to(outputs), interval=None).awaitTermination()
    written = [spark.read.parquet(f"{folder}/{name}").drop("batch").withColumn("output", F.lit(name)) for name in outputs]
    return written[0].unionByName(written[1], allowMissingColumns=True)


@query("SELECT user_id AS number, CAST(length(event_type) AS INTEGER) AS option FROM events UNION ALL SELECT event_id, 0 FROM events")
def json_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL21-22: base64url messages with an array of objects."""
    first = F.struct(F.col("user_id").alias("number"), F.length("event_type").alias("option"))
    second = F.struct(F.col("event_id").alias("number"), F.lit(0).alias("option"))
    body = F.to_json(F.struct(F.array(first, second).alias("message")))
    messages = table(spark, sf_dir, "events").select(to_base64url(body).alias("value"))
    return parse_json_list(messages, "value", "message", "number bigint, option int", "base64url")


@query(
    """
    SELECT conv_id, turn, translate(to_base64(encode(text)), '+/', '-_') AS coded, text FROM conversations"""
)
def base64url_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL20-21: text to URL-safe base64 and back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", to_base64url("text").alias("coded"))
    return rows.withColumn("text", utf8(from_base64url("coded")))


@query("SELECT text AS comment, CAST(length(text) AS INTEGER) AS n FROM conversations")
def comment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ12, SRC13, SCL20, SCL23: plain text messages wrapped as comments, then through JSON."""
    messages = table(spark, sf_dir, "conversations").select(F.encode("text", "UTF-8").alias("value"))
    lines = to_json_lines(wrap_text(messages))
    return parse_json(lines, "value", "comment string").withColumn("n", F.length("comment"))


@query(
    """
    SELECT event_type AS key, event_type || ',' || CAST(event_id AS VARCHAR) AS value FROM events"""
)
def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7: rows as key and value text for a message sink; SCL35: array to separated text."""
    parts = joined(F.array("event_type", F.col("event_id").cast("string")))
    return to_messages(table(spark, sf_dir, "events"), "event_type", parts)


# Every page gets one of eight url forms. {0} is the page url, {1} words of its title.
_URL_FORMS = [
    ("{0}", []),
    ("https://a.com/search?q=", ["+", "&x=1"]),
    ("https://b.net/search?query=", ["%20", ""]),
    ("https://y.com/results?search_query=", ["+", ""]),
    ("https://e.org/x%zz?query=", ["%2B", "&z=1"]),
    ("https://g.com/url?sa=t&q=", ["+", "&oq=he&ie=U"]),
    ("https://g.co.kr/a.com/url?sa=t&q=", ["%20", "&ie=U"]),
    ("https://g.com/search?qx", ["+", ""]),
]


def _url_sql(spark_side: bool) -> str:
    blank = "regexp_replace(lang_words, ' ', '{0}')" if spark_side else "regexp_replace(lang_words, ' ', '{0}', 'g')"
    whens = []
    for i, (head, rest) in enumerate(_URL_FORMS):
        form = "url" if not rest else f"'{head}' || {blank.format(rest[0])} || '{rest[1]}'"
        whens.append(f"WHEN {i} THEN {form}")
    return f"CASE page_id % {len(_URL_FORMS)} {' '.join(whens)} END"


_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_TITLE_WORDS = "trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[^A-Za-z]+', ' '{flag}))"


def _history_sql(url: str | None = None, columns: str = "page_id, url, domain, keyword, search") -> str:
    from sluiceway.functions.urls import HOST_SUFFIXES

    domain, keyword = "''", "''"
    for s in HOST_SUFFIXES:
        domain = f"CASE WHEN contains(u, '{s}') THEN string_split(u, '{s}')[1] || '{s}' ELSE {domain} END"
        keyword = (
            f"CASE WHEN contains(u, '{s}') AND length(string_split(u, '{s}')[2]) > 1 THEN string_split(u, '{s}')[2] ELSE {keyword} END"
        )

    def to_amp(start: str) -> str:
        stop = "CASE WHEN contains(k, '&') THEN strpos(k, '&') ELSE length(k) + 1 END"
        return f"substr(k, {start}, greatest(0, {stop} - ({start})))"

    qx = "CASE WHEN contains(k, 'search?q=') THEN strpos(k, 'search?q=') + 9 ELSE 9 END"
    q_stop = "CASE WHEN contains(k, '&oq') THEN strpos(k, '&oq') WHEN contains(k, '&ie') THEN strpos(k, '&ie') ELSE length(k) + 1 END"
    q_start = "strpos(k, '&q') + 3"
    search = f"""CASE WHEN contains(k, 'search?query=') THEN {to_amp("strpos(k, 'search?query=') + 13")}
        WHEN contains(k, 'search?q') THEN {to_amp(qx)}
        WHEN contains(k, 'search_query') THEN {to_amp("strpos(k, 'search_query') + 12")}
        WHEN contains(k, 'query') THEN {to_amp("strpos(k, 'query') + 5")}
        WHEN contains(k, '&q') THEN substr(k, {q_start}, greatest(0, {q_stop} - ({q_start}))) ELSE '' END"""
    return f"""
    WITH p AS (SELECT page_id, url, {_TITLE_WORDS.format(flag=", 'g'")} AS lang_words, {_TITLE} AS title FROM pages),
    h AS (SELECT page_id, {url or _url_sql(False)} AS u FROM p),
    d AS (SELECT page_id, u AS url, {domain} AS domain, {keyword} AS keyword FROM h),
    k AS (SELECT *, url_decode(keyword) AS k FROM d)
    SELECT {columns} FROM (SELECT page_id, url, domain, keyword, replace({search}, '+', ' ') AS search FROM k)"""


@query(_history_sql())
def url_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL28-29b, SCL37: host, keyword and search term of page urls and of searches for their titles."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.expr(_TITLE_WORDS.format(flag="")).alias("lang_words"))
    return analyse_history(pages.select("page_id", F.expr(_url_sql(True)).alias("url")))


@query(_history_sql("url"))
def url_history_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL28-29b: every page url as it is."""
    return analyse_history(table(spark, sf_dir, "pages").select("page_id", "url"))


@query(_history_sql("'https://g.com/search?q=' || url_encode(title) || '&oq=x'", "page_id, domain, search"))
def url_encoded_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL29b, SCL37: searches for whole titles, percent-encoded UTF-8 with all their letters."""
    url = F.concat(F.lit("https://g.com/search?q="), F.url_encode(F.expr(_TITLE)), F.lit("&oq=x"))
    pages = table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    return analyse_history(pages).select("page_id", "domain", "search")


# These entities end at a semicolon, or without one, as in HTML.
_ENTITIES = "regexp_replace({c}, '&quot;?', '\"', 'g')"
_ENTITIES = f"regexp_replace({_ENTITIES}, '&copy;?', '©', 'g')"
_ENTITIES = f"regexp_replace(replace({_ENTITIES}, '&middot;', '·'), '&amp;?', '&', 'g')"


@query(f"SELECT page_id, {_ENTITIES.format(c=chr(34) + 't' + chr(34))} AS title FROM (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t FROM pages)")
def html_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC19, SCL30: element text out of page HTML."""
    return page_jobs.titles(table(spark, sf_dir, "pages").select("page_id", "html"))


@query(
    f"""
    WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a [^>]*>.*?</a>')) AS tag FROM pages)
    SELECT page_id, {_ENTITIES.format(c="regexp_extract(tag, 'href=\"([^\"]*)\"', 1)")} AS href,
           {_ENTITIES.format(c="regexp_extract(tag, '(?s)>(.*)</a>', 1)")} AS label FROM a"""
)
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL33: one row per matching element, with an attribute."""
    return page_jobs.links(table(spark, sf_dir, "pages").select("page_id", "html"))


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as a page with two reviews; the second has no long text and a reply."""
    safe = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    stars = (F.col("turn") % 5 + 1).cast("string")

    def review(helpful, full, short, reply) -> F.Column:
        return F.concat(
            F.lit('<div class="d15Mdf bAhLNe"><div><span class="X43Kjb">'),
            "role",
            F.lit('</span><br><div role="img" aria-label="별표 5개 만점에 '),
            stars,
            F.lit('개를 받았습니다."></div><span class="p2TkOb">2020년 9월 '),
            (F.col("turn") + 1).cast("string"),
            F.lit('일</span><div class="jUL89d y92BAb">'),
            helpful,
            F.lit('</div></div><span jsname="bN97Pc">'),
            short,
            F.lit('</span><span jsname="fbQN7e">'),
            full,
            F.lit("</span>"),
            reply,
            F.lit("</div>"),
        )

    first = review(F.lit("7"), safe, F.lit("cut"), F.lit(""))
    second = review(F.lit(""), F.lit(""), safe, F.concat(F.lit('<div class="LVQB0b">thanks\n<b>'), "role", F.lit("</b></div>")))
    page = F.concat(F.lit("<html><body>"), first, F.lit("<p>"), second, F.lit("</body></html>"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", page.alias("html"))


_REVIEW = "conv_id, turn, role AS name, CAST(turn % 5 + 1 AS INTEGER) AS ratings, strftime(make_date(2020, 9, CAST(turn + 1 AS INTEGER)), '%Y-%m-%d') AS date"


@query(
    f"""
    SELECT {_REVIEW}, 7 AS helpful, text AS comment, CAST(NULL AS VARCHAR) AS developer_comment FROM conversations
    UNION ALL SELECT {_REVIEW}, 0, text, 'thanks ' || role FROM conversations"""
)
def html_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC19, SCL30-32, DT8, NUL4: review records with their fall-backs."""
    return page_jobs.reviews(review_pages(spark, sf_dir))


@query("SELECT conv_id, turn, trim(text) AS comment FROM conversations UNION ALL SELECT conv_id, turn, role FROM conversations")
def html_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL33: one row per comment element."""
    safe = F.replace(F.replace(F.trim("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    tag = "yt-formatted-string"
    page = F.concat(F.lit(f"<{tag}>"), safe, F.lit(f"</{tag}><i>x</i><{tag} class='c'>"), "role", F.lit(f"</{tag}>"))
    return page_jobs.comments(table(spark, sf_dir, "conversations").select("conv_id", "turn", page.alias("html")))


def _trade_sql(tag: int) -> str:
    return f"""
    SELECT CAST(floor(p_retailprice * 100) AS BIGINT) + {tag} AS price, CAST(1990 + p_size AS VARCHAR) AS build_year, '2020' AS year, p_brand AS dong,
           p_name AS apartment, '8' AS month, CAST(p_size AS VARCHAR) AS day, p_type AS area, CAST(p_partkey AS VARCHAR) AS jibun,
           '41135' AS code, '{tag}' AS floor FROM part"""


@query(f"{_trade_sql(1)} UNION ALL {_trade_sql(2)}")
def xml_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC18, SCL34, SCL13, PRJ7: XML documents with two items each, renamed fields, price with commas."""

    def item(tag: int) -> F.Column:
        price = F.format_number(F.floor(F.col("p_retailprice") * 100).cast("bigint") + tag, 0)
        values = [
            F.concat(F.lit("  "), price),
            (F.lit(1990) + F.col("p_size")).cast("string"),
            F.lit("2020"),
            F.col("p_brand"),
            F.col("p_name"),
            F.lit("8"),
            F.col("p_size").cast("string"),
            F.col("p_type"),
            F.col("p_partkey").cast("string"),
            F.lit("41135"),
            F.lit(str(tag)),
        ]
        fields = [F.concat(F.lit(f"<{n}>"), v, F.lit(f"</{n}>")) for n, v in zip(TRADE_FIELDS, values, strict=True)]
        return F.concat(F.lit("<item>"), *fields, F.lit("</item>"))

    document = F.concat(
        F.lit("<response><header><resultCode>00</resultCode></header><body><items>"),
        item(1),
        item(2),
        F.lit("</items></body></response>"),
    )
    return trades(table(spark, sf_dir, "part").select(document.alias("value")))


@query(
    """
    SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS kind, CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS who,
           CASE WHEN event_type <> 'view' THEN json_extract_string(props, '$.k') END AS ms, CASE WHEN event_type <> 'view' THEN props END AS rest
    FROM events"""
)
def captured_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL36, SCL38: named captures from log lines; a line of another form gives nulls."""
    k = F.get_json_object("props", "$.k")
    told = F.concat(F.col("event_type"), F.lit(": user="), "user_id", F.lit(" took "), k, F.lit(" ms  "), "props")
    line = F.when(F.col("event_type") == "view", F.lit("view without fields")).otherwise(told)
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    return capture_fields(lines, "line", r"^%{WORD:kind}: user=%{INT:who} took %{NUMBER:ms} ms\s+%{GREEDYDATA:rest}$").drop("line")


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS price,
           strftime(o_orderdate, '%Y-%m-%d') AS day, date_trunc('month', o_orderdate)::DATE AS month,
           CAST(o_orderkey % 5 + 1 AS INTEGER) AS stars FROM orders"""
)
def text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL13, SCL31, DT4, DT8: numbers, dates and ratings written as text."""
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.format_number(F.floor("o_totalprice"), 0))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        price.alias("price"),
        F.date_format("o_orderdate", "yyyy'년' M'월' d'일'").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.concat(F.lit("별표 5개 만점에 "), (F.col("o_orderkey") % 5 + 1).cast("string"), F.lit("개를 받았습니다.")).alias("stars"),
    )
    return rows.select(
        "o_orderkey",
        clean_number("price").alias("price"),
        korean_date("day").alias("day"),
        month_date("month").alias("month"),
        rating("stars").alias("stars"),
    )


ROW_SCHEMA = "id bigint, first_name string, last_name string, email string"


def change_messages(customers: DataFrame) -> DataFrame:
    """Envelopes for every customer: created; renamed when the balance is negative; one segment deleted; a replay."""
    row = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.lit("x@example.com").alias("email"),
    )
    changed = row.withField("first_name", F.concat("c_name", F.lit(" (renamed)")))
    nothing = F.lit(None)

    def envelope(op: str, step: int, before, after) -> F.Column:
        source = F.struct((F.col("c_custkey") * 10 + step).alias("pos"), F.lit("customers").alias("table"))
        payload = F.struct(
            before.alias("before"), after.alias("after"), source.alias("source"), F.lit(op).alias("op"),
            F.lit(1700000000000 + step // 2).alias("ts_ms"),
        )
        return F.to_json(F.struct(payload.alias("payload")))

    renamed = F.when(F.col("c_acctbal") < 0, envelope("u", 1, row, changed))
    removed = F.when(F.col("c_mktsegment") == "BUILDING", envelope("d", 4, changed, nothing))
    statement = F.concat(F.lit("ALTER TABLE customers ADD x"), F.col("c_custkey").cast("string"), F.lit(" INT"))
    ddl = F.when(F.col("c_custkey") % 4 == 0, F.to_json(F.struct(F.struct(statement.alias("ddl")).alias("payload"))))
    created = envelope("c", 0, nothing, row)
    messages = F.array(created, renamed, removed, created, ddl)
    return customers.select(F.explode(messages).alias("value")).where(F.col("value").isNotNull())


_LATEST = """
    SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN c_name || ' (renamed)' ELSE c_name END AS first_name,
           c_mktsegment AS last_name, 'x@example.com' AS email FROM customer WHERE c_mktsegment <> 'BUILDING'"""


@query(_LATEST)
def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR11: current rows out of create, update, delete and replayed events."""
    return changes.latest_state(changes.unwrap_changes(change_messages(table(spark, sf_dir, "customer")), ROW_SCHEMA), ["id"])


@query(
    """
    SELECT 'c' AS op, c_custkey * 10 AS pos, c_name AS first_name FROM customer
    UNION ALL SELECT 'c', c_custkey * 10, c_name FROM customer
    UNION ALL SELECT 'u', c_custkey * 10 + 1, c_name || ' (renamed)' FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'd', c_custkey * 10 + 4, c_name || ' (renamed)' FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def cdc_unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR11: envelopes to rows; a delete shows the row as it was."""
    rows = changes.unwrap_changes(change_messages(table(spark, sf_dir, "customer")), ROW_SCHEMA)
    return rows.select("op", "pos", "row.first_name")


@query("SELECT 'ALTER TABLE customers ADD x' || c_custkey || ' INT' AS ddl, 'ALTER' AS verb FROM customer WHERE c_custkey % 4 = 0")
def cdc_schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR11, SCL24: DDL events among the messages."""
    found = changes.schema_changes(change_messages(table(spark, sf_dir, "customer")))
    message = F.to_json(F.struct(F.struct(F.split("ddl", " ")[0].alias("verb")).alias("payload")))
    return found.withColumn("message", message).select("ddl", json_field("message", "$.payload.verb").alias("verb"))


@query(_LATEST)
def stream_cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR11: the newest change per key as stream state, written per batch and read back."""
    folder = shared_folder(spark, "changes")
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    customers = read_folder_stream(spark, table_path(sf_dir, "customer"), schema)
    unwrapped = changes.unwrap_changes(change_messages(customers), ROW_SCHEMA)
    start_latest_changes(unwrapped, ["id"], f"{folder}/out", f"{folder}/checkpoint", interval=None).awaitTermination()
    return read_latest_state(spark, f"{folder}/out", ["id"], ROW_SCHEMA)


@query(
    """
    SELECT c_custkey, c_name AS item FROM customer UNION ALL SELECT c_custkey, c_mktsegment || c_nationkey FROM customer
    UNION ALL SELECT c_custkey, c_nationkey::VARCHAR FROM customer"""
)
def html_nested_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC19, SCL30, SCL33: records inside records, some with and some without their end tags."""
    open_form = F.concat(F.lit("<ul><li>"), "c_name", F.lit("<li>"), "c_mktsegment", F.lit("<ul><li>"), F.col("c_nationkey").cast("string"), F.lit("</ul></ul>"))
    closed = F.concat(
        F.lit("<ul><li>"), "c_name", F.lit("</li><li>"), "c_mktsegment", F.lit("<ul><li>"), F.col("c_nationkey").cast("string"), F.lit("</li></ul></li></ul>")
    )
    page = F.when(F.col("c_custkey") % 2 == 0, open_form).otherwise(closed)
    pages = table(spark, sf_dir, "customer").select("c_custkey", page.alias("html"))
    return extract_html(pages, "html", Element("li"), {"item": Element("li")})
