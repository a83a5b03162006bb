"""Registered queries over ``events``, ``lineitem``, ``orders`` and ``part``: decoding, windows, counters, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.binary import array_pair, bits, bucket_ranges, decode_le, high_part, low_part, pair_label
from sluiceway.functions.clock import epoch_ms
from sluiceway.operators.columns import apply_mapping, drop_null_fields, lower_names, resolve_choice, zero_text
from sluiceway.operators.counters import counter_diff, repair_counter
from sluiceway.operators.labelling import backfill, label_ahead, row_rank
from sluiceway.operators.tumbling import Growth, Last, any_set, mean, tumble
from sluiceway.plans.mart import ERROR_LABELS, OTHER_ERROR
from sluiceway.plans.registry import query, table
from sluiceway.plans.telemetry import STATE_RANGES

PROPS_K = "CAST(json_extract(props, '$.k') AS BIGINT)"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their counter ``k`` and the value in cents."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "cents": F.round(F.col("value") * 100).cast("bigint"),
        }
    )


def _window_sql(width: str, keys: str, aggregates: str) -> str:
    return f"""
    WITH r AS (SELECT *, {PROPS_K} AS k, CAST(round(value * 100) AS BIGINT) AS cents,
                      time_bucket(INTERVAL '{width}', ts) AS w FROM events)
    SELECT {keys}, strftime(w, '%Y-%m-%d %H:%M:%S') AS "start",
           strftime(w + INTERVAL '{width}', '%Y-%m-%d %H:%M:%S') AS "end", {aggregates}
    FROM r GROUP BY {keys}, w"""


@query(
    _window_sql(
        "10 minutes",
        "user_id, event_type",
        """CAST(ceil(avg(CASE WHEN value > 100 THEN 1 ELSE 0 END)) AS INTEGER) AS hot,
           CAST(round(CAST(avg(k) AS DECIMAL(18, 6)), 0) AS DOUBLE) AS k_mean,
           CAST(round(CAST(avg(cents) AS DECIMAL(18, 6)), 2) AS DOUBLE) AS cents_mean,
           max(cents) AS cents_max,
           arg_max(k, (ts, event_id)) AS k_last,
           arg_max(k, (ts, event_id)) - arg_min(k, (ts, event_id)) AS k_growth,
           CASE WHEN arg_max(cents, (ts, event_id)) = 0 THEN 0
                ELSE arg_max(cents, (ts, event_id)) - arg_min(cents, (ts, event_id)) END AS cents_growth""",
    )
)
def telemetry_10min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1-7, DT2-3, PRJ8: the ten-minute aggregation."""
    rows = readings(spark, sf_dir).withColumn("flag", F.when(F.col("value") > 100, 1).otherwise(0))
    spec = {
        "hot": any_set("flag"),
        "k_mean": mean("k"),
        "cents_mean": mean("cents", 2),
        "cents_max": F.max("cents"),
        "k_last": Last("k"),
        "k_growth": Growth("k", zero_guard=False),
        "cents_growth": Growth("cents"),
    }
    return tumble(rows, ["user_id", "event_type"], "ts", "10 minutes", spec, ["ts", "event_id"])


@query(
    _window_sql(
        "1 day",
        "user_id",
        """arg_max(k, (ts, event_id)) AS k_last,
           arg_max(k, (ts, event_id)) - arg_min(k, (ts, event_id)) AS k_growth,
           arg_max(event_type, (ts, event_id)) AS last_type, count(*) AS n""",
    )
)
def daily_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4-6 on windows that hold many rows of a device."""
    spec = {
        "k_last": Last("k"),
        "k_growth": Growth("k", zero_guard=False),
        "last_type": Last("event_type"),
        "n": F.count(F.lit(1)),
    }
    return tumble(readings(spark, sf_dir), ["user_id"], "ts", "1 day", spec, ["ts", "event_id"])


@query(
    """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at,
           epoch_us(ts) // 1000 AS registerat FROM events"""
)
def epoch_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT1, DT3: epoch milliseconds to timestamps and text."""
    events = table(spark, sf_dir, "events")
    ms = events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("registerat"))
    return ms.select("event_id", epoch_ms("registerat").cast("string").alias("at"), "registerat")


@query(
    """
    WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey % 300 AS b0, l_partkey % 256 AS b1,
                      l_suppkey % 256 AS b2, CAST(l_quantity AS BIGINT) * 5 AS b3 FROM lineitem),
         v AS (SELECT *, CASE WHEN b0 BETWEEN 0 AND 255 AND b3 BETWEEN 0 AND 255
                              THEN b0 + b1 * 256 + b2 * 65536 + b3 * 16777216 END AS u32 FROM b)
    SELECT l_orderkey, l_partkey, l_linenumber, u32, CASE WHEN u32 < 2147483648 THEN u32 END AS i32,
           b1 + b2 * 256 AS u16 FROM v"""
)
def decode_le_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL1-2, SCL6, UDF1: little-endian bytes; a byte above 255 spoils the field."""
    rows = table(spark, sf_dir, "lineitem").withColumns(
        {
            "b0": F.col("l_orderkey") % 300,
            "b1": F.col("l_partkey") % 256,
            "b2": F.col("l_suppkey") % 256,
            "b3": F.col("l_quantity").cast("bigint") * 5,
        }
    )
    parts = ["b0", "b1", "b2", "b3"]
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        decode_le(parts).alias("u32"),
        decode_le(parts, bits32=True).alias("i32"),
        decode_le(["b1", "b2"]).alias("u16"),
    )


def _bit_sql(expression: str, prefix: str, count: int) -> str:
    return ", ".join(
        f"coalesce(TRY_CAST(nullif(substr({expression}, {i + 1}, 1), '') AS INTEGER), 0) AS {prefix}{i}"
        for i in range(count)
    )


@query(
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, {_bit_sql("bin(CAST(l_quantity AS BIGINT))", "bit", 8)},
           {_bit_sql("lpad(bin(CAST(l_quantity AS BIGINT)), 8, '0')", "pos", 8)} FROM lineitem"""
)
def bit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL3-5, NUL2: binary digits, counted from the top digit and by position."""
    left = [c.alias(f"bit{i}") for i, c in enumerate(bits("l_quantity", 8))]
    positional = [c.alias(f"pos{i}") for i, c in enumerate(bits("l_quantity", 8, "positional"))]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", *left, *positional)


@query(
    """
    WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_partkey % 256 AS b0, l_suppkey % 256 AS b1,
                      l_orderkey % 5 = 0 AS bad FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN NOT bad THEN b0 + b1 * 256 END AS u16,
           CASE WHEN NOT bad THEN CAST(b0 % 256 AS INTEGER) END AS low, CASE WHEN NOT bad THEN b0 % 2 ELSE 0 END AS last_bit FROM b"""
)
def decode_text_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL1-5, SCL7: bytes that arrive as text, some of them unreadable, which become null and end no job."""
    bad = F.col("l_orderkey") % 5 == 0
    rows = table(spark, sf_dir, "lineitem").withColumns(
        {
            "b0": F.when(bad, "x").otherwise((F.col("l_partkey") % 256).cast("string")),
            "b1": (F.col("l_suppkey") % 256).cast("string"),
        }
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        decode_le(["b0", "b1"]).alias("u16"),
        low_part("b0").alias("low"),
        bits("b0", 8, "positional")[7].alias("last_bit"),
    )


@query(
    f"""
    WITH p AS (SELECT event_id, {PROPS_K} * 128 + user_id AS a, user_id * 64 AS b FROM events)
    SELECT event_id, CAST(a % 256 AS INTEGER) AS code_low, CAST(round(b / 256.0) AS INTEGER) AS code_high,
           CAST(round(a / 256.0) AS INTEGER) AS a_high, CAST(NULL AS INTEGER) AS beyond FROM p"""
)
def packed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL7-8: remainder and half-up quotient of array items; an item that is missing is null."""
    codes = F.array(F.col("k") * 128 + F.col("user_id"), F.col("user_id") * 64)
    rows = readings(spark, sf_dir).select("event_id", codes.alias("codes"))
    return rows.select(
        "event_id",
        low_part(F.get("codes", F.lit(0))).alias("code_low"),
        array_pair("codes", 1)[1].alias("code_high"),
        high_part(F.get("codes", F.lit(0))).alias("a_high"),
        array_pair("codes", 5)[0].alias("beyond"),
    )


@query(
    """
    SELECT p_partkey, CASE WHEN s < 20 THEN 0 WHEN s BETWEEN 20 AND 30 THEN 1 WHEN s BETWEEN 31 AND 45 THEN 2
                           WHEN s BETWEEN 51 AND 59 THEN 3 WHEN s BETWEEN 60 AND 79 THEN 4 END AS statenum
    FROM (SELECT p_partkey, p_size * 2 AS s FROM part)"""
)
def state_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL10: code ranges with gaps."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", bucket_ranges(F.col("p_size") * 2, STATE_RANGES).alias("statenum")
    )


@query(
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CASE WHEN l_quantity = 3 AND l_linenumber = 1 THEN 1
                WHEN l_quantity = 12 AND l_linenumber = 1 THEN 2 ELSE 3 END AS errorlabel FROM lineitem"""
)
def error_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL11: label of a code pair."""
    label = pair_label("l_quantity", F.col("l_linenumber") - 1, ERROR_LABELS, OTHER_ERROR)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", label.alias("errorlabel"))


def _price(status: str) -> str:
    return f"CASE WHEN o_orderstatus <> '{status}' THEN o_totalprice END"


@query(
    f"""
    WITH o AS (SELECT *, {_price('P')} AS price, strftime(o_orderdate, '%Y-%m') AS m FROM orders)
    SELECT o_orderkey, o_custkey, m, CASE
        WHEN price > first_value(price IGNORE NULLS) OVER (PARTITION BY o_custkey, m ORDER BY o_orderdate DESC, o_orderkey DESC)
          OR price < first_value(price IGNORE NULLS) OVER (PARTITION BY o_custkey, m ORDER BY o_orderdate, o_orderkey)
        THEN lag(price) OVER (PARTITION BY o_custkey, m ORDER BY o_orderdate, o_orderkey) ELSE price END AS price
    FROM o"""
)
def counter_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1-4: readings outside the first and last known value of the month."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.date_format("o_orderdate", "yyyy-MM").alias("m"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    fixed = repair_counter(rows, ["price"], ["o_custkey", "m"], "o_orderdate", ["o_orderkey"], "6 days")
    return fixed.drop("o_orderdate")


@query(
    f"""
    WITH o AS (SELECT *, CAST(round({_price('P')} * 100) AS BIGINT) AS price FROM orders)
    SELECT o_orderkey, o_custkey,
           coalesce(price - lag(price) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), price) AS price,
           coalesce(o_orderkey - lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderkey) AS step
    FROM o"""
)
def counter_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN5: difference to the previous reading."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.when(F.col("o_orderstatus") != "P", F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("price"),
        F.col("o_orderkey").alias("step"),
    )
    return counter_diff(rows, ["price", "step"], ["o_custkey"], "o_orderdate", ["o_orderkey"], "90 days").drop("o_orderdate")


@query(
    """
    SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rank FROM events"""
)
def reading_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN6: position of a reading within its device."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return row_rank(events, ["user_id"], "ts", "rank", ["event_id"]).drop("ts")


def labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = (
        F.when((F.col("event_type") == "error") & (F.col("value") > 40), 1)
        .when(F.col("event_type") == "error", 2)
        .when(F.col("event_type") == "view", 3)
        .when(F.col("event_type") == "signup", 4)
        .otherwise(0)
    )
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", label.alias("errorlabel"))


@query(
    """
    WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' AND value > 40 THEN 1 WHEN event_type = 'error' THEN 2
                      WHEN event_type = 'view' THEN 3 WHEN event_type = 'signup' THEN 4 ELSE 0 END AS lab FROM events),
         n AS (SELECT *, first_value(CASE WHEN lab IN (1, 2) THEN ts END IGNORE NULLS) OVER ahead AS next_ts,
                         first_value(CASE WHEN lab IN (1, 2) THEN lab END IGNORE NULLS) OVER ahead AS next_lab
               FROM e WINDOW ahead AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
    SELECT event_id, user_id,
           CASE WHEN lab IN (0, 3) AND next_ts - INTERVAL 1 DAY <= ts THEN next_lab ELSE lab END AS errorlabel FROM n"""
)
def label_before_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN7, UDF2, DT6: rows of the day before an error take its label."""
    return label_ahead(labelled_events(spark, sf_dir), ["user_id"], "ts", "errorlabel").drop("ts")


def versioned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(F.col("value") > 60, F.col("value")).alias("room_version"),
        F.when(F.col("event_type") == "signup", F.col("event_type")).alias("boiler_version"),
    )


_VERSIONED = """
    WITH v AS (SELECT event_id, user_id, ts, CASE WHEN value > 60 THEN value END AS r,
                      CASE WHEN event_type = 'signup' THEN event_type END AS b FROM events)"""
_FROM_LATER = "first_value({c} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_LAST_KNOWN = "last_value({c} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
_OLDEST = "first_value({c}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def _backfill_sql(fallback: str) -> str:
    filled = ", ".join(
        f"coalesce({_FROM_LATER.format(c=c)}, {fallback.format(c=c)}) AS {name}"
        for c, name in (("r", "room_version"), ("b", "boiler_version"))
    )
    return f"{_VERSIONED} SELECT event_id, user_id, {filled} FROM v"


@query(_backfill_sql(_LAST_KNOWN))
def version_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN8, UDF3: versions filled back from later rows."""
    rows = versioned_events(spark, sf_dir)
    return backfill(rows, ["user_id"], "ts", ["room_version", "boiler_version"], ["event_id"]).drop("ts")


@query(_backfill_sql(_OLDEST))
def version_backfill_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN9: the older rule, which ends with the value of the oldest row."""
    rows = versioned_events(spark, sf_dir)
    filled = backfill(
        rows, ["user_id"], "ts", ["room_version", "boiler_version"], ["event_id"], fallback="oldest_row"
    )
    return filled.drop("ts")


@query(
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE l_quantity END AS reading, l_tax AS plain
    FROM lineitem"""
)
def choice_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ9, NUL3: columns that hold one field per type become one value."""
    as_double = F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice"))
    as_int = F.when(F.col("l_returnflag") != "A", F.col("l_quantity").cast("int"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.struct(as_int.alias("int"), as_double.alias("double")).alias("reading"),
        F.col("l_tax").alias("plain"),
    )
    return resolve_choice(rows, ["reading", "plain"])


@query(
    """
    SELECT c_custkey AS customer_id, upper(c_name) AS label, CAST(c_nationkey AS VARCHAR) AS nation,
           CAST(floor(c_acctbal) AS BIGINT) AS balance, coalesce(nullif(CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END, ''), '0') AS segment
    FROM customer"""
)
def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ2, PRJ5, PRJ7, PRJ10, NUL2, NUL4: mapping list, null-typed fields, lower-case names, empty text."""
    rows = table(spark, sf_dir, "customer").withColumns(
        {
            "C_LABEL": F.upper("c_name"),
            "c_floor": F.floor("c_acctbal"),
            "c_segment": F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")),
            "c_nothing": F.lit(None),
        }
    )
    rows = drop_null_fields(zero_text(lower_names(rows), ["c_segment"]))
    return apply_mapping(
        rows,
        [
            ("c_custkey", "customer_id", "bigint"),
            ("c_label", "label", "string"),
            ("c_nationkey", "nation", "string"),
            ("c_floor", "balance", "bigint"),
            ("c_segment", "segment", "string"),
        ],
    )
