"""Registered queries over ``orders`` as an order flow: bounds, top lists, windows, chunks, joins, streams."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.binary import code_of
from sluiceway.operators.columns import drop_missing, fill_zero
from sluiceway.operators.joins import chain_left, keep_keys, union_families
from sluiceway.operators.ranking import bounds, sorted_distinct, top_k, top_k_per, value_chunks
from sluiceway.operators.tumbling import sliding_sum
from sluiceway.plans.registry import query, table, table_path
from sluiceway.session import shared_folder
from sluiceway.sources.messages import read_folder_stream
from sluiceway.streaming import batches, orders as order_flow
from sluiceway.streaming.words import batch_size

# Order times lie inside panes: the dates of the table are replaced by instants of three days, a second apart in places.
_LINES = """
    o AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'B' WHEN 'O' THEN 'S' ELSE 'P' END AS side,
                 substr(o_orderpriority, 3) || o_custkey % 10 AS symbol, CAST(floor(o_totalprice) AS INTEGER) % 100 AS amount,
                 CAST(o_custkey % 13 + 1 AS DOUBLE) AS price,
                 TIMESTAMP '1998-08-01 00:00:00' + to_seconds(o_orderkey * 7919 % 259200) AS otime FROM orders)"""


def order_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Orders as text lines. Status P gives an unknown side, so those lines are bad."""
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    time = F.lit("1998-08-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("o_orderkey") * 7919 % 259200)
    return orders.select(
        F.concat_ws(
            ",",
            F.date_format(time, "yyyy-MM-dd HH:mm:ss"),
            "o_orderkey",
            "o_custkey",
            F.concat(F.substring("o_orderpriority", 3, 100), (F.col("o_custkey") % 10).cast("string")),
            F.floor("o_totalprice").cast("int") % 100,
            (F.col("o_custkey") % 13 + 1).cast("double"),
            F.translate("o_orderstatus", "FO", "BS"),
        ).alias("value")
    )


def good_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_flow.parse_orders(order_lines(spark, sf_dir))[0]


@query(
    f"""
    WITH {_LINES}
    SELECT strftime(otime, '%Y-%m-%d %H:%M:%S') AS time, o_orderkey AS orderid, o_custkey AS clientid, symbol, amount, price, side
    FROM o WHERE side IN ('B', 'S')"""
)
def order_lines_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT5, SCL25, DT5: typed orders out of text lines."""
    return good_orders(spark, sf_dir).withColumn("time", F.col("time").cast("string"))


@query(f"WITH {_LINES} SELECT CAST(count(*) AS BIGINT) AS bad, min(o_orderkey) AS first_key FROM o WHERE side = 'P'")
def order_lines_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT5: the lines that were dropped, untouched."""
    bad = order_flow.parse_orders(order_lines(spark, sf_dir))[1]
    key = F.get(F.split("value", ","), F.lit(1)).cast("bigint")
    return bad.agg(F.count(F.lit(1)).alias("bad"), F.min(key).alias("first_key"))


@query(
    """
    SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS lo, strftime(max(o_orderdate), '%Y-%m-%d') AS hi, count(*) AS n FROM orders"""
)
def minmax_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6, AGG10, SRT5: both bounds and the count in one pass."""
    found = bounds(table(spark, sf_dir, "orders"), "o_orderdate")
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("lo", "hi")})


@query(
    f"""
    WITH {_LINES} SELECT o_custkey AS clientid, sum(amount * price) AS total FROM o WHERE side IN ('B', 'S')
    GROUP BY 1 ORDER BY total DESC, clientid LIMIT 5"""
)
def top5_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14, SRT2, WIN10, FLT8: clients with the largest turnover."""
    return top_k(order_flow.client_totals(good_orders(spark, sf_dir)), "total", 5, "clientid")


@query(
    f"""
    WITH {_LINES},
    pane AS (SELECT time_bucket(INTERVAL '5 minutes', otime) AS p, symbol, CAST(sum(amount) AS BIGINT) AS part FROM o WHERE side IN ('B', 'S') GROUP BY 1, 2),
    win AS (SELECT p - INTERVAL (5 * i) MINUTE AS s, symbol, CAST(sum(part) AS BIGINT) AS total FROM pane, range(12) r(i) GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY total DESC, symbol) AS rank FROM win)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS "start", symbol, total, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5"""
)
def top5_symbols_60m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4, WIN10: largest symbols of each 60-minute window, a new window every 5 minutes."""
    best = top_k_per(order_flow.symbol_volume(good_orders(spark, sf_dir)), ["window"], "total", 5, "symbol")
    return best.select(F.col("window.start").cast("string").alias("start"), "symbol", "total", "rank")


@query(
    """
    WITH p AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS b, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS part
               FROM events GROUP BY 1, 2)
    SELECT event_type, strftime(b - INTERVAL (10 * i) MINUTE, '%Y-%m-%d %H:%M:%S') AS "start", CAST(sum(part) AS BIGINT) AS total
    FROM p, range(6) r(i) GROUP BY 1, 2"""
)
def sliding_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4, STR12: sums over overlapping windows through panes."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    sums = sliding_sum(table(spark, sf_dir, "events"), ["event_type"], "ts", cents, "60 minutes", "10 minutes")
    return sums.select("event_type", F.col("window.start").cast("string").alias("start"), "total")


@query(
    f"""
    WITH {_LINES} SELECT CASE side WHEN 'B' THEN 'BUYS' ELSE 'SELLS' END AS metric, CAST(count(*) AS VARCHAR) AS "values"
    FROM o WHERE side IN ('B', 'S') GROUP BY 1"""
)
def buy_sell_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG11: orders per side."""
    counts = order_flow.side_counts(good_orders(spark, sf_dir))
    return counts.withColumn("values", F.concat_ws(",", "values"))


_METRICS = f"""
    WITH {_LINES}, g AS (SELECT * FROM o WHERE side IN ('B', 'S')),
    c AS (SELECT o_custkey, sum(amount * price) AS total FROM g GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 5),
    s AS (SELECT symbol, sum(amount) AS total FROM g WHERE otime > (SELECT max(otime) FROM g) - INTERVAL 60 MINUTE
          GROUP BY 1 ORDER BY total DESC, symbol LIMIT 5)
    SELECT CASE side WHEN 'B' THEN 'BUYS' ELSE 'SELLS' END AS metric, CAST(count(*) AS VARCHAR) AS "values" FROM g GROUP BY 1
    UNION ALL SELECT 'TOP5CLIENTS', string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY total DESC, o_custkey) FROM c
    UNION ALL SELECT 'TOP5STOCKS', string_agg(symbol, ',' ORDER BY total DESC, symbol) FROM s"""


@query(_METRICS)
def order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR6, SET2, AGG15: all metric rows of the order flow."""
    return order_flow.order_metrics(good_orders(spark, sf_dir)).withColumn("values", F.concat_ws(",", "values"))


@query(
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(floor((row_number() OVER (ORDER BY o_orderdate) - 1) / 99) AS INTEGER) AS chunk
    FROM (SELECT DISTINCT o_orderdate FROM orders)"""
)
def partition_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG16, SNK12: distinct values in order, in chunks of 99."""
    chunks = value_chunks(table(spark, sf_dir, "orders"), "o_orderdate")
    return chunks.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "chunk")


@query("SELECT DISTINCT c_mktsegment FROM customer ORDER BY 1")
def sorted_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9, SRT6: distinct values in order."""
    return sorted_distinct(table(spark, sf_dir, "customer"), "c_mktsegment")


@query(
    """
    WITH li AS (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, count(*) AS lines FROM lineitem GROUP BY 1),
    f AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 4 END AS type FROM orders)
    SELECT o_orderkey, o_custkey, o_orderstatus, type, c_mktsegment, n_name, coalesce(quantity, 0) AS quantity, coalesce(lines, 0) AS lines
    FROM f LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN li ON o_orderkey = l_orderkey WHERE n_name IS NOT NULL"""
)
def left_chain_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1-3, SET1, PRJ3-4, NUL1, FLT4: three families, a chain of left joins, zeros and required columns."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"), F.count(F.lit(1)).alias("lines")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    families = union_families({i: orders.where(F.col("o_orderstatus") == s) for i, s in ((2, "F"), (3, "O"), (4, "P"))})
    rows = chain_left(families, [lines], ["o_orderkey"])
    rows = chain_left(rows, [customers], ["o_custkey"])
    rows = chain_left(rows, [nations], ["n_nationkey"])
    return drop_missing(fill_zero(rows, ["quantity", "lines"]), ["n_name"]).drop("n_nationkey")


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)"""
)
def customer_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT3, JN5: membership in a derived key table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    urgent = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
    return keep_keys(orders, urgent, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'today' WHEN '3-MEDIUM' THEN 'week'
                                            ELSE 'later' END AS due
    FROM orders WHERE o_orderstatus = 'O' AND strftime(o_orderdate, '%Y-%m') >= '1996-05'"""
)
def case_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL12, FLT9: text values to codes, with an equality and a text-range filter."""
    orders = table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "O") & (F.date_format("o_orderdate", "yyyy-MM") >= "1996-05")
    )
    due = code_of("o_orderpriority", {"1-URGENT": "now", "2-HIGH": "today", "3-MEDIUM": "week"}, "later")
    return orders.select("o_orderkey", due.alias("due"))


def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "orders").schema.simpleString()[len("struct<") : -1].replace(":", " ")
    rows = read_folder_stream(spark, table_path(sf_dir, "orders"), schema)
    return order_flow.parse_orders(order_lines(spark, sf_dir, rows))[0]


@query(
    f"WITH {_LINES} SELECT o_custkey AS clientid, sum(amount * price) AS total FROM o WHERE side IN ('B', 'S') GROUP BY 1"
)
def stream_client_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2, STR7, UDF6: running totals per client, kept by a stream and read back."""
    folder = shared_folder(spark, "client-totals")
    totals = order_flow.client_totals(order_stream(spark, sf_dir))
    add = order_flow.to_totals(f"{folder}/totals")
    batches.start(totals, f"{folder}/checkpoint", add, "update", interval=None).awaitTermination()
    return order_flow.total_store(spark, f"{folder}/totals").read().select("clientid", "total")


@query(_METRICS)
def stream_order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1, STR4-8, SNK7: the three metric queries of the order stream; what each wrote for its last batch."""
    folder = shared_folder(spark, "order-metrics")
    running = order_flow.start_order_metrics(
        order_stream(spark, sf_dir),
        lambda name: batches.to_folder(f"{folder}/out/query={name}"),
        f"{folder}/checkpoint",
        interval=None,
    )
    for one in running:
        one.awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    last = out.groupBy(F.col("query").alias("_q")).agg(F.max("batch").alias("_b"))
    newest = out.join(last, (F.col("query") == F.col("_q")) & (F.col("batch") == F.col("_b")))
    return newest.select("metric", F.concat_ws(",", "values").alias("values"))


BATCHES = 5


def order_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order stream in micro-batches by key, each with orders of all times, so that many come late."""
    folder = shared_folder(spark, "order-files")
    orders = table(spark, sf_dir, "orders")
    files = 4
    for batch in range(BATCHES):
        orders.where(F.col("o_orderkey") % BATCHES == batch).repartition(files).write.mode("append").parquet(folder)
    schema = orders.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    rows = read_folder_stream(spark, folder, schema, files_per_batch=files)
    return order_flow.parse_orders(order_lines(spark, sf_dir, rows))[0]


def run_batches(orders: DataFrame, checkpoint: str, write: batches.BatchFunction) -> None:
    batches.start(orders, checkpoint, write, interval=None).awaitTermination()


@query(
    f"""
    WITH {_LINES},
    pane AS (SELECT time_bucket(INTERVAL '15 minutes', otime) AS p, symbol, CAST(sum(amount) AS BIGINT) AS part FROM o WHERE side IN ('B', 'S') GROUP BY 1, 2),
    win AS (SELECT p - INTERVAL (15 * i) MINUTE AS s, symbol, CAST(sum(part) AS BIGINT) AS total FROM pane, range(4) r(i) GROUP BY 1, 2)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS "start", symbol, total FROM win"""
)
def stream_symbol_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4: sliding sums of a stream in several batches: late orders count, open windows are reported."""
    folder = shared_folder(spark, "symbol-volume")
    add = order_flow.to_panes(f"{folder}/panes", "15 minutes")
    run_batches(order_batches(spark, sf_dir), f"{folder}/checkpoint", add)
    windows = order_flow.pane_windows(spark, f"{folder}/panes", "60 minutes", "15 minutes")
    return windows.select(F.col("window.start").cast("string").alias("start"), "symbol", "total")


_PER_BATCH = f"""
    WITH {_LINES}, g AS (SELECT *, o_orderkey % {BATCHES} AS batch FROM o WHERE side IN ('B', 'S')),
    newest AS (SELECT b, max(otime) AS newest FROM g, range({BATCHES}) r(b) WHERE batch <= b GROUP BY b)"""


@query(
    f"""{_PER_BATCH}
    SELECT g.batch, o_orderkey AS orderid, strftime(otime, '%Y-%m-%d %H:%M:%S') AS time
    FROM g JOIN newest ON b = g.batch - 1 WHERE otime < newest - INTERVAL 10 MINUTE"""
)
def stream_late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4: the late orders of each batch, reported on the side."""
    folder = shared_folder(spark, "late-orders")
    add = order_flow.to_panes(f"{folder}/panes", late=batches.to_folder(f"{folder}/late"))
    run_batches(order_batches(spark, sf_dir), f"{folder}/checkpoint", add)
    late = spark.read.schema("time timestamp, orderid bigint, batch bigint").parquet(f"{folder}/late")
    return late.select("batch", "orderid", F.col("time").cast("string").alias("time"))


@query(
    f"""{_PER_BATCH}
    SELECT b AS batch, symbol, CAST(sum(amount) AS BIGINT) AS total FROM g JOIN newest ON g.batch <= b AND otime > newest - INTERVAL 60 MINUTE
    GROUP BY ALL"""
)
def stream_running_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4, STR6: after each batch, the amounts of the last 60 minutes to the second, late orders included."""
    folder = shared_folder(spark, "running-hour")
    add, sink = order_flow.to_ticks(f"{folder}/ticks", fan=2), batches.to_folder(f"{folder}/out")

    def write(batch: DataFrame, batch_id: int) -> None:
        add(batch, batch_id)
        sink(order_flow.running_volume(batch.sparkSession, f"{folder}/ticks"), batch_id)

    run_batches(order_batches(spark, sf_dir), f"{folder}/checkpoint", write)
    return spark.read.schema("symbol string, total bigint, batch bigint").parquet(f"{folder}/out")


@query(
    f"""{_PER_BATCH}
    SELECT strftime(time_bucket(INTERVAL '5 minutes', otime), '%Y-%m-%d %H:%M:%S') AS pane, symbol, CAST(sum(amount) AS BIGINT) AS total,
           count(*) AS orders, strftime(max(otime), '%Y-%m-%d %H:%M:%S') AS newest FROM g GROUP BY 1, 2"""
)
def stream_replayed_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2-4, STR11: a stream is killed after it has added a batch and replays it, before and after parts are merged."""
    folder = shared_folder(spark, "replayed-panes")
    panes, orders, failed = f"{folder}/panes", order_batches(spark, sf_dir), set()
    add = order_flow.to_panes(panes, fan=2)

    def write(batch: DataFrame, batch_id: int) -> None:
        add(batch, batch_id)
        if batch_id in (0, 1, 3) and batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("killed before the batch was committed")

    for kills in range(4):
        try:
            run_batches(orders, f"{folder}/checkpoint", write)
        except StreamingQueryException:
            if len(failed) <= kills:  # not of our making
                raise
            if kills == 1:  # the rest runs on one merged part
                order_flow.pane_store(spark, panes).compact()
    rows = order_flow.pane_store(spark, panes).read()
    return rows.select(F.col("pane.start").cast("string").alias("pane"), "symbol", "total", "orders", F.col("newest").cast("string").alias("newest"))


@query(
    f"""{_PER_BATCH}, t AS (SELECT b, o_custkey, sum(amount * price) AS total FROM g JOIN newest ON g.batch <= b GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY total DESC, o_custkey) AS rank FROM t)
    SELECT b AS batch, string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY rank) AS "values" FROM r WHERE rank <= 5 GROUP BY b"""
)
def stream_top_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2, STR6, AGG14: the top clients after each batch; a batch writes only the totals that it changes."""
    folder = shared_folder(spark, "top-clients")
    add, sink = order_flow.to_totals(f"{folder}/totals", fan=2), batches.to_folder(f"{folder}/out")

    def write(changed: DataFrame, batch_id: int) -> None:
        add(changed, batch_id)
        sink(order_flow.top_clients(order_flow.total_store(changed.sparkSession, f"{folder}/totals").read()), batch_id)

    totals = order_flow.client_totals(order_batches(spark, sf_dir))
    batches.start(totals, f"{folder}/checkpoint", write, "update", interval=None).awaitTermination()
    out = spark.read.schema("metric string, values array<string>, batch bigint").parquet(f"{folder}/out")
    return out.select("batch", F.concat_ws(",", "values").alias("values"))


@query(f"{_PER_BATCH} SELECT batch, count(*) AS messages FROM g GROUP BY batch")
def stream_batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG12: the number of messages of each micro-batch."""
    folder = shared_folder(spark, "batch-sizes")
    run_batches(order_batches(spark, sf_dir), f"{folder}/checkpoint", batch_size(batches.to_folder(f"{folder}/out")))
    return spark.read.schema("messages bigint, batch bigint").parquet(f"{folder}/out")
