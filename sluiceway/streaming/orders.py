"""Order-flow metrics: buys and sells per batch, top clients since the start, top stocks per hour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.ranking import top_k_per, top_names
from sluiceway.operators.records import parse_lines
from sluiceway.operators.tumbling import sliding_sum
from sluiceway.streaming import batches
from sluiceway.streaming.generations import Generations

# Fields of an order line, and the two sides.
ORDER_FIELDS = (
    ("time", "timestamp"),
    ("orderid", "bigint"),
    ("clientid", "bigint"),
    ("symbol", "string"),
    ("amount", "int"),
    ("price", "double"),
    ("side", "string"),
)
SIDES = {"B": "BUYS", "S": "SELLS"}


def parse_orders(messages: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Order lines to (orders, bad lines). A line needs all fields and a known side."""
    text = F.col(column).cast("string")
    return parse_lines(messages, text, ORDER_FIELDS, lambda order: order["side"].isin(*SIDES))


def side_counts(orders: DataFrame) -> DataFrame:
    """(metric, values) with the number of orders per side."""
    metric = F.when(F.col("side") == "B", SIDES["B"]).otherwise(SIDES["S"])
    counts = orders.groupBy(metric.alias("metric")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("metric", F.array(F.col("n").cast("string")).alias("values"))


def client_totals(orders: DataFrame) -> DataFrame:
    return batches.running_total(orders, ["clientid"], F.col("amount") * F.col("price"))


def top_clients(totals: DataFrame, k: int = 5) -> DataFrame:
    return top_names(totals, "total", "clientid", "TOP5CLIENTS", k)


def symbol_volume(orders: DataFrame, size: str = "60 minutes", slide: str = "5 minutes") -> DataFrame:
    """Amount per symbol over sliding windows of event time.

    On a stream, orders behind the watermark are dropped and open windows wait; ``to_panes`` does neither.
    """
    return sliding_sum(orders, ["symbol"], "time", "amount", size, slide)


def top_symbols(volume: DataFrame, k: int = 5) -> DataFrame:
    """(metric, window_end, values): the k symbols with the largest volume of each window."""
    best = top_k_per(volume, ["window"], "total", k, "symbol")
    ranked = F.array_sort(F.collect_list(F.struct("rank", "symbol")))
    return best.groupBy("window").agg(F.transform(ranked, lambda r: r["symbol"]).alias("values")).select(
        F.lit("TOP5STOCKS").alias("metric"), F.col("window.end").alias("window_end"), "values"
    )


def latest_volume(orders: DataFrame, size: str = "60 minutes") -> DataFrame:
    """Amount per symbol over the last ``size`` before the newest order."""
    newest = orders.select(F.max("time")).scalar()
    recent = orders.where(F.col("time") > newest - F.expr(f"INTERVAL {size}"))
    return recent.groupBy("symbol").agg(F.sum("amount").alias("total"))


def order_metrics(orders: DataFrame) -> DataFrame:
    """All four metrics of a bounded set of orders, as (metric, values)."""
    return (
        side_counts(orders)
        .unionByName(top_clients(client_totals(orders)))
        .unionByName(top_names(latest_volume(orders), "total", "symbol", "TOP5STOCKS"))
    )


PANES = "symbol string, pane struct<start: timestamp, end: timestamp>, total bigint, orders bigint, newest timestamp"
TICKS = "symbol string, time timestamp, total bigint"


def pane_store(spark: SparkSession, path: str, fan: int = 8) -> Generations:
    """Sums per symbol and pane since the stream began."""

    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy("symbol", "pane").agg(
            F.sum("total").alias("total"), F.sum("orders").alias("orders"), F.max("newest").alias("newest")
        )

    return Generations(spark, path, PANES, combine, "newest", fan=fan)


def tick_store(spark: SparkSession, path: str, size: str = "60 minutes", fan: int = 8) -> Generations:
    """Sums per symbol and instant over the last ``size``; what is older leaves when parts are merged."""

    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy("symbol", "time").agg(F.sum("total").alias("total"))

    return Generations(spark, path, TICKS, combine, "time", _micros(spark, size), fan)


def _micros(spark: SparkSession, size: str) -> int:
    return spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {size}"))).first()[0]


def to_panes(
    path: str, slide: str = "5 minutes", delay: str = "10 minutes", late: batches.BatchFunction | None = None, fan: int = 8
) -> batches.BatchFunction:
    """Add every micro-batch of orders to the amounts per symbol and pane in ``path``.

    No order is dropped: one that comes late counts in the pane of its own time. Orders more than ``delay``
    older than the newest order of the batches before go to ``late`` as well, if it is given. A repeated batch
    adds nothing, and gives ``late`` the same orders as before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store = pane_store(batch.sparkSession, path, fan)
        batch.persist()
        try:
            if late is not None:
                now = store.manifest()
                newest = now.high if now.last < batch_id else now.high_before
                limit = F.timestamp_micros(F.lit(newest).cast("bigint")) - F.expr(f"INTERVAL {delay}")
                late(batch.where(F.col("time") < limit), batch_id)
            panes = batch.groupBy("symbol", F.window("time", slide).alias("pane")).agg(
                F.sum("amount").alias("total"), F.count(F.lit(1)).alias("orders"), F.max("time").alias("newest")
            )
            store.append(panes, batch_id)
        finally:
            batch.unpersist()

    return write


def to_ticks(path: str, size: str = "60 minutes", fan: int = 8) -> batches.BatchFunction:
    """Add every micro-batch of orders to the amounts per symbol and instant in ``path``; a repeated batch adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        ticks = batch.groupBy("symbol", "time").agg(F.sum("amount").alias("total"))
        tick_store(batch.sparkSession, path, size, fan).append(ticks, batch_id)

    return write


def pane_windows(spark: SparkSession, path: str, size: str = "60 minutes", slide: str = "5 minutes") -> DataFrame:
    """``window, symbol, total`` of every window that an order lies in, those still open included."""
    panes = pane_store(spark, path).read().select("symbol", F.col("pane.start").alias("time"), "total")
    return sliding_sum(panes, ["symbol"], "time", "total", size, slide)


def running_volume(spark: SparkSession, path: str, size: str = "60 minutes") -> DataFrame:
    """``symbol, total`` over the last ``size`` before the newest order, to the instant; ``path`` is that of ``to_ticks``."""
    store = tick_store(spark, path, size)
    newest = store.manifest().high
    edge = None if newest is None else newest - store.horizon
    recent = store.read(edge).where(F.unix_micros("time") > F.lit(edge).cast("bigint"))
    return recent.groupBy("symbol").agg(F.sum("total").alias("total"))


def running_top(spark: SparkSession, path: str, size: str = "60 minutes", k: int = 5) -> DataFrame:
    """(metric, values): the symbols with the largest volume of the last ``size``."""
    return top_names(running_volume(spark, path, size), "total", "symbol", "TOP5STOCKS", k)


TOTALS = "clientid bigint, total double, batch bigint"


def total_store(spark: SparkSession, path: str, fan: int = 8) -> Generations:
    """The running total of every client: of several, the one of the last batch."""

    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy("clientid").agg(F.max_by("total", "batch").alias("total"), F.max("batch").alias("batch"))

    return Generations(spark, path, TOTALS, combine, fan=fan)


def to_totals(path: str, fan: int = 8) -> batches.BatchFunction:
    """Add the totals that a batch has changed; for ``client_totals`` in update mode."""

    def write(changed: DataFrame, batch_id: int) -> None:
        rows = changed.select("clientid", F.col("total").cast("double").alias("total"), F.lit(batch_id).cast("bigint").alias("batch"))
        total_store(changed.sparkSession, path, fan).append(rows, batch_id)

    return write


def start_order_metrics(
    orders: DataFrame,
    sink_of: Callable[[str], batches.BatchFunction],
    checkpoint: str,
    interval: str | None = "5 seconds",
    size: str = "60 minutes",
    slide: str = "5 minutes",
    delay: str = "10 minutes",
    late: batches.BatchFunction | None = None,
) -> list[StreamingQuery]:
    """Write the (metric, values) rows of all four metrics at every batch.

    Three queries share the source: counts per batch without state; one running sum per client, of which a batch
    writes the changed ones only; and sums per symbol and pane, and per symbol and instant, kept beside the checkpoint. From
    the last the top stocks of the running ``size`` are ranked at once, not only when a window closes, and without reading
    what is older. Late orders count, and go to ``late`` as well. ``sink_of`` gives the sink of ``sides``, ``clients`` and
    ``stocks``; each query numbers its own batches, so folders must differ.
    """
    panes, ticks, totals = (f"{checkpoint}/{name}" for name in ("stock-panes", "stock-ticks", "client-totals"))
    add, tick, change = to_panes(panes, slide, delay, late), to_ticks(ticks, size), to_totals(totals)
    sinks = {name: sink_of(name) for name in ("sides", "clients", "stocks")}

    def sides(batch: DataFrame, batch_id: int) -> None:
        sinks["sides"](side_counts(batch), batch_id)

    def clients(batch: DataFrame, batch_id: int) -> None:
        change(batch, batch_id)
        sinks["clients"](top_clients(total_store(batch.sparkSession, totals).read()), batch_id)

    def stocks(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            add(batch, batch_id)
            tick(batch, batch_id)
        finally:
            batch.unpersist()
        sinks["stocks"](running_top(batch.sparkSession, ticks, size), batch_id)

    return [
        batches.start(orders, f"{checkpoint}/sides", sides, "append", interval),
        batches.start(client_totals(orders), f"{checkpoint}/clients", clients, "update", interval),
        batches.start(orders, f"{checkpoint}/stocks", stocks, "append", interval),
    ]
