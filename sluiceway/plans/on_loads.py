"""Registered queries about loading: spools, inserts and loads that are repeated, ranges of equal depth, typed loads, mixed types."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.templates import route_lines
from sluiceway.operators import schema_versions, variants
from sluiceway.operators.depth import depth_ranges, in_ranges
from sluiceway.operators.ranking import value_chunks
from sluiceway.plans.on_orders import BATCHES, _PER_BATCH, order_batches, run_batches
from sluiceway.plans.registry import query, table
from sluiceway.session import shared_folder
from sluiceway.sinks.ledger import ChunkLoad, insert_once
from sluiceway.sources.messages import read_messages
from sluiceway.sources.spool import register_spool
from sluiceway.sources.tables import read_table
from sluiceway.sources.tolerant import read_csv_tolerant
from sluiceway.streaming import batches, orders as order_flow


@query(
    f"""{_PER_BATCH}
    SELECT CASE side WHEN 'B' THEN 'BUYS' ELSE 'SELLS' END AS key,
           CASE side WHEN 'B' THEN 'BUYS' ELSE 'SELLS' END || ',["' || count(*) || '"]' AS value FROM g GROUP BY batch, side"""
)
def spooled_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC14, SNK7-8, STR8: metrics of each batch as messages of a spool; the writing stream dies once, a second stream pulls them."""
    register_spool(spark)
    folder = shared_folder(spark, "spool")
    orders, died = order_batches(spark, sf_dir), []
    send = batches.to_messages("spool", path=f"{folder}/spool", writer="metrics")

    def write(batch: DataFrame, batch_id: int) -> None:
        send(order_flow.side_counts(batch), batch_id)
        if batch_id == 2 and not died:
            died.append(batch_id)
            raise RuntimeError("killed after the messages were sent")

    try:
        run_batches(orders, f"{folder}/checkpoint", write)
    except StreamingQueryException:
        if not died:
            raise
        run_batches(orders, f"{folder}/checkpoint", write)
    pulled = read_messages(spark, "spool", True, path=f"{folder}/spool", subscription="reports")
    batches.start(pulled, f"{folder}/pull", batches.to_folder(f"{folder}/out"), interval=None).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("key", F.col("value").cast("string").alias("value"))


@query(f"{_PER_BATCH} SELECT batch, o_orderkey AS orderid, symbol, amount FROM g")
def inserted_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5: every batch dies after half of its parts are in the target; the replay inserts the other half."""
    folder = shared_folder(spark, "insert")
    target, died = f"{folder}/target", set()
    schema = "symbol string, orderid bigint, amount int, batch_id bigint, part int"
    spark.createDataFrame([], schema).write.parquet(target)

    def append(rows: DataFrame) -> None:
        number = rows.select("batch_id").first()
        if number is not None and number[0] not in died:
            died.add(number[0])
            rows.where("part < 4").write.mode("append").parquet(target)
            raise RuntimeError("killed half way")
        rows.write.mode("append").parquet(target)

    def ledger(session: SparkSession, batch_id: int) -> DataFrame:
        return session.read.schema(schema).parquet(target).where(F.col("batch_id") == batch_id)

    add = insert_once(append, ledger, parts=8)
    orders = order_batches(spark, sf_dir).select("symbol", "orderid", "amount")
    for kills in range(BATCHES + 1):
        try:
            run_batches(orders, f"{folder}/checkpoint", add)
        except StreamingQueryException:
            if len(died) <= kills:  # not of our making
                raise
    return spark.read.schema(schema).parquet(target).select(F.col("batch_id").alias("batch"), "orderid", "symbol", "amount")


@query(
    """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"""
)
def resumed_chunk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK12, AGG16: a load in chunks of 20 months that stops twice and goes on with what is open."""
    folder = shared_folder(spark, "chunk-load")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"), F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    chunks = value_chunks(rows, "month", 20)
    while ChunkLoad(spark, f"{folder}/load", f"{folder}/target", "month").run(rows, chunks, at_most=2):
        pass
    return read_table(spark, f"{folder}/target")


_RANGES = 12


@query(
    f"""
    WITH v AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey % 9000 // 1000 AS k FROM lineitem),
    s AS (SELECT *, row_number() OVER (ORDER BY k) AS rn, count(*) OVER () AS n FROM v),
    cuts AS (SELECT i, min(k) AS cut FROM s, range(1, {_RANGES}) r(i) WHERE rn >= ceil(i * n / {_RANGES}.0) GROUP BY i),
    heavy AS (SELECT cut, count(*) AS times FROM cuts GROUP BY cut),
    inner_ AS (SELECT k, l_shipdate, row_number() OVER (PARTITION BY k ORDER BY l_shipdate) AS rn, count(*) OVER (PARTITION BY k) AS n FROM v),
    second AS (SELECT cut, i, min(l_shipdate) AS day FROM heavy JOIN inner_ ON k = cut, range(1, 100) r(i)
               WHERE i < times AND rn >= ceil(i * n / times) GROUP BY cut, i),
    placed AS (SELECT v.*, (SELECT min(cut) FROM heavy WHERE cut >= k) AS cut FROM v)
    SELECT p.l_orderkey, p.l_linenumber, p.cut IS NULL AS beyond, p.cut,
           CASE WHEN h.times > 1 AND p.k = p.cut THEN (SELECT count(*) FROM second s WHERE s.cut = p.cut AND s.day < p.l_shipdate)
                WHEN h.times > 1 THEN -1 END AS inside
    FROM placed p LEFT JOIN heavy h ON p.cut = h.cut"""
)
def equal_depth_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6-7, AGG10, AGG16: ranges of equal depth over a column with few values; the heavy ones are cut by the day of shipping."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.floor(F.col("l_partkey") % 9000 / 1000).cast("bigint").alias("k")
    )
    ranges = depth_ranges(rows, "k", _RANGES, "l_shipdate", accuracy=10_000_000)
    numbered = in_ranges(rows, ranges)
    split, seen = {}, {}
    for i, r in enumerate(ranges):
        if r.inside is not None:
            seen[r.high] = seen.get(r.high, -1) + 1
            split[i] = seen[r.high]
    heavy = {ranges[i].high for i in split}
    cut = F.coalesce(*[F.when(F.col("range") == i, F.lit(r.cut)) for i, r in enumerate(ranges)])
    inside = F.coalesce(*[F.when(F.col("range") == i, F.lit(split.get(i, -1 if r.cut in heavy else None))) for i, r in enumerate(ranges)])
    return numbered.select("l_orderkey", "l_linenumber", cut.isNull().alias("beyond"), cut.cast("bigint").alias("cut"), inside.cast("bigint").alias("inside"))


_BAD = "o_orderkey % 10 = 3"


@query(
    f"""
    SELECT o_orderkey, 'good' AS kind, CAST(floor(o_totalprice) AS INTEGER) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day,
           CASE WHEN o_orderkey % 7 = 0 THEN '{{"note":"late"}}' END AS told FROM orders WHERE NOT {_BAD}
    UNION ALL
    SELECT o_orderkey, 'bad', NULL, NULL, CASE WHEN o_orderkey % 20 < 10 THEN 'amount:no int' ELSE 'amount:missing,day:no date' END
    FROM orders WHERE {_BAD}"""
)
def typed_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC17, FLT5: delimited files under a type schema: good rows with what the schema does not name, and rejects with reasons."""
    folder = shared_folder(spark, "tolerant")
    key, bad = F.col("o_orderkey"), F.col("o_orderkey") % 10 == 3
    amount = F.when(~bad, F.floor("o_totalprice").cast("string")).when(key % 20 < 10, F.lit("many"))
    lines = table(spark, sf_dir, "orders").select(
        F.when(key % 7 == 0, F.lit("late")).alias("note"),
        F.when(bad & (key % 20 >= 10), F.lit("someday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        amount.alias("Amount"),
        "o_orderkey",
    )
    lines.write.option("header", True).csv(folder)
    good, rejects = read_csv_tolerant(spark, folder, "o_orderkey bigint not null, amount int not null, day date")
    told = F.array_join(F.transform("reasons", lambda r: F.concat_ws(":", r["column"], r["reason"])), ",")
    return good.select("o_orderkey", F.lit("good").alias("kind"), "amount", F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("_rescued").alias("told")).unionByName(
        rejects.select(
            F.get_json_object("_rescued", "$.o_orderkey").cast("bigint").alias("o_orderkey"),
            F.lit("bad").alias("kind"),
            F.lit(None).cast("int").alias("amount"),
            F.lit(None).cast("string").alias("day"),
            told.alias("told"),
        )
    )


TEMPLATES = {
    "login": r"^%{WORD:who} logged in from %{NOTSPACE:host}$",
    "took": r"^%{WORD:kind}: user=%{INT:who} took %{NUMBER:ms} ms$",
    "code": r"^%{WORD:kind} failed with (?:code|status) %{INT:code}\.?$",
    "any_user": r"user=%{INT:who}",
}


@query(
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'took' WHEN 'error' THEN 'code' WHEN 'view' THEN 'any_user' WHEN 'signup' THEN 'login' END AS template,
           CASE event_type WHEN 'signup' THEN 'u' || user_id WHEN 'error' THEN NULL WHEN 'click' THEN CAST(user_id AS VARCHAR)
                           WHEN 'view' THEN CAST(user_id AS VARCHAR) END AS who,
           CASE event_type WHEN 'error' THEN CAST(event_id % 600 AS VARCHAR) END AS code
    FROM events"""
)
def routed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCL38: lines of several forms, each to the template that it fits."""
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    kind = F.col("event_type")
    line = (
        F.when(kind == "signup", F.concat(F.lit("u"), user, F.lit(" logged in from host-"), event))
        .when(kind == "click", F.concat(kind, F.lit(": user="), user, F.lit(" took "), event, F.lit(".5 ms")))
        .when(kind == "error", F.concat(F.lit("job failed with "), F.when(F.col("event_id") % 2 == 0, F.lit("code ")).otherwise(F.lit("status ")), (F.col("event_id") % 600).cast("string")))
        .when(kind == "view", F.concat(F.lit("seen by user="), user, F.lit(" in part")))
        .otherwise(F.concat(F.lit("nothing of user "), user))
    )
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    routed = route_lines(lines, "line", TEMPLATES)
    return routed.select("event_id", "template", F.col("fields")["who"].alias("who"), F.col("fields")["code"].alias("code"))


@query(
    """
    SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN user_id ELSE user_id + 0.5 END AS DOUBLE) AS amount,
           CASE WHEN event_id % 5 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS label,
           CASE WHEN event_id % 2 = 0 THEN event_id END AS number, event_id % 4 = 0 AS flag FROM events"""
)
def variant_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ9, SCL22: fields of mixed types; the type of each column is found in the data."""
    e = F.col("event_id")
    amount = F.when(e % 3 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".5")))
    label = F.when(e % 5 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    number = F.when(e % 2 == 0, e.cast("string")).otherwise(F.lit("null"))
    flag = F.when(e % 4 == 0, F.lit("true")).otherwise(F.lit("false"))
    body = F.concat(
        F.lit('{"amount": '), amount, F.lit(', "label": '), label, F.lit(', "number": '), number, F.lit(', "flag": '), flag, F.lit("}")
    )
    rows = table(spark, sf_dir, "events").select("event_id", body.alias("reading"))
    return variants.flatten_variant(variants.to_variant(rows, "reading"), "reading")


_FIRST = {"customers": {"id": "BIGINT", "first_name": "VARCHAR(255)", "segment": "VARCHAR(20)", "balance": "DOUBLE"}}


@query(
    """
    SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name || '!' ELSE c_name END AS full_name, c_mktsegment AS market,
           CASE WHEN c_custkey % 3 <> 2 THEN NULL ELSE CAST(c_nationkey AS INTEGER) END AS nation,
           CAST(c_custkey % 1000 AS DECIMAL(12, 2)) AS score
    FROM customer WHERE c_custkey % 11 <> 5"""
)
def cdc_schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR11, SCL24: changes of every customer before, between and after column changes, each read under the schema of its position."""
    c = table(spark, sf_dir, "customer")
    key, third = F.col("c_custkey"), F.col("c_custkey") % 3
    # Customers of remainder 0 change in the first schema, then in the second; 1 in the second; 2 in the last.
    first = F.to_json(F.struct(key.alias("id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")))
    score = (key % 1000).cast("string")
    name = F.when(third == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
    second = F.to_json(F.struct(key.alias("id"), name.alias("full_name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), score.alias("score")))
    last = F.to_json(F.struct(key.alias("id"), name.alias("full_name"), F.col("c_mktsegment").alias("market"), score.alias("score"), F.col("c_nationkey").alias("nation")))

    def message(op: str, file: str, pos, side: str, row):
        head = F.concat(F.lit('{"payload": {"op": "' + op + '", "source": {"file": "' + file + '", "table": "customers", "pos": '), pos.cast("string"))
        return F.concat(head, F.lit('}, "' + side + '": '), row, F.lit("}}"))

    messages = F.array(
        F.when(third == 0, message("c", "log.1", key, "after", first)),
        F.when(third <= 1, message("u", "log.2", key + 1000, "after", second)),
        F.when(third == 2, message("u", "log.3", key + 1000, "after", last)),
        F.when((key % 11 == 5) & (third == 2), message("d", "log.4", key, "before", last)),
        F.when((key % 11 == 5) & (third != 2), message("d", "log.2", key + 10**9, "before", second)),
    )
    ddl = [
        ("log.2", 1, "ALTER TABLE shop.customers RENAME COLUMN first_name TO full_name"),
        ("log.2", 2, "ALTER TABLE customers ADD COLUMN score INT;"),
        ("log.3", 1, "alter table `customers` change column `segment` `market` varchar(30)"),
        ("log.3", 2, "ALTER TABLE customers DROP balance"),
        ("log.3", 3, "ALTER TABLE customers ADD nation INT"),
        ("log.3", 4, "ALTER TABLE customers MODIFY COLUMN score DECIMAL(12,2)"),
        ("log.3", 4, "ALTER TABLE customers MODIFY COLUMN score DECIMAL(12,2)"),
        ("log.3", 5, "CREATE INDEX i ON customers (nation)"),
    ]
    told = spark.createDataFrame(ddl, "file string, pos bigint, ddl string")
    told = told.select(F.to_json(F.struct(F.struct("ddl", F.struct("file", "pos").alias("source")).alias("payload"))).alias("value"))
    stream = c.select(F.explode(messages).alias("value")).where("value IS NOT NULL").unionByName(told)
    versions = schema_versions.schema_versions(schema_versions.ddl_events(stream), _FIRST)
    return schema_versions.latest_rows(schema_versions.unwrap_maps(stream), versions, "customers", "id")
