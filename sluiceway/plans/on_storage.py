"""Registered queries that write, change and read tables and files in the shared folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.operators.columns import split_path_parts, with_load_time
from sluiceway.plans.registry import query, table
from sluiceway.session import shared_folder
from sluiceway.sinks import tables as table_sink
from sluiceway.sinks.files import write_csv, write_partitioned
from sluiceway.sources.tables import read_csv, read_ndjson, read_raw_zone, read_table, run_sql, select_all, with_position

_DATED = "strftime(o_orderdate, '%Y') AS \"year\", strftime(o_orderdate, '%m') AS \"month\""


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        "o_orderstatus",
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"),
    )


def new_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name that no other run uses, and its folder."""
    return f"{name}_{uuid.uuid4().hex}", shared_folder(spark, name)


_DDL = "o_orderkey BIGINT, o_custkey BIGINT, cents BIGINT, o_orderstatus STRING, year STRING, month STRING"
_ROWS = f"SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus, {_DATED} FROM orders"


@query(f"SELECT * FROM ({_ROWS}) WHERE \"year\" = '1997' AND \"month\" = '03'")
def partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1-2, SNK1, FLT10: partitioned write, then a scan of one month's folders only."""
    folder = shared_folder(spark, "orders-by-month")
    write_partitioned(dated_orders(spark, sf_dir), folder, ["year", "month"], sort=["o_orderkey"])
    return read_table(spark, folder, {"year": "1997", "month": "03"})


@query(f"SELECT o_orderkey, cents, \"year\", \"month\" FROM ({_ROWS}) WHERE \"year\" IN ('1995', '1997')")
def partition_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1-2, SNK1: rows read from one zone keep their folder names, ``month=03``, in the next one."""
    first, second = shared_folder(spark, "zone-one"), shared_folder(spark, "zone-two")
    write_partitioned(dated_orders(spark, sf_dir).select("o_orderkey", "cents", "year", "month"), first, ["year", "month"])
    for year in ("1995", "1997"):
        write_partitioned(read_table(spark, first, {"year": year}), second, ["year", "month"])
    return read_table(spark, second)


@query(f"SELECT o_orderkey, cents, \"month\", 'O' AS status, '1' AS load FROM ({_ROWS}) WHERE o_orderstatus = 'O'")
def raw_zone_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, PRJ4: folders named ``status-O/load-1``; only the wanted ones are listed."""
    folder = shared_folder(spark, "raw-zone")
    rows = dated_orders(spark, sf_dir)
    for status in ("F", "O", "P"):
        part = rows.where(F.col("o_orderstatus") == status).select("o_orderkey", "cents", "month")
        part.write.parquet(f"{folder}/status-{status}/load-1")
    return read_raw_zone(spark, folder, {"status": "O", "load": "*"})


@query(
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y') AS "year", strftime(o_orderdate, '%m') AS "month" FROM orders"""
)
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DT10: raw path parts as columns."""
    parts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "'year-'yyyy").alias("partition_1"),
        F.date_format("o_orderdate", "'month-'MM").alias("partition_2"),
    )
    return split_path_parts(parts, {"partition_1": "year", "partition_2": "month"})


@query(
    """
    SELECT c_custkey, c_name, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, 'a "b"' || chr(10) || c_mktsegment AS note,
           CASE WHEN c_custkey % 2 = 0 THEN '2021-03-04_05-06-07' ELSE '2021-03-05_00-00-00' END AS stamp FROM customer"""
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5, SNK2-3: delimited text with a header, quotes and line breaks."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
        F.concat(F.lit('a "b"\n'), "c_mktsegment").alias("note"),
    )
    target = shared_folder(spark, "customers-csv")
    stamps = (dt.datetime(2021, 3, 4, 5, 6, 7), dt.datetime(2021, 3, 5))
    folders = [write_csv(rows.where(F.col("c_custkey") % 2 == i), target, stamp=s, escape='"') for i, s in enumerate(stamps)]
    schema = "c_custkey BIGINT, c_name STRING, cents BIGINT, note STRING"
    first, second = (
        read_csv(spark, f, schema, multiLine="true", escape='"').withColumn("stamp", F.lit(f.rsplit("/", 1)[1])) for f in folders
    )
    return first.unionByName(second)


@query("SELECT o_orderkey, o_orderstatus, CAST(0 AS BIGINT) AS displaced FROM orders")
def sorted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1: rows of partitioned files, and how far each stands from its place in the order of its file."""
    folder = shared_folder(spark, "sorted-files")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_partitioned(rows, folder, ["o_orderstatus"], sort=["o_custkey", "o_orderkey"])
    placed = with_position(spark, folder)
    wanted = F.row_number().over(Window.partitionBy("o_orderstatus", "file").orderBy("o_custkey", "o_orderkey")) - 1
    return placed.select("o_orderkey", "o_orderstatus", (F.col("row") - wanted).alias("displaced"))


@query("SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS missing FROM events")
def ndjson_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC16, SNK6, SCL23: JSON lines, appended to a table that is created with a declared schema."""
    name, place = new_table(spark, "json_events")
    folder = shared_folder(spark, "events-json")
    table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props").write.json(folder)
    rows = read_ndjson(spark, folder, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    declared = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, missing STRING"
    table_sink.append_table(rows.where(F.col("value") < 50), name, declared, path=place)
    table_sink.append_table(rows.where(F.col("value") >= 50), name, declared, path=place)
    return spark.table(name)


@query(
    f"""
    SELECT * FROM ({_ROWS}) WHERE o_orderstatus <> 'P' AND "year" <> '1996'
    UNION ALL SELECT o_orderkey, o_custkey, cents + 1, o_orderstatus, "year", "month" FROM ({_ROWS}) WHERE "year" = '1996'"""
)
def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK12, SNK14: one write replaces only the partitions it holds rows for."""
    name, folder = new_table(spark, "orders_by_year")
    table_sink.create_table(spark, name, _DDL, folder, partition_by=["year"])
    rows = dated_orders(spark, sf_dir)
    table_sink.overwrite_table(rows.where(F.col("o_orderstatus") != "P"), name)
    table_sink.overwrite_partitions(rows.where(F.col("year") == "1996").withColumn("cents", F.col("cents") + 1), name)
    return spark.table(name)


@query(f"SELECT * FROM ({_ROWS}) WHERE o_orderstatus <> 'F'")
def insert_and_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK10-11: overwrite drops the earlier rows, insert adds to them."""
    name, folder = new_table(spark, "orders_plain")
    table_sink.create_table(spark, name, _DDL, folder)
    rows = dated_orders(spark, sf_dir)
    table_sink.insert_into(rows.where(F.col("o_orderstatus") == "F"), name)
    table_sink.overwrite_table(rows.where(F.col("o_orderstatus") == "O"), name)
    # Other column order, to show that columns are matched by name.
    table_sink.insert_into(rows.where(F.col("o_orderstatus") == "P").select("month", *rows.columns[:-1]), name)
    return select_all(spark, name)


@query(
    """
    SELECT c_mktsegment AS segment, CASE WHEN c_acctbal < 0 THEN 'owing' WHEN c_acctbal < 5000 THEN 'even' ELSE 'rich' END AS standing,
           count(*) AS customers FROM customer WHERE c_custkey >= 10 GROUP BY ALL"""
)
def table_from_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK13, SRC8-10, SCL12: SQL text over a named frame, stored as a new table and read back."""
    name, folder = new_table(spark, "standings")
    rows = run_sql(
        spark,
        """
        SELECT c_mktsegment AS segment,
               CASE WHEN c_acctbal < 0 THEN 'owing' WHEN c_acctbal < 5000 THEN 'even' ELSE 'rich' END AS standing,
               count(*) AS customers
        FROM {customers} WHERE c_custkey >= :first GROUP BY ALL""",
        {"first": 10},
        customers=table(spark, sf_dir, "customer"),
    )
    table_sink.create_table_as(rows, name, folder)
    return select_all(spark, name)


@query(f"SELECT * FROM ({_ROWS}) WHERE \"year\" <> '1999'")
def truncate_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK15: the rows of one partition are deleted."""
    name, folder = new_table(spark, "orders_truncated")
    table_sink.create_table(spark, name, _DDL, folder, partition_by=["year"])
    table_sink.overwrite_partitions(dated_orders(spark, sf_dir), name)
    table_sink.truncate_table(spark, name, {"year": "1999"})
    return spark.table(name)


@query(
    """
    SELECT o_orderkey, "year", half FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y') AS "year",
           CASE WHEN month(o_orderdate) < 7 THEN 'it''s 1' ELSE 'b\\2' END AS half FROM orders)
    WHERE "year" <> '1995' AND NOT ("year" IN ('1997', '1998') AND half = 'it''s 1')"""
)
def purged_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK15: on two levels, a whole year and one value of listed years are emptied; values hold quotes."""
    name, folder = new_table(spark, "orders_purged")
    table_sink.create_table(spark, name, "o_orderkey BIGINT, year STRING, half STRING", folder, partition_by=["year", "half"])
    half = F.when(F.month("o_orderdate") < 7, "it's 1").otherwise("b\\2")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("year"), half.alias("half"))
    table_sink.overwrite_partitions(rows, name)
    table_sink.truncate_table(spark, name, {"year": "1995"})
    table_sink.truncate_table(spark, name, {"year": ["1997", "1998", "2050"], "half": "it's 1"})
    return spark.table(name)


@query(_ROWS)
def recovered_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK16: folders written beside a table become its partitions."""
    name, folder = new_table(spark, "orders_recovered")
    table_sink.create_table(spark, name, _DDL, folder, partition_by=["year"])
    write_partitioned(dated_orders(spark, sf_dir), folder, ["year"])
    table_sink.recover_partitions(spark, name)
    return spark.table(name)


@query(
    """
    SELECT c_custkey, c_name, 'new' AS batch FROM customer UNION ALL SELECT c_custkey, c_name, 'kept' FROM customer"""
)
def load_data_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC17: a delimited file replaces one partition of a table and leaves the other alone."""
    name, folder = new_table(spark, "customers_loaded")
    table_sink.create_table(spark, name, "c_custkey BIGINT, c_name STRING, batch STRING", folder, partition_by=["batch"])
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for batch in ("new", "kept"):
        table_sink.insert_into(rows.withColumn("batch", F.lit(batch)), name)
    file = write_csv(rows, shared_folder(spark, "customers-file"))
    table_sink.load_data(spark, file, name, {"batch": "new"}, overwrite=True)
    return spark.table(name)


@query("SELECT s_suppkey, s_name, true AS stamped FROM supplier")
def dropped_and_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK9, SNK15, PRJ11: a dropped table takes its rows along; the new one has a load time."""
    name, folder = new_table(spark, "suppliers")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    table_sink.create_table_as(rows, name, folder)
    table_sink.drop_table(spark, name)
    table_sink.create_table(spark, name, "s_suppkey BIGINT, s_name STRING, loaded_at TIMESTAMP", folder)
    table_sink.insert_into(with_load_time(rows), name)
    return read_table(spark, name).select("s_suppkey", "s_name", F.col("loaded_at").isNotNull().alias("stamped"))
