"""What the physical plans must and must not hold."""

import datetime as dt

from helpers import plan_of, rows
from pyspark.sql import functions as F

from sluiceway.operators.counters import repair_counter
from sluiceway.operators.labelling import backfill, label_ahead
from sluiceway.plans import mart, on_devices, on_events, on_orders, telemetry
from sluiceway.sinks.files import write_partitioned
from sluiceway.sources.tables import read_table


def test_partition_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("month", F.date_format("o_orderdate", "MM"))
    write_partitioned(rows, f"{tmp_path}/t", ["month"])
    scan = read_table(spark, f"{tmp_path}/t", {"month": "08"}).select("o_orderkey")
    text = plan_of(scan)
    assert "PartitionFilters: [isnotnull(month" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_device_plan_stays_in_the_jvm(spark, sf_dir):
    decoded = telemetry.decode(on_devices.telemetry_rows(spark, sf_dir))
    for df in (decoded, telemetry.repair(decoded, []), telemetry.ten_minutes(decoded, [])):
        text = plan_of(df)
        assert "Python" not in text and "ArrowEval" not in text


def test_repair_needs_one_shuffle_of_the_detail(spark, sf_dir):
    events = on_events.readings(spark, sf_dir)
    text = plan_of(repair_counter(events, ["k", "cents"], ["user_id"], "ts"))
    # Detail and edge rows once; the summary by slice and then by key.
    assert text.count("Exchange") == 3
    assert text.count("SortAggregate") == 0
    # Only the read columns of the summary: no props text of other columns, no value of the detail.
    assert text.count("+- Window") == 2


def test_no_frame_is_quadratic(spark, sf_dir):
    events = on_events.labelled_events(spark, sf_dir)
    for df in (
        label_ahead(events, ["user_id"], "ts", "errorlabel"),
        backfill(events, ["user_id"], "ts", ["errorlabel"]),
        repair_counter(events, ["errorlabel"], ["user_id"], "ts"),
    ):
        for frame in plan_of(df).split("specifiedwindowframe(")[1:]:
            bounds = frame[: frame.index("))") + 1]
            if "unboundedfollowing" in bounds:
                # A whole-partition frame over the few summary rows of a key is evaluated once.
                assert "unboundedpreceding" in bounds


def test_membership_is_a_semi_join(spark, sf_dir):
    assert "LeftSemi" in plan_of(on_orders.customer_semi(spark, sf_dir))
    assert "LeftSemi" in plan_of(on_devices.device_semi(spark, sf_dir))


def test_mart_joins_share_the_shuffle_of_the_base(spark, sf_dir):
    """With broadcasts off, the telemetry of a family is shuffled once for three joins."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(10).selectExpr("string(id) AS macaddress", "string(id) AS start", "id AS x")
        sides = [base.selectExpr("macaddress", "start", f"x AS y{i}") for i in range(3)]
        text = plan_of(mart.chain_left(base, sides, mart.KEYS))
        assert text.count("SortMergeJoin") == 3
        assert text.count("Exchange") == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    text = plan_of(on_events.telemetry_10min(spark, sf_dir))
    assert "partial_max_by" in text
    assert text.count("Exchange") == 1


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(on_orders.top5_clients(spark, sf_dir))
    assert "WindowGroupLimit" in plan_of(on_orders.top5_symbols_60m(spark, sf_dir))


def test_stored_mart_equals_the_mart_of_the_same_windows(spark, sf_dir, tmp_path):
    """Five month jobs and the mart over their folders, against the mart of the same windows at once."""
    run_date, folders = dt.date(2024, 2, 3), {}
    zone = on_devices.month_zone(spark, on_devices.telemetry_rows(spark, sf_dir), "readings")
    telemetry.month_job(spark, zone, f"{tmp_path}/readings", run_date, [], "12 hours")
    folders["readings"] = f"{tmp_path}/readings"
    records = {
        "connection": on_devices.side_rows(spark, sf_dir, on_devices._CONNECTION, on_devices._CONNECTION_WHERE),
        "status": on_devices.side_rows(spark, sf_dir, on_devices._STATUS, on_devices._STATUS_WHERE),
        "device": on_devices.side_rows(spark, sf_dir, on_devices._DEVICE, on_devices._DEVICE_WHERE),
        "error": on_devices.error_rows(spark, sf_dir),
    }
    for side, rows_ in records.items():
        folders[side] = f"{tmp_path}/{side}"
        telemetry.side_month_job(spark, side, on_devices.month_zone(spark, rows_, side), folders[side], run_date)
    families = {2: F.col("additionalvalue") == 0, 3: F.col("additionalvalue") == 1}
    tiebreak = ["operationmode", "hotwatertemperaturemin", "boilercontrollerswsubversion"]
    stored = mart.stored_mart(spark, folders, families, None, f"{tmp_path}/mart", run_date, tiebreak, "12 hours")
    tables = {name: read_table(spark, folder) for name, folder in folders.items()}
    joined = mart.family_rows(
        {n: tables["readings"].where(c) for n, c in families.items()}, tables["status"], tables["error"], tables["device"]
    )
    at_once = mart.build_mart(joined, tables["connection"], None, tiebreak, slice_width="12 hours")
    columns = sorted(at_once.columns)
    assert rows(stored.select(*columns)) == rows(at_once.select(*columns)) != []
    again = mart.stored_mart(spark, folders, families, None, f"{tmp_path}/mart", run_date, tiebreak, "12 hours")
    assert again.count() == at_once.count()  # a repeated run replaces the month


def test_packed_flags_give_the_same_windows(spark, sf_dir):
    raw = on_devices.telemetry_rows(spark, sf_dir)
    for align in ("left", "positional"):
        plain = telemetry.ten_minutes(telemetry.decode(raw, align), [])
        packed = telemetry.ten_minutes(telemetry.decode(raw, align, packed=True), [])
        assert plain.columns == packed.columns and [f.dataType for f in plain.schema] == [f.dataType for f in packed.schema]
        assert rows(plain) == rows(packed)


def test_windows_are_aggregated_where_their_slices_lie(spark, sf_dir):
    readings = telemetry.decode(on_devices.telemetry_rows(spark, sf_dir), packed=True).localCheckpoint()
    # Detail and edge rows once; the summary by slice and then by key.
    assert plan_of(telemetry.ten_minutes(readings, [], "6 hours")).count("Exchange hashpartitioning") == 3
    # A slice that is no multiple of the window needs a shuffle of its own, and gives the same rows.
    odd = telemetry.ten_minutes(readings, [], "15 minutes")
    assert plan_of(odd).count("Exchange hashpartitioning") == 4
    assert rows(odd) == rows(telemetry.ten_minutes(readings, [], "6 hours"))


def test_mart_reads_stored_readings(spark, sf_dir):
    assert "Window" not in plan_of(on_devices.ten_minute_state(spark, sf_dir))
