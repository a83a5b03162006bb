"""Streams over file chunks: the end state equals the batch answer, also after a restart and with late rows."""

import datetime as dt
import os
from dataclasses import replace

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sluiceway.operators.tumbling import sliding_sum
from sluiceway.plans.registry import load_all
from sluiceway.sources.messages import read_folder_stream, read_messages
from sluiceway.streaming import batches, orders, words
from sluiceway.streaming.generations import Generations
from sluiceway.streaming.changes import read_latest_state, start_latest_changes

T0 = dt.datetime(2020, 1, 1)


def write_lines(folder, name, lines):
    """A file for the stream. Files are taken by time, so each is a second newer than the one before."""
    folder.mkdir(exist_ok=True)
    newest = max((f.stat().st_mtime for f in folder.iterdir()), default=1_600_000_000)
    (folder / name).write_text("\n".join(lines) + "\n")
    os.utime(folder / name, (newest + 1, newest + 1))


def order_line(minute, key, client, symbol, amount, side="B"):
    at = T0 + dt.timedelta(minutes=minute)
    return f"{at:%Y-%m-%d %H:%M:%S},{key},{client},{symbol},{amount},2.0,{side}"


def run(query):
    query.awaitTermination()


def last_batch(spark, path):
    written = spark.read.parquet(path)
    return written.where(F.col("batch") == written.agg(F.max("batch")).first()[0]).drop("batch")


def order_source(spark, folder):
    return orders.parse_orders(read_messages(spark, "text", True, path=str(folder), maxFilesPerTrigger="1"))[0]


def test_running_total_survives_a_restart(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/cp"

    def go():
        totals = orders.client_totals(order_source(spark, source))
        run(batches.start(totals, checkpoint, batches.to_folder(out), "complete", interval=None))

    write_lines(source, "a.txt", [order_line(0, 1, 7, "X", 5), order_line(0, 2, 8, "X", 1), "bad line"])
    go()
    write_lines(source, "b.txt", [order_line(1, 3, 7, "Y", 10, "S")])
    go()
    assert rows(last_batch(spark, out)) == [(7, 30.0), (8, 2.0)]


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    write = batches.to_folder(f"{tmp_path}/out")
    for _ in range(2):
        write(spark.range(3), 0)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_metrics_of_each_query(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.txt", [order_line(0, 1, 7, "X", 5), order_line(1, 2, 8, "Y", 9, "S")])
    write_lines(source, "b.txt", [order_line(2, 3, 7, "X", 10)])
    write_lines(source, "c.txt", [order_line(600, 4, 7, "Z", 1)])
    started = orders.start_order_metrics(
        order_source(spark, source), lambda name: batches.to_folder(f"{tmp_path}/out/q={name}"), f"{tmp_path}/cp", interval=None
    )
    for query in started:
        run(query)
    out = spark.read.parquet(f"{tmp_path}/out")
    sides = out.where("q = 'sides'").groupBy("metric").agg(F.sum(F.get("values", F.lit(0)).cast("int")).alias("n"))
    assert rows(sides) == [("BUYS", 3), ("SELLS", 1)]
    clients = out.where("q = 'clients'").orderBy(F.desc("batch")).first()
    assert clients["values"] == ["7", "8"]
    # The running hour after each batch, in some order of the files: the early orders rank X above Y.
    stocks = [r["values"] for r in out.where("q = 'stocks'").orderBy("batch").collect()]
    assert stocks and all(s in (["X"], ["Y", "X"], ["X", "Y"], ["Z"]) for s in stocks) and stocks[-1] == ["Z"]


def test_late_orders_count_and_are_reported(spark, tmp_path):
    source, late = tmp_path / "in", []
    write_lines(source, "a.txt", [order_line(0, 1, 7, "X", 5), order_line(90, 2, 8, "Y", 9)])
    write_lines(source, "b.txt", [order_line(1, 3, 7, "X", 10), order_line(85, 4, 8, "Y", 1)])
    add = orders.to_panes(f"{tmp_path}/panes", late=lambda df, i: late.extend(r.orderid for r in df.collect()))
    run(batches.start(order_source(spark, source), f"{tmp_path}/cp", add, interval=None))
    assert late == [3]
    windows = orders.pane_windows(spark, f"{tmp_path}/panes")
    assert {r.symbol: r.total for r in windows.groupBy("symbol").agg(F.max("total").alias("total")).collect()} == {"X": 15, "Y": 10}
    before = rows(windows)
    orders.pane_store(spark, f"{tmp_path}/panes").compact()
    assert rows(orders.pane_windows(spark, f"{tmp_path}/panes")) == before


@pytest.mark.parametrize("fan", [2, 8])
def test_running_hour_is_exact(spark, tmp_path, fan):
    """The order of 10:02 is out of the hour that ends at 11:02; late orders of the hour count, replays do not."""
    ticks = f"{tmp_path}/ticks"
    add = orders.to_ticks(ticks, fan=fan)
    schema = "symbol string, time timestamp, amount int"
    seen, newest = [], T0
    for batch, minutes in enumerate([[2, 30], [62, 1], [61, 3, 2], [200], [150, 139, 300]]):
        part = [("AB"[m % 2], T0 + dt.timedelta(minutes=m), m) for m in minutes]
        seen += part
        for _ in range(2):
            add(spark.createDataFrame(part, schema), batch)
        newest = max([newest, *(t for _, t, _ in part)])
        want = {}
        for symbol, time, amount in seen:
            if time > newest - dt.timedelta(minutes=60):
                want[symbol] = want.get(symbol, 0) + amount
        assert rows(orders.running_volume(spark, ticks)) == sorted(want.items())
    assert rows(orders.running_top(spark, ticks)) == [("TOP5STOCKS", ["A"])]
    assert all(p.high > orders.tick_store(spark, ticks).manifest().high - 3600 * 10**6 for p in orders.tick_store(spark, ticks).manifest().parts)


def test_running_hour_of_nothing(spark, tmp_path):
    assert rows(orders.running_volume(spark, f"{tmp_path}/none")) == []
    add = orders.to_ticks(f"{tmp_path}/ticks")
    add(spark.createDataFrame([], "symbol string, time timestamp, amount int"), 0)
    assert rows(orders.running_volume(spark, f"{tmp_path}/ticks")) == []


def sums(spark, path, **options):
    return Generations(spark, path, "k bigint, n bigint", lambda r: r.groupBy("k").agg(F.sum("n").alias("n")), **options)


def test_generations(spark, tmp_path):
    store = sums(spark, f"{tmp_path}/g", fan=3)
    for batch in range(20):
        rows_ = spark.range(4).select(F.col("id").alias("k"), F.lit(batch).cast("bigint").alias("n"))
        assert store.append(rows_, batch)
        assert not store.append(rows_, batch)  # a replay, also of batches that are merged already
        assert not store.append(rows_, 0)
        parts = store.manifest().parts
        assert [p.first for p in parts] == [0, *(p.last + 1 for p in parts[:-1])] and parts[-1].last == batch
        assert len(parts) <= 6
    want = [(k, sum(range(20))) for k in range(4)]
    assert rows(store.read()) == want
    store.compact()
    assert len(store.manifest().parts) == 1 and rows(store.read()) == want and not store.append(rows_, 19)
    assert store.vacuum() > 0 and rows(store.read()) == want and store.vacuum() == 0
    assert store.append(spark.createDataFrame([(0, 1)], "k bigint, n bigint"), 25)  # numbers may leave gaps
    assert rows(store.read())[0] == (0, 191)


def test_a_batch_that_died_before_its_manifest_leaves_nothing(spark, tmp_path):
    store = sums(spark, f"{tmp_path}/g")
    one = spark.createDataFrame([(0, 1)], "k bigint, n bigint")
    store.append(one, 0)
    one.write.parquet(f"{tmp_path}/g/parts/1-1-died")
    assert rows(store.read()) == [(0, 1)] and store.append(one, 1) and rows(store.read()) == [(0, 2)]
    assert store.vacuum() >= 1 and rows(store.read()) == [(0, 2)]


def test_second_writer_is_refused(spark, tmp_path):
    a, b = sums(spark, f"{tmp_path}/g"), sums(spark, f"{tmp_path}/g")
    one = spark.createDataFrame([(0, 1)], "k bigint, n bigint")
    a.append(one, 0)
    stale = b.manifest()
    a.append(one, 1)
    with pytest.raises(RuntimeError, match="another writer"):
        b._publish(replace(stale, number=stale.number + 1))
    assert rows(a.read()) == [(0, 2)]
    with pytest.raises(ValueError):
        sums(spark, f"{tmp_path}/g", horizon=1)


def test_only_changed_counts_are_added(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.txt", ["мир и мир", "дом"])
    write_lines(source, "b.txt", ["дом мир"])
    messages = read_folder_stream(spark, str(source), "value string", "text", files_per_batch=1)
    run(words.keep_word_counts(messages, "value", f"{tmp_path}/n", f"{tmp_path}/cp", interval=None, fan=9))
    stop = spark.createDataFrame([("и",)], "word string")
    assert [tuple(r) for r in words.read_word_counts(spark, f"{tmp_path}/n", stop).collect()] == [("мир", 3), ("дом", 2)]
    assert spark.read.parquet(f"{tmp_path}/n/parts/*").count() == 5


def test_sliding_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    early = [order_line(m, m, 1, "AB"[m % 2], m) for m in range(0, 90, 7)]
    write_lines(source, "a.txt", early)
    write_lines(source, "b.txt", [order_line(1000, 900, 1, "A", 1)])
    write_lines(source, "c.txt", [order_line(3, 901, 1, "A", 5000), order_line(1001, 902, 1, "A", 1)])
    timed = order_source(spark, source).withWatermark("time", "10 minutes")
    volume = orders.symbol_volume(timed, "60 minutes", "10 minutes")
    run(batches.start(volume, f"{tmp_path}/cp", batches.to_folder(f"{tmp_path}/out"), "append", interval=None))
    kept = spark.createDataFrame([(v,) for v in early], "value string")
    expected = sliding_sum(orders.parse_orders(kept)[0], ["symbol"], "time", "amount", "60 minutes", "10 minutes")
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("window.start", "symbol", "total")) == rows(
        expected.select("window.start", "symbol", "total")
    )


def test_sliding_sum_rejects_uneven_panes(spark):
    with pytest.raises(ValueError):
        sliding_sum(spark.range(1), ["id"], "id", "id", "60 minutes", "7 minutes")


def test_word_counts_are_sorted(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.txt", ["мир и мир", "дом"])
    write_lines(source, "b.txt", ["дом мир"])
    seen, sizes = [], []
    messages = read_folder_stream(spark, str(source), "value string", "text", files_per_batch=1)
    stop = spark.createDataFrame([("и",)], "word string")
    run(words.start_word_count(messages, "value", stop, lambda df, i: seen.append(df.collect()), f"{tmp_path}/cp", interval=None))
    assert [tuple(r) for r in seen[-1]] == [("мир", 3), ("дом", 2)]
    write = words.batch_size(lambda df, i: sizes.append(df.first()[0]))
    run(batches.start(messages, f"{tmp_path}/cp2", write, interval=None))
    assert sum(sizes) == 3


def test_latest_changes_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    schema = "op string, ts_ms bigint, pos bigint, row struct<id: int, name: string>"
    for i, data in enumerate([[("c", 1, 1, (1, "a")), ("c", 1, 2, (2, "x"))], [("u", 2, 3, (1, "b"))], [("d", 3, 4, (2, "x")), ("c", 1, 1, (1, "a"))]]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(str(source / f"{i}"))
    stream = read_folder_stream(spark, f"{source}/*", schema, "json", files_per_batch=1)
    run(start_latest_changes(stream, ["id"], f"{tmp_path}/out", f"{tmp_path}/cp", interval=None))
    assert rows(read_latest_state(spark, f"{tmp_path}/out", ["id"], "id: int, name: string")) == [(1, "b")]


def test_append_parsed_is_exactly_once(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.txt", [order_line(0, 1, 7, "X", 5)])
    for _ in range(2):
        run(batches.append_parsed(order_source(spark, source), f"{tmp_path}/t", f"{tmp_path}/cp", None))
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1


@pytest.mark.parametrize("name", ["stream_word_count", "stream_word_order"])
def test_word_streams_of_a_table_in_several_files(spark, tmp_path, sf_dir, name):
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    run_query = load_all()[name].run
    of_file = rows(run_query(spark, sf_dir))
    assert len(of_file) > 1000 and rows(run_query(spark, str(tmp_path))) == of_file


def test_folder_stream_of_one_file_leaves_others(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        write_lines(tmp_path / "in", name, [name])
    stream = read_folder_stream(spark, f"{tmp_path}/in/a.txt", "value string", "text")
    run(batches.start(stream, f"{tmp_path}/checkpoint", batches.to_folder(f"{tmp_path}/out"), interval=None))
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("value")) == [("a.txt",)]
