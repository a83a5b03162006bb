"""Spools, repeated inserts and loads, ranges of equal depth, typed loads, templates, mixed types, schema versions."""

import datetime as dt
import json
import os
import random
import re

import duckdb
import pytest
from compare import compare
from helpers import plan_of, rows
from pyspark.sql import functions as F

from sluiceway.functions.templates import literals, route_lines
from sluiceway.functions.text import capture_fields, capture_pattern
from sluiceway.operators import schema_versions as versions
from sluiceway.operators import variants
from sluiceway.operators.depth import depth_ranges, in_ranges
from sluiceway.plans.registry import load_all
from sluiceway.sinks.ledger import ChunkLoad, insert_once
from sluiceway.sources import spool
from sluiceway.sources.messages import read_messages
from sluiceway.sources.tables import read_table
from sluiceway.sources.tolerant import read_csv_tolerant, typed
from sluiceway.streaming import batches


@pytest.fixture
def box(spark, tmp_path):
    spool.register_spool(spark)
    return f"{tmp_path}/spool"


def send(spark, box, pairs, **options):
    df = spark.createDataFrame(pairs, "key string, value string").repartition(3)
    df.write.format("spool").options(path=box, **options).mode("append").save()


def held(spark, box):
    return rows(spark.read.format("spool").option("path", box).load().select("key", F.col("value").cast("string")))


def test_spool_takes_a_batch_once(spark, box):
    send(spark, box, [("a", "1"), ("b", None), (None, "3")], writer="w", batch="0")
    send(spark, box, [("a", "1"), ("b", None), (None, "3")], writer="w", batch="0")
    send(spark, box, [("c", "4")], writer="w", batch="1")
    send(spark, box, [("c", "4")], writer="v", batch="1")
    send(spark, box, [], writer="w", batch="2")
    assert held(spark, box) == sorted([("a", "1"), ("b", None), (None, "3"), ("c", "4"), ("c", "4")], key=repr)
    listed = {f for n in os.listdir(f"{box}/log") for f in json.load(open(f"{box}/log/{n}"))["files"]}
    assert set(os.listdir(f"{box}/segments")) == listed  # the repeated batch has left nothing
    assert held(spark, f"file://{box}") == held(spark, box)
    with pytest.raises(Exception, match="no dot"):
        send(spark, box, [("c", "4")], writer="w.x")


def test_spool_of_a_failed_job_shows_nothing(spark, box):
    bad = spark.range(20).select(F.col("id").cast("string").alias("key"), F.expr("string(1 / (id - 15))").alias("value")).repartition(4)
    with pytest.raises(Exception):
        bad.write.format("spool").options(path=box).mode("append").save()
    assert held(spark, box) == [] and not [n for n in os.listdir(f"{box}/log")]


def test_spool_finishes_the_entry_of_a_dead_writer(box):
    log = spool._Log(box)
    log.add(["one"], "w", "0")
    with open(f"{box}/log/{1:012d}", "w") as file:  # the number is taken, the entry not shown
        json.dump({"files": ["two"], "writer": "dead", "batch": "7"}, file)
    assert log.add(["three"], "w", "1")
    assert log.files(0, log.end()) == ["one", "two", "three"] and not log.add(["two"], "dead", "7")


def test_pull_goes_on_after_a_restart_and_acknowledges(spark, box, tmp_path):
    def pull():
        messages = read_messages(spark, "spool", True, path=box, subscription="s")
        batches.start(messages, f"{tmp_path}/cp", batches.to_folder(f"{tmp_path}/out"), interval=None).awaitTermination()

    send(spark, box, [("a", "1")], writer="w", batch="0")
    pull()
    send(spark, box, [("b", "2"), ("c", "3")], writer="w", batch="1")
    pull()
    pull()
    got = spark.read.parquet(f"{tmp_path}/out").select("key", F.col("value").cast("string"))
    assert rows(got) == [("a", "1"), ("b", "2"), ("c", "3")]
    done = spool._Log(box).acknowledged()
    assert done >= 1 and spool.trim(box) >= 1
    send(spark, box, [("a", "1")], writer="w", batch="0")  # still known as done
    assert ("a", "1") not in held_after_trim(spark, box, done)


def held_after_trim(spark, box, done):
    log = spool._Log(box)
    return [f for f in log.files(done, log.end())]


def test_stream_writer(spark, box, tmp_path):
    source = tmp_path / "in"
    spark.range(5).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value")).write.parquet(str(source))
    stream = spark.readStream.schema("key string, value string").parquet(str(source))
    for checkpoint in ("a", "b"):  # a lost checkpoint replays batch 0
        query = stream.writeStream.format("spool").option("path", box).option("writer", "w").option("checkpointLocation", f"{tmp_path}/{checkpoint}")
        query.trigger(availableNow=True).start().awaitTermination()
    assert len(held(spark, box)) == 5


def test_console_and_catalog_sinks_run(spark, tmp_path, capfd):
    source = f"{tmp_path}/in"
    spark.range(3).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    batches.start(stream, f"{tmp_path}/c1", batches.to_console(), interval=None).awaitTermination()
    both = batches.merged(batches.to_folder(f"{tmp_path}/a"), batches.to_folder(f"{tmp_path}/b"))
    batches.start(stream, f"{tmp_path}/c2", both, interval=None).awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/a").select("id")) == rows(spark.read.parquet(f"{tmp_path}/b").select("id")) == [(0,), (1,), (2,)]
    batches.append_to_table(stream, "streamed_rows", f"{tmp_path}/c3", None).awaitTermination()
    assert rows(spark.table("streamed_rows")) == [(0,), (1,), (2,)]


@pytest.mark.parametrize("share", [0, 3, 8])
def test_insert_once(spark, tmp_path, share):
    """The first run dies with the parts below ``share`` in the target."""
    target, died = f"{tmp_path}/t", []
    schema = "id bigint, batch_id bigint, part int"
    spark.createDataFrame([], schema).write.parquet(target)

    def append(df):
        if not died:
            died.append(1)
            df.where(F.col("part") < share).write.mode("append").parquet(target)
            raise RuntimeError
        df.write.mode("append").parquet(target)

    write = insert_once(append, lambda s, b: s.read.schema(schema).parquet(target).where(F.col("batch_id") == b))
    with pytest.raises(RuntimeError):
        write(spark.range(100), 4)
    write(spark.range(100).repartition(5), 4)
    write(spark.range(100), 4)
    write(spark.range(3), 5)
    got = spark.read.schema(schema).parquet(target)
    assert sorted(r.id for r in got.where("batch_id = 4").collect()) == list(range(100)) and got.where("batch_id = 5").count() == 3


def test_chunk_load_goes_on(spark, tmp_path, monkeypatch):
    data = spark.range(100).select("id", (F.col("id") % 10).cast("string").alias("p"))
    chunks = spark.createDataFrame([(str(i), i // 3) for i in range(10)], "p string, chunk int")
    path, target = f"{tmp_path}/load", f"{tmp_path}/t"
    data.where("p = '4'").selectExpr("id + 1000 AS id", "p").write.partitionBy("p").parquet(target)  # an older load
    load = ChunkLoad(spark, path, target, "p")
    assert load.run(data, chunks, at_most=1) == 1 and load.done() == {0}
    with monkeypatch.context() as m:  # dies after it has moved a chunk, before it is logged
        m.setattr(ChunkLoad, "_note", lambda *a: (_ for _ in ()).throw(OSError("dead")))
        with pytest.raises(OSError):
            ChunkLoad(spark, path, target, "p").run(data, chunks)
    assert ChunkLoad(spark, path, target, "p").done() == {0}
    other = spark.createDataFrame([("0", 99)], "p string, chunk int")
    assert ChunkLoad(spark, path, target, "p").run(data, other) == 3  # the chunks are those of the beginning
    assert rows(read_table(spark, target)) == rows(data)
    assert ChunkLoad(spark, path, target, "p").run(data, chunks) == 0


def test_equal_depth_of_skewed_values(spark):
    rng = random.Random(1)
    values = [7] * 4000 + [rng.randrange(100) for _ in range(3000)] + [rng.randrange(10**6) for _ in range(3000)] + [None] * 50
    data = [(i, v, rng.randrange(1000)) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "id int, v bigint, w bigint").repartition(4)
    ranges = depth_ranges(df, "v", 10, "w", accuracy=100_000)
    matched = [df.where(r.matches()).count() for r in ranges]
    assert sum(matched) == len(data) and max(matched) < 1300
    assert in_ranges(df, ranges).where("range IS NULL").count() == 0
    whole = depth_ranges(df, "v", 10)
    assert max(df.where(r.matches()).count() for r in whole) >= 4000  # nothing to cut the heavy value by
    assert any("v = 7 AND (" in r.sql() for r in ranges)


@pytest.mark.parametrize("kind", ["date", "timestamp", "decimal(10,2)", "double", "int"])
def test_equal_depth_of_types(spark, kind):
    value = {
        "date": "date_add(DATE '2020-01-01', int(id % 50))",
        "timestamp": "timestamp_seconds(id * 3600)",
        "decimal(10,2)": "cast(id / 7 AS decimal(10,2))",
        "double": "id / 7",
        "int": "int(id)",
    }[kind]
    df = spark.range(1000).selectExpr(f"{value} AS v")
    ranges = depth_ranges(df, "v", 8)
    sizes = [df.where(r.sql()).count() for r in ranges]
    assert sum(sizes) == 1000 and len(ranges) >= 8 and max(sizes) <= 260
    assert [r.sql() for r in depth_ranges(df.limit(0), "v", 8)] == ["v IS NOT NULL OR v IS NULL"]
    assert len(depth_ranges(df, "v", 1)) == 1


def test_equal_depth_tells_the_cut_of_each_range(spark):
    # 0 is a cut of its own right in front of the heavy 1; nothing lies between them, nor between 4 and the heavy 6 but 5.
    values = [0] * 10 + [1] * 20 + [4] * 10 + [5] * 3 + [6] * 27 + [7] * 10
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v bigint, w bigint")
    ranges = depth_ranges(df, "v", 8, "w", accuracy=100_000)
    cuts = {r.v: set() for r in df.select("v").distinct().collect()}
    for row in in_ranges(df, ranges).select("v", "range").distinct().collect():
        cuts[row.v].add(ranges[row.range].cut)
    assert cuts == {0: {0}, 1: {1}, 4: {4}, 5: {6}, 6: {6}, 7: {None}}
    front = [r for r in ranges if r.inside is None and r.cut == 6]
    assert [(r.low, r.high) for r in front] == [(4, 5)]


def test_equal_depth_ranges_with_a_cut_in_front_of_a_heavy_one(spark, tmp_path):
    # A twelfth of the rows has part 0 and five twelfths part 1000, so 0 is a cut and 1 a heavy cut, with nothing in between.
    parts = [0, 1000, 1000, 1000, 1000, 1000, 2000, 3000, 4000, 5000, 6000, 7000]
    lines = spark.range(1200).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_linenumber", "timestamp_seconds(id * 86400) AS l_shipdate", f"array({', '.join(map(str, parts))})[int(id % 12)] AS l_partkey"
    )
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    registered = load_all()["equal_depth_ranges"]
    count, diffs = compare(spark, con, registered.run, registered.oracle, str(tmp_path))
    assert (count, diffs) == (1200, [])


def test_typed_rows_and_rejects_are_all_rows(spark):
    data = [("1", "2.5", "2020-01-02", None), ("x", "y", "2020-01-02", "more"), (None, "1", "no", None), ("4", None, None, "more")]
    df = spark.createDataFrame(data, "A string, b string, c string, d string")
    good, bad = typed(df, "a int not null, B double, c date, e string")
    assert rows(good) == sorted([(1, 2.5, dt.date(2020, 1, 2), None, None), (4, None, None, None, '{"d":"more"}')], key=repr)
    told = {r._rescued: [tuple(x) for x in r.reasons] for r in bad.collect()}
    assert told == {
        '{"A":"x","b":"y","c":"2020-01-02","d":"more"}': [("a", "x", "no int"), ("B", "y", "no double")],
        '{"b":"1","c":"no"}': [("a", None, "missing"), ("c", "no", "no date")],
    }


def test_tolerant_csv(spark, tmp_path):
    for name, text in (("a.csv", "v,w\n1,x\nq,y\n"), ("b.csv", "v,w\n2,\"z, z\"\n")):
        (tmp_path / name).write_text(text)
    good, bad = read_csv_tolerant(spark, str(tmp_path), "v int, w string")
    assert rows(good.select("file", "block", "v", "w")) == [("a.csv", 0, 1, "x"), ("b.csv", 0, 2, "z, z")]
    assert [(r.file, r.reasons[0].value) for r in bad.collect()] == [("a.csv", "q")]


def test_literals():
    assert literals(r"^%{WORD:a} took %{INT:ms} ms\s+x?yz(?:foo|bar)q$") == [" took ", " ms"]
    assert literals(r"a|b") == [] and literals("abc+de") == ["abc"] and literals(r"\d+abc\.d[xyz]efgh{2}ijk") == ["abc.d", "efg", "ijk"]


def test_routing_equals_trying_every_template(spark):
    templates = {
        "one": r"^%{WORD:who} logged in$", "two": r"user=%{INT:who}", "three": r"^(?:a|b)c %{DATA:x};", "four": r"\[%{INT:n}\]", "rest": r"%{GREEDYDATA:all}x{2}$",
    }
    rng = random.Random(3)
    parts = ["ann", " logged in", "user=", "17", "ac ", "bc ", ";", "[", "]", "x", "xx", " "]
    lines = [("".join(rng.choice(parts) for _ in range(rng.randrange(6))),) for _ in range(3000)] + [(None,)]
    got = route_lines(spark.createDataFrame(lines, "line string"), "line", templates).collect()

    def plain(line):
        for name, template in templates.items():
            pattern, names = capture_pattern(template)
            found = line is not None and re.search(pattern, line)
            if found:
                return name, dict(zip(names, found.groups()))
        return None, None

    assert [(r.template, r.fields) for r in got] == [plain(r.line) for r in got]
    assert len({r.template for r in got}) == 6
    same = capture_fields(spark.createDataFrame([("ann logged in",)], "line string"), "line", templates["one"])
    assert same.first().who == "ann"


def test_variants(spark):
    texts = ['{"a": 1, "b": "x", "c": [1], "d": null, "e\'s": true}', '{"a": 2.5, "b": 7, "c": {"k": 1}, "d": null}', "no json", None, '{"a": null}']
    df = variants.to_variant(spark.createDataFrame(list(enumerate(texts)), "id int, v string"), "v")
    observed = variants.observed_types(df, "v").where("key IS NOT NULL")
    types = variants.choose(observed.collect())
    assert types == {"a": "double", "b": "string", "c": "variant", "d": "string", "e's": "boolean"}
    flat = variants.flatten_variant(df, "v", types).orderBy("id").collect()
    assert [(r.a, r.b, r["e's"]) for r in flat] == [(1.0, "x", True), (2.5, "7", None), (None,) * 3, (None,) * 3, (None,) * 3]
    assert "partial" in plan_of(observed)


def test_versions_of_several_tables(spark):
    ddl = [
        ("t", "f2", 1, "RENAME", "b", "TO c"), ("t", "f1", 9, "ADD", "b", "INT"), ("t", "f2", 2, "DROP", "a", ""), ("t", "f2", 3, "ADD", "a", "VARCHAR(3)"), ("u", "f1", 1, "CHANGE", "a", "`z` bigint"),
    ]
    events = spark.createDataFrame(ddl, "source_table string, file string, pos bigint, verb string, name string, rest string")
    found = versions.schema_versions(events, {"t": {"a": "INT"}, "u": {"a": "INT"}, "w": {"a": "INT"}})
    changes = spark.createDataFrame(
        [
            ("t", "f1", 1, "c", {"a": "1"}), ("t", "f1", 9, "c", {"a": "2", "b": "3"}), ("t", "f2", 1, "c", {"a": "4", "c": "5"}),
            ("t", "f2", 7, "c", {"a": "new", "c": "6"}), ("u", "f1", 0, "c", {"a": "7"}), ("u", "f1", 1, "c", {"z": "8"}), ("w", "f9", 1, "c", {"a": "9"}),
        ],
        "source_table string, file string, pos bigint, op string, row map<string, string>",
    )
    got = {(r.source_table, r.file, r.pos): r.row for r in versions.under_final_schema(changes, found).collect()}
    assert got == {
        ("t", "f1", 1): {"c": None, "a": None}, ("t", "f1", 9): {"c": "3", "a": None}, ("t", "f2", 1): {"c": "5", "a": None},
        ("t", "f2", 7): {"c": "6", "a": "new"}, ("u", "f1", 0): {"z": "7"}, ("u", "f1", 1): {"z": "8"}, ("w", "f9", 1): {"a": "9"},
    }
    assert [versions.spark_type(k) for k in ("VARCHAR(3)", "decimal(8, 2)", "INT unsigned", "DATETIME(6)", None)] == ["string", "decimal(8,2)", "int", "timestamp", "string"]


def test_latest_rows_shuffle_by_key_before_they_sort(spark):
    stored = spark.createDataFrame([("t", "log.1", i, "c", {"id": str(i % 5), "v": str(i)}) for i in range(20)], "source_table string, file string, pos bigint, op string, row map<string,string>")
    none = spark.createDataFrame([], "source_table string, file string, pos bigint, verb string, name string, rest string")
    known = versions.schema_versions(none, {"t": {"id": "INT", "v": "INT"}})
    latest = versions.latest_rows(stored, known, "t", "id")
    assert rows(latest) == sorted([(i, 15 + i) for i in range(5)], key=repr)
    plan = plan_of(latest)
    below = plan[plan.index("SortAggregate") :]
    # Both steps of the aggregate, and their sort, are above the shuffle.
    assert below.count("SortAggregate", 0, below.index("Exchange hashpartitioning")) == 2
