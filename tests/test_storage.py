"""Sinks: what is on disk after each operation. Databases are checked by their options only."""

import datetime as dt

import pytest
from helpers import rows

from sluiceway.session import hand_over, own_files, shared_folder
from sluiceway.sinks import jdbc as jdbc_sink
from sluiceway.sinks import tables
from sluiceway.sinks.files import write_csv, write_partitioned
from sluiceway.sources import jdbc as jdbc_source
from sluiceway.sources.tables import read_csv, read_table


def frame(spark, *data):
    return spark.createDataFrame(list(data), "v int, p string")


def test_partitioned_modes(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_partitioned(frame(spark, (1, "a"), (2, "b")), path, ["p"])
    write_partitioned(frame(spark, (3, "a")), path, ["p"])
    assert rows(read_table(spark, path)) == [(1, "a"), (2, "b"), (3, "a")]
    write_partitioned(frame(spark, (4, "a")), path, ["p"], mode="overwrite_partitions")
    assert rows(read_table(spark, path)) == [(2, "b"), (4, "a")]
    write_partitioned(frame(spark, (5, "c")), path, ["p"], mode="overwrite")
    assert rows(read_table(spark, path)) == [(5, "c")]


def test_only_the_wanted_folder_is_listed(spark, tmp_path):
    path = f"{tmp_path}/t"
    data = spark.createDataFrame([(1, "2020", "08", "a b"), (2, "2021", "08", "x:y/z"), (3, "2021", "09", "c*")], "v int, year string, month string, day string")
    write_partitioned(data, path, ["year", "month", "day"])
    assert rows(read_table(spark, path, {"month": "08"})) == [(1, "2020", "08", "a b"), (2, "2021", "08", "x:y/z")]
    assert rows(read_table(spark, path, {"year": "2021", "day": "x:y/z"})) == [(2, "2021", "08", "x:y/z")]
    assert rows(read_table(spark, path, {"day": "c*"})) == [(3, "2021", "09", "c*")]
    none = read_table(spark, path, {"month": "10"})
    assert none.columns == ["v", "year", "month", "day"] and rows(none) == []
    assert len(read_table(spark, path, {"year": "2021"}).inputFiles()) == 2
    assert read_table(spark, path, {"year": "2021"}, "v int, year int").schema["year"].dataType.simpleString() == "int"
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmp_path}/nothing")
    assert rows(read_table(spark, f"{tmp_path}/nothing", schema="v int")) == []
    assert rows(read_table(spark, f"file://{path}", {"month": "09"})) == [(3, "2021", "09", "c*")]


def test_a_job_deletes_its_own_files_only(spark):
    before = hand_over(spark.range(3), "before")
    with own_files(spark) as outer:
        kept = hand_over(spark.range(4), "outer")
        with pytest.raises(ValueError), own_files(spark) as inner:
            lost = hand_over(spark.range(5), "inner")
            raise ValueError("jobs that fail clean up too")
        assert kept.count() == 4 and len(inner) == 1 and len(outer) == 1
    assert before.count() == 3
    for gone in (kept, lost):
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            gone.count()


def test_stamped_csv(spark, tmp_path):
    folder = write_csv(frame(spark, (1, "é,\"x\"")), str(tmp_path), stamp=dt.datetime(2020, 9, 3, 1, 2, 3), escape='"')
    assert folder.endswith("2020-09-03_01-02-03")
    assert rows(read_csv(spark, folder, "v int, p string", escape='"')) == [(1, 'é,"x"')]


@pytest.mark.parametrize("external", [True, False])
def test_table_life(spark, tmp_path, external):
    name = f"life_{external}"
    tables.create_table(spark, name, "v INT, p STRING", f"{tmp_path}/t" if external else None, partition_by=["p"])
    tables.insert_into(frame(spark, (1, "a"), (2, "b")).select("p", "v"), name)
    tables.overwrite_partitions(frame(spark, (9, "b"), (3, "c")), name)
    assert rows(spark.table(name)) == [(1, "a"), (3, "c"), (9, "b")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    tables.truncate_table(spark, name, {"p": "b"})
    assert rows(spark.table(name)) == [(1, "a"), (3, "c")]
    tables.overwrite_table(frame(spark, (7, "z")), name)
    assert rows(spark.table(name)) == [(7, "z")]
    tables.truncate_table(spark, name)
    assert spark.table(name).count() == 0
    tables.insert_into(frame(spark, (1, "a")), name)
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_append_with_declared_schema(spark, tmp_path):
    tables.append_table(frame(spark, (1, "5")), "declared", "p INT, v BIGINT, extra STRING", path=f"{tmp_path}/d")
    tables.append_table(frame(spark, (2, "6")), "declared", "p INT, v BIGINT, extra STRING", path=f"{tmp_path}/d")
    assert rows(spark.table("declared")) == [(5, 1, None), (6, 2, None)]
    with pytest.raises(ValueError):
        tables.conform(frame(spark, (1, "5")), "v INT", ignore_unknown=False)


def test_overwrite_partitions_needs_partitions(spark, tmp_path):
    tables.create_table(spark, "flat", "v INT, p STRING", f"{tmp_path}/f")
    with pytest.raises(ValueError):
        tables.overwrite_partitions(frame(spark, (1, "a")), "flat")


def test_recovered_and_loaded(spark, tmp_path):
    tables.create_table(spark, "side", "v INT, p STRING", f"{tmp_path}/s", partition_by=["p"])
    write_partitioned(frame(spark, (1, "a")), f"{tmp_path}/s", ["p"])
    assert spark.table("side").count() == 0
    tables.recover_partitions(spark, "side")
    assert rows(spark.table("side")) == [(1, "a")]
    csv = write_csv(spark.createDataFrame([(8,)], "v int"), f"{tmp_path}/csv")
    tables.load_data(spark, csv, "side", {"p": "a"})
    assert rows(spark.table("side")) == [(1, "a"), (8, "a")]
    tables.load_data(spark, csv, "side", {"p": "a"}, overwrite=True)
    assert rows(spark.table("side")) == [(8, "a")]


def test_hand_over(spark):
    df = hand_over(frame(spark, (1, "a")), "test")
    assert rows(df) == [(1, "a")]
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_database_options():
    scan = jdbc_source.scan_options("jdbc:x:y", "s.t", "day", 1, 9, user="u")
    assert scan["numPartitions"] == "72" and scan["fetchsize"] == "5000" and scan["user"] == "u"
    assert (scan["partitionColumn"], scan["lowerBound"], scan["upperBound"]) == ("day", "1", "9")
    bounds = jdbc_source.bounds_options("jdbc:x:y", "s.t", "day")
    assert bounds["query"] == "SELECT MIN(day) AS lo, MAX(day) AS hi FROM s.t"
    write = jdbc_sink.write_options("jdbc:x:y", "t", password="p")
    assert write["batchsize"] == "3000" and write["truncate"] == "true" and write["password"] == "p"
