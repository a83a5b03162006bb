"""Sliced operators against plain Python loops, and against every slice length."""

import datetime as dt
import random

import pytest
from helpers import plan_of, rows

from sluiceway.operators import slices
from sluiceway.operators.counters import counter_diff, repair_counter
from sluiceway.operators.labelling import backfill, label_ahead, row_rank

START = dt.datetime(2024, 1, 1)
WIDTHS = ["10 minutes", "6 hours", "30 days"]


def series(seed, count=120, keys=("a", "b", None), hot=0.5):
    """Readings on a ten-minute grid with gaps, nulls and equal times; half of them belong to one key."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        key = "hot" if rng.random() < hot else rng.choice(keys)
        at = START + dt.timedelta(minutes=10 * rng.randrange(count))
        value = rng.choice([None, rng.randrange(100), rng.randrange(100)])
        out.append((i, key, at, value, rng.choice([0, 0, 0, 1, 2, 3, 4])))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id int, k string, at timestamp, v int, label int")


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


def check(df, expected):
    assert dict(df.select("id", df.columns[-1]).collect()) == expected


@pytest.mark.parametrize("width", WIDTHS)
def test_repair(spark, width):
    data = series(1)
    expected = {}
    for group in by_key(data).values():
        known = [r[3] for r in group if r[3] is not None]
        previous = None
        for r in group:
            v = r[3]
            bad = v is not None and (v > known[-1] or v < known[0])
            expected[r[0]] = previous if bad else v
            previous = v
    check(repair_counter(frame(spark, data), ["v"], ["k"], "at", ["id"], width).select("id", "v"), expected)


@pytest.mark.parametrize("width", WIDTHS)
def test_growth(spark, width):
    data = series(2)
    expected = {}
    for group in by_key(data).values():
        previous = None
        for r in group:
            expected[r[0]] = r[3] if r[3] is None or previous is None else r[3] - previous
            previous = r[3]
    check(counter_diff(frame(spark, data), ["v"], ["k"], "at", ["id"], width).select("id", "v"), expected)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed", [3, 4])
def test_label_ahead(spark, width, seed):
    data = series(seed, hot=0.7)
    expected = {}
    for group in by_key(data).values():
        # Events in time order, each marks the free rows of the day before; the first mark stays.
        labels = {r[0]: r[4] for r in group}
        events = sorted((r[2], r[4]) for r in group if r[4] in (1, 2))
        for at, label in events:
            for r in group:
                if labels[r[0]] in (0, 3) and at - dt.timedelta(days=1) <= r[2] < at:
                    labels[r[0]] = label
        expected |= labels
    got = label_ahead(frame(spark, data), ["k"], "at", "label", slice_width=width)
    check(got.select("id", "label"), expected)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("fallback", ["last_known", "oldest_row"])
def test_backfill(spark, width, fallback):
    data = series(5)
    expected = {}
    for group in by_key(data).values():
        known = [r[3] for r in group if r[3] is not None]
        value = group[0][3] if fallback == "oldest_row" else (known[-1] if known else None)
        for r in reversed(group):
            value = value if r[3] is None else r[3]
            expected[r[0]] = value
    got = backfill(frame(spark, data), ["k"], "at", ["v"], ["id"], width, fallback)
    check(got.select("id", "v"), expected)


@pytest.mark.parametrize("width", WIDTHS)
def test_rank(spark, width):
    data = series(6)
    expected = {r[0]: i for group in by_key(data).values() for i, r in enumerate(group)}
    check(row_rank(frame(spark, data), ["k"], "at", "n", ["id"], width).select("id", "n"), expected)


def test_golden_backfill(spark):
    data = [(i, "a", START + dt.timedelta(minutes=i), v, 0) for i, v in enumerate([None, 1, None, 2, None])]
    data += [(9, "b", START, None, 0)]
    got = backfill(frame(spark, data), ["k"], "at", ["v"])
    assert rows(got.select("id", "v")) == rows(spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 2), (4, 2), (9, None)], "a int, b int"))


def test_golden_label(spark):
    minutes = [0, 10, 1430, 1440, 1450, 2000]
    data = [(m, "a", START + dt.timedelta(minutes=m), None, lab) for m, lab in zip(minutes, [0, 3, 2, 0, 1, 0], strict=True)]
    got = dict(label_ahead(frame(spark, data), ["k"], "at", "label").select("id", "label").collect())
    # The row at 0 is 1430 minutes before the first event and 1450 before the second.
    assert got == {0: 2, 10: 2, 1430: 2, 1440: 1, 1450: 1, 2000: 0}


def test_rows_without_time_come_first(spark):
    data = [(1, "a", None, 7, 0), (2, "a", START, 9, 0), (3, "a", START + dt.timedelta(days=3), 10, 0)]
    got = dict(counter_diff(frame(spark, data), ["v"], ["k"], "at").select("id", "v").collect())
    assert got == {1: 7, 2: 2, 3: 1}


def test_text_and_epoch_times(spark):
    as_text = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-03 00:00:00", 5)], "k string, t string, v int")
    as_ms = spark.createDataFrame([("a", 1704067200000, 1), ("a", 1704240000000, 5)], "k string, t bigint, v int")
    for df in (as_text, as_ms):
        assert sorted(r[0] for r in counter_diff(df, ["v"], ["k"], "t").select("v").collect()) == [1, 4]


def test_hot_key_is_cut_into_slices(spark, sf_dir):
    """One key holds everything, and still no partition key holds more than a slice of it."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "ts", "'hot' AS k", "cast(value AS int) AS v")
    total = events.count()
    largest = slices.largest_slices(events, ["k"], "ts", "6 hours").first()["count"]
    assert largest < total / 20
    df = repair_counter(events, ["v"], ["k"], "ts", ["event_id"], "6 hours")
    detail = [line for line in plan_of(df).splitlines() if "Exchange hashpartitioning" in line and "_slice" in line]
    assert detail and df.count() == total


def test_fit_slice(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "ts", "'hot' AS k")
    width = slices.fit_slice(events, ["k"], "ts", 30)
    assert slices.largest_slices(events, ["k"], "ts", width).first()["count"] <= 30
    with pytest.raises(ValueError):
        slices.fit_slice(events.selectExpr("k", "TIMESTAMP '2024-01-01' AS ts"), ["k"], "ts", 30)
