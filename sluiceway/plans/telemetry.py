"""Device telemetry: raw bytes to repaired readings, ten-minute rows, and the side tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.binary import array_pair, bucket_ranges, decode_le, packed_bits, with_bits
from sluiceway.functions.clock import duration_micros, epoch_ms, previous_month
from sluiceway.operators.counters import counter_diff, repair_counter
from sluiceway.operators.slices import SLICE, fit_slice
from sluiceway.operators.tumbling import Growth, Last, mean, tumble
from sluiceway.session import hand_over, own_files
from sluiceway.sinks.files import write_partitioned
from sluiceway.sources.tables import read_table

# The device protocol. Names of raw byte columns, decoded fields, flags and code ranges.
DEVICE, TIME = "macaddress", "registerat"
PARTITION = ["year", "month", "day"]
WORDS32 = {f"mtd_{i}_{i + 3}": [f"mtddata{j}" for j in range(i, i + 4)] for i in (8, 12, 16, 20, 24)}
WORDS16 = {
    **{f"rd_{i}_{i + 1}": [f"rddata{i}", f"rddata{i + 1}"] for i in (18, 20, 22)},
    **{f"mtd_{i}_{i + 1}": [f"mtddata{i}", f"mtddata{i + 1}"] for i in (28, 30, 32, 0, 2, 4, 6)},
}
FLAGS = {
    "tcprcmode": ("tcp", 7),
    "rddata0": ("om", 8),
    "rddata1": ("cdm", 8),
    "rddata26": ("rd26_", 8),
    "rddata27": ("rd27_", 7),
}
STATE_RANGES = [(None, 19, 0), (20, 30, 1), (31, 45, 2), (51, 59, 3), (60, 79, 4)]
COUNTERS = ["mtd_0_1", "mtd_2_3", "mtd_4_5", "mtd_6_7", *WORDS32]
ATTRIBUTES = [
    "additionalvalue",
    "rcswversion",
    "did01bxmcver",
    "did00bxmcversub",
    "did21bxboilermodelcode",
    "did22bxboilertypecode",
    "did23bxboilercapacode",
    "txcd09bxindoorctemp",
]
PLAIN_READINGS = ["rddata3", "rddata4", "rddata6", "rddata7", "rddata10", "rddata13"]
WHOLE_MEANS = ["rddata4", "rddata6", "rddata7", "rddata10", "rddata13", "rd_18_19", "rd_20_21", "rd_22_23"]
FINE_MEANS = ["mtd_28_29", "mtd_30_31", "mtd_32_33"]
ERROR_FIELDS = {
    0: "errorcode_low",
    1: "errorcode_high",
    2: "servicecode_low",
    3: "servicecode_high",
    4: "errorlevel",
    5: "swversion",
    6: "releaseyear_low",
    7: "releaseyear_high",
    8: "releasedate_low",
    9: "releasedate_high",
    16: "errortime_low",
    17: "errortime_high",
}

RAW_COLUMNS = [
    DEVICE,
    TIME,
    *ATTRIBUTES,
    *dict.fromkeys([*FLAGS, "rddata2", *PLAIN_READINGS, *[b for parts in (WORDS16 | WORDS32).values() for b in parts]]),
    *PARTITION,
]
FLAG_COLUMNS = [f"{prefix}{i}" for prefix, count in FLAGS.values() for i in range(count)]
PACKED = "_flags"


def decode(raw: DataFrame, align: str = "left", packed: bool = False) -> DataFrame:
    """Raw byte columns to fields, flags and a state number. Devices without a version are left out.

    With ``packed`` the flags are the bits of one number, in the order of ``FLAG_COLUMNS``, which ``ten_minutes`` reads as it
    does the flags: rows that are shuffled and stored between the jobs stay narrow.
    """
    known = raw.select(*RAW_COLUMNS).where((F.col("did01bxmcver") != 0) & (F.col("did00bxmcversub") != 0))
    words = {name: decode_le(parts, bits32=True) for name, parts in (WORDS32 | WORDS16).items()}
    fields = known.withColumns({**words, "statenum": bucket_ranges("rddata2", STATE_RANGES)})
    spent = {b for parts in (WORDS16 | WORDS32).values() for b in parts} | {"rddata2"}
    if packed:
        return fields.withColumn(PACKED, packed_bits(FLAGS, align)).drop(*spent, *FLAGS)
    return with_bits(fields, FLAGS, align).drop(*spent)


def repair(decoded: DataFrame, tiebreak: Sequence[str], slice_width: str = "1 day") -> DataFrame:
    """Counter outliers of a device and month become the previous reading.

    ``tiebreak`` names the columns that order readings of one time; it may be empty only if a device has no two of them.
    """
    return repair_counter(decoded, COUNTERS, [DEVICE, "month"], TIME, tiebreak, slice_width)


def ten_minutes(
    readings: DataFrame, tiebreak: Sequence[str], slice_width: str = "1 day", width: str = "10 minutes"
) -> DataFrame:
    """Counter growth per reading, then one row per device, attributes and window; ``tiebreak`` as in ``repair``.

    Flags may be columns or packed. They travel as one number, so that rows and aggregates stay narrow. Where windows lie within
    slices, they are aggregated in the tasks that hold the slices.
    """
    if PACKED not in readings.columns:
        bits = [F.when(F.col(c) > 0, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(FLAG_COLUMNS)]
        readings = readings.withColumn(PACKED, reduce(Column.bitwiseOR, bits)).drop(*FLAG_COLUMNS)
    within = duration_micros(slice_width) % duration_micros(width) == 0
    growing = counter_diff(readings, COUNTERS, [DEVICE], TIME, tiebreak, slice_width, keep_slice=within)
    spec = {PACKED: F.bit_or(PACKED)}
    spec |= {c: mean(c) for c in WHOLE_MEANS}
    spec["statenum"] = Last("statenum")
    spec |= {c: mean(c, 2) for c in FINE_MEANS}
    spec |= {c: Growth(c, zero_guard=c != COUNTERS[0]) for c in COUNTERS}
    keys = [DEVICE, *ATTRIBUTES, *PARTITION]
    rows = tumble(growing, [*keys, SLICE] if within else keys, epoch_ms(TIME), width, spec, [TIME, *tiebreak])
    flags = [F.getbit(PACKED, F.lit(i)).cast("int").alias(c) for i, c in enumerate(FLAG_COLUMNS)]
    return rows.select(*keys, "start", "end", *flags, *[c for c in spec if c != PACKED])


def error_windows(events: DataFrame, width: str = "10 minutes") -> DataFrame:
    """Error records: packed pairs of the first record in the list, largest value per device and window."""
    packed = events.withColumn("_codes", F.get("ehrdlist.column", F.lit(0)))
    pairs = {
        name: array_pair("_codes", i)[i % 2].alias(name) for i, name in ERROR_FIELDS.items()
    }
    keys = [DEVICE, "additionalvalue", *PARTITION]
    decoded = packed.select(*keys, TIME, *pairs.values())
    return tumble(decoded, keys, epoch_ms(TIME), width, {c: F.max(c) for c in pairs})


def connection_windows(events: DataFrame, tiebreak: Sequence[str], width: str = "10 minutes") -> DataFrame:
    """Last connection status per device, kind and window."""
    keys = [DEVICE, "thingstype", *PARTITION]
    return tumble(events, keys, epoch_ms(TIME), width, {"status": Last("status")}, [TIME, *tiebreak])


def device_windows(info: DataFrame, width: str = "10 minutes") -> DataFrame:
    """Mean water temperature limits per device, software versions and window."""
    versions = ["roomcontrollerswversion", "boilercontrollerswversion", "boilercontrollerswsubversion"]
    limits = ["hotwatertemperaturemin", "hotwatertemperaturemax"]
    keys = [DEVICE, "additionalvalue", *versions, *PARTITION]
    return tumble(info, keys, epoch_ms(TIME), width, {c: mean(c, 2) for c in limits})


def status_windows(status: DataFrame, width: str = "10 minutes") -> DataFrame:
    """Mean temperatures and largest states per device, operation mode and window."""
    means = ["insidetemperature", "hotwatertemperaturesetting", "insidetemperaturesetting"]
    spec = {c: mean(c, 2) for c in means}
    spec["operationbusy"] = F.max("operationbusy")
    spec["ondoltemperaturesetting"] = F.max("ondoltemperaturesetting")
    spec["errorcode_status"] = F.max("errorcode")
    keys = [DEVICE, "additionalvalue", "operationmode", *PARTITION]
    return tumble(status, keys, epoch_ms(TIME), width, spec)


def month_job(
    spark: SparkSession,
    zone: str,
    target: str,
    run_date: dt.date,
    tiebreak: Sequence[str],
    slice_width: str | None = "1 day",
    max_rows: int = 5_000_000,
) -> DataFrame:
    """The ten-minute rows of the month before the run date, from a raw zone to a partitioned target.

    Only the folders of that month are read. They replace their own partitions of the target, sorted by device
    and time within each file. Without a ``slice_width`` the job measures which slice length keeps every slice
    of a device below ``max_rows``. Returns the month as stored; intermediate folders are deleted.
    """
    year, month = previous_month(run_date)
    decoded = decode(read_table(spark, zone, {"year": year, "month": month}), packed=True)
    with own_files(spark):
        width = slice_width or fit_slice(decoded, [DEVICE], TIME, max_rows)
        repaired = hand_over(repair(decoded, tiebreak, width), "month-readings")
        rows = ten_minutes(repaired, tiebreak, width)
        write_partitioned(rows, target, PARTITION, "overwrite_partitions", sort=[DEVICE, "start"])
    return read_table(spark, target, {"year": year, "month": month})


#: The side tables by name: how their records become windows.
SIDES = {"error": error_windows, "connection": connection_windows, "device": device_windows, "status": status_windows}


def side_month_job(spark: SparkSession, side: str, zone: str, target: str, run_date: dt.date, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The windows of one side table for the month before the run date, as ``month_job`` stores those of the readings.

    ``tiebreak`` is for ``connection``, whose last status needs an order of records of one time.
    """
    year, month = previous_month(run_date)
    records = read_table(spark, zone, {"year": year, "month": month})
    rows = connection_windows(records, tiebreak) if side == "connection" else SIDES[side](records)
    write_partitioned(rows, target, PARTITION, "overwrite_partitions", sort=[DEVICE, "start"])
    return read_table(spark, target, {"year": year, "month": month})
