"""The wide analysis table: telemetry with status, errors, device info, connection and weather."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.binary import pair_label
from sluiceway.functions.clock import previous_month
from sluiceway.operators.columns import cast_columns, drop_missing, fill_zero
from sluiceway.operators.joins import chain_left, keep_keys, union_families
from sluiceway.operators.labelling import backfill, label_ahead
from sluiceway.plans.telemetry import DEVICE, ERROR_FIELDS, PARTITION
from sluiceway.session import hand_over, own_files
from sluiceway.sinks.files import write_partitioned
from sluiceway.sources.tables import read_table

# Label rule of an error code pair, required columns and version columns.
ERROR_LABELS = {(3, 0): 1, (12, 0): 2}
OTHER_ERROR = 3
FAILURES = (1, 2)
LABEL = "errorlabel"
ZERO_COLUMNS = [LABEL, *ERROR_FIELDS.values()]
REQUIRED = [
    "operationmode",
    "insidetemperature",
    "hotwatertemperaturesetting",
    "insidetemperaturesetting",
    "operationbusy",
]
VERSIONS = ["roomcontrollerswversion", "boilercontrollerswversion", "boilercontrollerswsubversion"]
KEYS = [DEVICE, "start"]
REPEATED = ["additionalvalue", "end", *PARTITION]


def labelled_errors(errors: DataFrame) -> DataFrame:
    label = pair_label("errorcode_low", "errorcode_high", ERROR_LABELS, OTHER_ERROR)
    return errors.withColumn(LABEL, label)


def failed_devices(errors: DataFrame) -> DataFrame:
    """Devices that ever had one of the two labelled failures."""
    return labelled_errors(errors).where(F.col(LABEL).isin(*FAILURES)).select(DEVICE).distinct()


def family_rows(
    telemetry: dict[int, DataFrame], status: DataFrame, errors: DataFrame, devices: DataFrame, only_failed: bool = True
) -> dict[int, DataFrame]:
    """Telemetry of each device family, by type number, with its side tables. A side key that repeats repeats the row.

    The error windows are made once and handed over: every family reads them for its labels and for its failed devices.
    """
    errors = hand_over(labelled_errors(errors), "mart-errors")
    failed = errors.where(F.col(LABEL).isin(*FAILURES)).select(DEVICE).distinct()
    families = {}
    for number, rows in telemetry.items():
        kept = keep_keys(rows, failed, [DEVICE]) if only_failed else rows
        families[number] = chain_left(kept, [status, errors, devices], KEYS, REPEATED)
    return families


def joined_rows(
    families: dict[int, DataFrame],
    connection: DataFrame,
    weather: DataFrame | None,
    required: Sequence[str] = REQUIRED,
) -> DataFrame:
    """All families with connection status and weather; without an error the error fields are 0."""
    rows = chain_left(union_families(families), [connection], KEYS, REPEATED)
    rows = drop_missing(fill_zero(rows, ZERO_COLUMNS), required)
    if weather is not None:
        rows = rows.join(weather.withColumnRenamed("datetime", "start"), "start", "left")
    return rows


def build_mart(
    families: dict[int, DataFrame],
    connection: DataFrame,
    weather: DataFrame | None,
    tiebreak: Sequence[str],
    required: Sequence[str] = REQUIRED,
    versions: Sequence[str] = VERSIONS,
    slice_width: str = "1 day",
    casts: dict[str, str] | None = None,
) -> DataFrame:
    """The mart: joined rows, labels of the day before a failure, versions filled back.

    ``families`` is the result of ``family_rows``; ``tiebreak`` orders the rows of one device and window. The joined rows are written once to
    the shared folder, because labelling and filling read them several times.
    """
    rows = hand_over(joined_rows(families, connection, weather, required), "mart-joined")
    rows = label_ahead(rows, [DEVICE], "start", LABEL, sources=FAILURES, targets=(0, OTHER_ERROR), slice_width=slice_width)
    rows = backfill(rows, [DEVICE], "start", versions, tiebreak, slice_width)
    return cast_columns(rows, casts or {"additionalvalue": "string"})


def stored_mart(
    spark: SparkSession,
    sources: dict[str, str],
    families: dict[int, Column],
    weather: DataFrame | None,
    target: str,
    run_date: dt.date,
    tiebreak: Sequence[str],
    slice_width: str = "1 day",
) -> DataFrame:
    """The mart of the month before the run date, from the folders that the month jobs store to a partitioned target.

    ``sources`` has the folders ``readings``, ``status``, ``error``, ``device`` and ``connection``; ``families`` says by type number
    which readings belong to a family. Returns the month as stored; intermediate folders are deleted.
    """
    year, month = previous_month(run_date)
    tables = {name: read_table(spark, folder, {"year": year, "month": month}) for name, folder in sources.items()}
    with own_files(spark):
        readings = {number: tables["readings"].where(wanted) for number, wanted in families.items()}
        joined = family_rows(readings, tables["status"], tables["error"], tables["device"])
        rows = build_mart(joined, tables["connection"], weather, tiebreak, slice_width=slice_width)
        write_partitioned(rows, target, PARTITION, "overwrite_partitions", sort=KEYS)
    return read_table(spark, target, {"year": year, "month": month})
