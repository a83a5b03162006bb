"""Registered queries for the device jobs, over telemetry that Spark derives from ``events``.

Every event is one reading: its number sets the time (20 seconds apart) and the raw bytes, its user the
device. The SQL side derives the same telemetry and follows the rules in plain window functions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.plans import mart, telemetry
from sluiceway.plans.registry import query, table
from sluiceway.plans.telemetry import COUNTERS, FINE_MEANS, FLAGS, PLAIN_READINGS, STATE_RANGES, WHOLE_MEANS, WORDS16, WORDS32
from sluiceway.session import shared_folder
from sluiceway.sinks.files import write_partitioned

START_MS = 1704067200000  # 2024-01-01 00:00:00
STEP_MS = 20000
DEVICES = 15

# Raw columns as expressions that both engines read alike; e is the event number and d the device number.
_ATTRIBUTES = {
    "additionalvalue": "d % 2",
    "rcswversion": "d % 3",
    "did01bxmcver": "e % 7",
    "did00bxmcversub": "d + 1",
    "did21bxboilermodelcode": "d % 5",
    "did22bxboilertypecode": "d % 4",
    "did23bxboilercapacode": "d % 3 + 1",
    "txcd09bxindoorctemp": "d % 10",
}
# A counter that grows with the event number and now and then jumps out of range.
_COUNTER = "(e * {rate} + CASE WHEN e % 97 = 5 THEN {jump} ELSE 0 END)"


def _raw_columns() -> dict[str, str]:
    raw = dict(_ATTRIBUTES)
    raw |= {name: f"(e * {i + 3} + d) % 256" for i, name in enumerate(FLAGS)}
    raw |= {name: f"(e * {i + 2} + d) % 90" for i, name in enumerate(["rddata2", *PLAIN_READINGS])}
    for i, (name, parts) in enumerate((WORDS32 | WORDS16).items()):
        is_counter, wide = name in COUNTERS, len(parts) == 4
        if is_counter:
            word = _COUNTER.format(rate=i + 1, jump=900000000 if wide else 40000)
        else:
            word = f"(e * {i + 7} % 5000)"
        raw |= {byte: f"(({word}) >> {8 * j}) & 255" for j, byte in enumerate(parts)}
    return raw


RAW = _raw_columns()


def telemetry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("e"), (F.col("user_id") % DEVICES).alias("d")
    )
    # A small file unfolds into wide rows; dealt out first, they are decoded by all tasks and not by the few that read the file.
    events = events.repartition("e")
    at = F.timestamp_millis(F.col("registerat"))
    return (
        events.withColumns({name: F.expr(sql) for name, sql in RAW.items()})
        .withColumns(
            {
                "macaddress": F.concat(F.lit("dev-"), F.col("d").cast("string")),
                "registerat": F.lit(START_MS) + F.col("e") * STEP_MS,
            }
        )
        .withColumns(
            {
                "year": F.date_format(at, "yyyy"),
                "month": F.date_format(at, "MM"),
                "day": F.date_format(at, "dd"),
            }
        )
        .drop("e", "d")
    )


def _base_sql() -> str:
    raw = ", ".join(f"{sql} AS {name}" for name, sql in RAW.items())
    return f"""
    ed AS (SELECT event_id AS e, user_id % {DEVICES} AS d FROM events),
    raw AS (SELECT 'dev-' || CAST(d AS VARCHAR) AS macaddress, {START_MS} + e * {STEP_MS} AS registerat, {raw} FROM ed),
    timed AS (SELECT *, make_timestamp(registerat * 1000) AS seen FROM raw),
    known AS (SELECT *, strftime(seen, '%Y') AS "year", strftime(seen, '%m') AS "month", strftime(seen, '%d') AS "day"
              FROM timed WHERE did01bxmcver <> 0 AND did00bxmcversub <> 0)"""


def _word_sql(parts: list[str]) -> str:
    total = " + ".join(f"{byte} * {256**j}" for j, byte in enumerate(parts))
    return f"CASE WHEN {total} < 2147483648 THEN {total} END"


def _decoded_sql() -> str:
    words = ", ".join(f"{_word_sql(parts)} AS {name}" for name, parts in (WORDS32 | WORDS16).items())
    flags = ", ".join(
        f"coalesce(TRY_CAST(nullif(substr(bin({source}), {i + 1}, 1), '') AS INTEGER), 0) AS {prefix}{i}"
        for source, (prefix, count) in FLAGS.items()
        for i in range(count)
    )
    whens = " ".join(
        f"WHEN rddata2 <= {high} THEN {code}" if low is None else f"WHEN rddata2 BETWEEN {low} AND {high} THEN {code}"
        for low, high, code in STATE_RANGES
    )
    keys = ", ".join(["macaddress", "registerat", "seen", *_ATTRIBUTES, '"year"', '"month"', '"day"', *PLAIN_READINGS])
    return f"decoded AS (SELECT {keys}, {words}, {flags}, CASE {whens} END AS statenum FROM known)"


def _repaired_sql() -> str:
    part = 'PARTITION BY macaddress, "month" ORDER BY registerat'
    fixed = ", ".join(
        f"CASE WHEN {c} > first_value({c} IGNORE NULLS) OVER ({part} DESC) OR {c} < first_value({c} IGNORE NULLS) OVER ({part}) "
        f"THEN lag({c}) OVER ({part}) ELSE {c} END AS {c}"
        for c in COUNTERS
    )
    return f"repaired AS (SELECT * EXCLUDE ({', '.join(COUNTERS)}), {fixed} FROM decoded)"


def _grown_sql() -> str:
    part = "PARTITION BY macaddress ORDER BY registerat"
    grown = ", ".join(f"coalesce({c} - lag({c}) OVER ({part}), {c}) AS {c}" for c in COUNTERS)
    return f"grown AS (SELECT * EXCLUDE ({', '.join(COUNTERS)}), {grown} FROM repaired)"


def _struct_last(c: str) -> str:
    # The value of the latest row even when it is null, as arg_max skips null values.
    return f"list({c} ORDER BY registerat DESC)[1]"


def _struct_first(c: str) -> str:
    return f"list({c} ORDER BY registerat)[1]"


def _windows_sql() -> str:
    keys = ", ".join(["macaddress", *_ATTRIBUTES, '"year"', '"month"', '"day"'])
    aggs = [f"CAST(ceil(avg({c})) AS INTEGER) AS {c}" for c in telemetry.FLAG_COLUMNS]
    aggs += [f"CAST(round(CAST(avg({c}) AS DECIMAL(28, 8)), 0) AS DOUBLE) AS {c}" for c in WHOLE_MEANS]
    aggs += [f"{_struct_last('statenum')} AS statenum"]
    aggs += [f"CAST(round(CAST(avg({c}) AS DECIMAL(28, 8)), 2) AS DOUBLE) AS {c}" for c in FINE_MEANS]
    aggs += [f"{_struct_last(COUNTERS[0])} - {_struct_first(COUNTERS[0])} AS {COUNTERS[0]}"]
    aggs += [
        f"CASE WHEN {_struct_last(c)} = 0 THEN 0 ELSE {_struct_last(c)} - {_struct_first(c)} END AS {c}"
        for c in COUNTERS[1:]
    ]
    bucket = "time_bucket(INTERVAL '10 minutes', seen)"
    return f"""
    SELECT {keys}, strftime({bucket}, '%Y-%m-%d %H:%M:%S') AS "start",
           strftime({bucket} + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS "end", {', '.join(aggs)}
    FROM grown GROUP BY {keys}, {bucket}"""


@query(
    f"WITH {_base_sql()}, {_decoded_sql()}, {_repaired_sql()} "
    "SELECT * EXCLUDE (seen) FROM repaired"
)
def device_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1, FLT1, SCL1-5, SCL10, WIN1-4: decoded and repaired readings."""
    return telemetry.repair(telemetry.decode(telemetry_rows(spark, sf_dir)), [], "6 hours")


@query(f"WITH {_base_sql()}, {_decoded_sql()}, {_repaired_sql()}, {_grown_sql()} {_windows_sql()}")
def device_ten_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN5, AGG1-6, DT1-3, PRJ8, SNK1: the whole chain to ten-minute rows, with the hand-over between jobs."""
    repaired = telemetry.repair(telemetry.decode(telemetry_rows(spark, sf_dir), packed=True), [], "6 hours")
    return telemetry.ten_minutes(mart.hand_over(repaired, "readings"), [], "6 hours")


_OF_MONTH = _grown_sql().replace("FROM repaired)", "FROM repaired WHERE \"year\" = '2024' AND \"month\" = '01')")


@query(f"WITH {_base_sql()}, {_decoded_sql()}, {_repaired_sql()}, {_OF_MONTH} {_windows_sql()}")
def device_month_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1-2, SRC4, SNK1, SRT1: one call from the run date over a raw zone to stored, sorted ten-minute rows."""
    zone, target = shared_folder(spark, "alive-zone"), shared_folder(spark, "alive-windows")
    write_partitioned(telemetry_rows(spark, sf_dir), zone, telemetry.PARTITION)
    return telemetry.month_job(spark, zone, target, dt.date(2024, 2, 3), [], slice_width=None, max_rows=2_000)


# Side tables, again from events. v is a small number that varies from event to event.
def side_rows(spark: SparkSession, sf_dir: str, columns: dict[str, str], where: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("e"),
        (F.col("user_id") % DEVICES).alias("d"),
        "event_type",
        (F.floor(F.col("value")) % 40).alias("v"),
    )
    at = F.timestamp_millis(F.col("registerat"))
    return (
        events.where(where)
        .withColumns(
            {
                "macaddress": F.concat(F.lit("dev-"), F.col("d").cast("string")),
                "registerat": F.lit(START_MS) + F.col("e") * STEP_MS,
                "additionalvalue": F.col("d") % 2,
            }
        )
        .withColumns(
            {
                "year": F.date_format(at, "yyyy"),
                "month": F.date_format(at, "MM"),
                "day": F.date_format(at, "dd"),
                **{name: F.expr(sql) for name, sql in columns.items()},
            }
        )
        .drop("e", "d", "v", "event_type")
    )


def _side_sql(name: str, columns: dict[str, str], where: str) -> str:
    listed = ", ".join(f"{sql} AS {column}" for column, sql in columns.items())
    return f"""
    {name} AS (SELECT *, strftime(seen, '%Y') AS "year", strftime(seen, '%m') AS "month", strftime(seen, '%d') AS "day",
               time_bucket(INTERVAL '10 minutes', seen) AS w, strftime(time_bucket(INTERVAL '10 minutes', seen), '%Y-%m-%d %H:%M:%S') AS "start",
               strftime(time_bucket(INTERVAL '10 minutes', seen) + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS "end"
        FROM (SELECT 'dev-' || CAST(d AS VARCHAR) AS macaddress, {START_MS} + e * {STEP_MS} AS registerat,
                     make_timestamp(({START_MS} + e * {STEP_MS}) * 1000) AS seen, d % 2 AS additionalvalue, {listed}
              FROM (SELECT event_id AS e, user_id % {DEVICES} AS d, event_type, CAST(floor(value) AS BIGINT) % 40 AS v FROM events)
              WHERE {where}))"""


# Column names of the side records; the expressions make them out of events.
_STATUS = {
    "operationmode": "v % 2",
    "insidetemperature": "v",
    "hotwatertemperaturesetting": "v + 30",
    "insidetemperaturesetting": "CASE WHEN v = 7 THEN NULL ELSE v + 2 END",
    "operationbusy": "v % 3",
    "ondoltemperaturesetting": "v + 1",
    "errorcode": "v % 4",
}
_STATUS_WHERE = "event_type <> 'signup'"
_CONNECTION = {"thingstype": "d % 2", "status": "CASE WHEN v % 3 = 0 THEN 'offline' ELSE 'online' END"}
_CONNECTION_WHERE = "event_type = 'view'"
_DEVICE = {
    "roomcontrollerswversion": "d % 4 + 1",
    "boilercontrollerswversion": "CASE WHEN v > 3 THEN d % 2 + 1 END",
    "boilercontrollerswsubversion": "v % 2",
    "hotwatertemperaturemin": "v",
    "hotwatertemperaturemax": "v + 40",
}
_DEVICE_WHERE = "event_type = 'signup'"
# Packed codes of an error record: item 0 holds a low part, item 1 a high part.
_ERROR_CODES = [f"v % 13 + 256 * {i}" if i % 2 == 0 else f"v * {i % 3}" for i in range(18)]
_ERROR_WHERE = "event_type = 'error'"


def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = ", ".join(f"CAST({c} AS INT)" for c in _ERROR_CODES)
    return side_rows(
        spark, sf_dir, {"ehrdlist": f"array(named_struct('column', array({codes})))"}, _ERROR_WHERE
    )


_STATUS_SQL = """
    status AS (SELECT macaddress, additionalvalue, operationmode, "year", "month", "day", "start", "end",
        CAST(round(CAST(avg(insidetemperature) AS DECIMAL(18, 8)), 2) AS DOUBLE) AS insidetemperature,
        CAST(round(CAST(avg(hotwatertemperaturesetting) AS DECIMAL(18, 8)), 2) AS DOUBLE) AS hotwatertemperaturesetting,
        CAST(round(CAST(avg(insidetemperaturesetting) AS DECIMAL(18, 8)), 2) AS DOUBLE) AS insidetemperaturesetting,
        max(operationbusy) AS operationbusy, max(ondoltemperaturesetting) AS ondoltemperaturesetting,
        max(errorcode) AS errorcode_status FROM status_raw GROUP BY ALL)"""
_CONNECTION_SQL = """
    connection AS (SELECT macaddress, thingstype, "year", "month", "day", "start", "end",
        arg_max(status, registerat) AS status FROM connection_raw GROUP BY ALL)"""
_DEVICE_SQL = """
    device AS (SELECT macaddress, additionalvalue, roomcontrollerswversion, boilercontrollerswversion,
        boilercontrollerswsubversion, "year", "month", "day", "start", "end",
        CAST(round(CAST(avg(hotwatertemperaturemin) AS DECIMAL(18, 8)), 2) AS DOUBLE) AS hotwatertemperaturemin,
        CAST(round(CAST(avg(hotwatertemperaturemax) AS DECIMAL(18, 8)), 2) AS DOUBLE) AS hotwatertemperaturemax
        FROM device_raw GROUP BY ALL)"""


def _error_sql() -> str:
    fields = ", ".join(
        f"max(CAST(c{i} % 256 AS INTEGER)) AS {name}" if i % 2 == 0 else f"max(CAST(round(c{i} / 256.0) AS INTEGER)) AS {name}"
        for i, name in telemetry.ERROR_FIELDS.items()
    )
    return f"""
    error AS (SELECT macaddress, additionalvalue, "year", "month", "day", "start", "end", {fields}
              FROM error_raw GROUP BY ALL)"""


_ERROR_RAW = {f"c{i}": sql for i, sql in enumerate(_ERROR_CODES)}


@query(f"WITH {_side_sql('error_raw', _ERROR_RAW, _ERROR_WHERE)}, {_error_sql()} SELECT * FROM error")
def error_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7, SCL7-8: packed error records, largest value per window."""
    return telemetry.error_windows(error_rows(spark, sf_dir))


@query(
    f"WITH {_side_sql('connection_raw', _CONNECTION, _CONNECTION_WHERE)}, {_CONNECTION_SQL} SELECT * FROM connection"
)
def connection_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4, AGG8: last connection status per window."""
    return telemetry.connection_windows(side_rows(spark, sf_dir, _CONNECTION, _CONNECTION_WHERE), [])


@query(f"WITH {_side_sql('device_raw', _DEVICE, _DEVICE_WHERE)}, {_DEVICE_SQL} SELECT * FROM device")
def device_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3, AGG8: temperature limits per software version."""
    return telemetry.device_windows(side_rows(spark, sf_dir, _DEVICE, _DEVICE_WHERE))


@query(f"WITH {_side_sql('status_raw', _STATUS, _STATUS_WHERE)}, {_STATUS_SQL} SELECT * FROM status")
def status_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3, AGG7-8, PRJ6: status means and maxima per operation mode."""
    return telemetry.status_windows(side_rows(spark, sf_dir, _STATUS, _STATUS_WHERE))


_LABEL = "CASE WHEN errorcode_low = 3 AND errorcode_high = 0 THEN 1 WHEN errorcode_low = 12 AND errorcode_high = 0 THEN 2 ELSE 3 END"


@query(
    f"""
    WITH {_base_sql()}, {_side_sql('error_raw', _ERROR_RAW, _ERROR_WHERE)}, {_error_sql()}
    SELECT macaddress, registerat FROM known
    WHERE macaddress IN (SELECT macaddress FROM error WHERE {_LABEL} IN (1, 2))"""
)
def device_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2-3, JN5, AGG9: readings of the devices that ever failed, by a semi-join."""
    failed = mart.failed_devices(telemetry.error_windows(error_rows(spark, sf_dir)))
    decoded = telemetry.decode(telemetry_rows(spark, sf_dir))
    return mart.keep_keys(decoded, failed, ["macaddress"]).select("macaddress", "registerat")


def _family_sql(number: int, parity: int) -> str:
    errors = ", ".join(f"e.{c}" for c in telemetry.ERROR_FIELDS.values())
    return f"""
    SELECT t.*, s.operationmode, s.insidetemperature, s.hotwatertemperaturesetting, s.insidetemperaturesetting,
           s.operationbusy, s.ondoltemperaturesetting, s.errorcode_status, {errors}, e.errorlabel,
           v.roomcontrollerswversion, v.boilercontrollerswversion, v.boilercontrollerswsubversion,
           v.hotwatertemperaturemin, v.hotwatertemperaturemax, {number} AS type
    FROM (SELECT * FROM ten WHERE additionalvalue = {parity}
          AND macaddress IN (SELECT macaddress FROM labelled WHERE errorlabel IN (1, 2))) t
    LEFT JOIN status s ON t.macaddress = s.macaddress AND t."start" = s."start"
    LEFT JOIN labelled e ON t.macaddress = e.macaddress AND t."start" = e."start"
    LEFT JOIN device v ON t.macaddress = v.macaddress AND t."start" = v."start\""""


def _mart_sql() -> str:
    zeroed = ", ".join(f"coalesce({c}, 0) AS {c}" for c in mart.ZERO_COLUMNS)
    order = '"start", operationmode, hotwatertemperaturemin, boilercontrollerswsubversion'
    versions = ", ".join(
        f"coalesce(first_value({c} IGNORE NULLS) OVER (PARTITION BY macaddress ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), "
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY macaddress ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in mart.VERSIONS
    )
    required = " AND ".join(f"{c} IS NOT NULL" for c in mart.REQUIRED)
    return f"""
    WITH {_base_sql()}, {_decoded_sql()}, {_repaired_sql()}, {_grown_sql()},
    ten AS (SELECT * EXCLUDE ("end") FROM ({_windows_sql()})),
    {_side_sql('error_raw', _ERROR_RAW, _ERROR_WHERE)}, {_error_sql()},
    labelled AS (SELECT *, {_LABEL} AS errorlabel FROM error),
    {_side_sql('status_raw', _STATUS, _STATUS_WHERE)}, {_STATUS_SQL},
    {_side_sql('connection_raw', _CONNECTION, _CONNECTION_WHERE)}, {_CONNECTION_SQL},
    {_side_sql('device_raw', _DEVICE, _DEVICE_WHERE)}, {_DEVICE_SQL},
    weather AS (SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M:%S') AS "start",
                       min(CAST(floor(value) AS BIGINT) % 40) AS temperature FROM events GROUP BY 1),
    families AS ({_family_sql(2, 0)} UNION ALL {_family_sql(3, 1)}),
    joined AS (SELECT f.* EXCLUDE ({', '.join(mart.ZERO_COLUMNS)}), {zeroed}, c.thingstype, c.status, w.temperature
               FROM families f LEFT JOIN connection c ON f.macaddress = c.macaddress AND f."start" = c."start"
               LEFT JOIN weather w ON f."start" = w."start" WHERE {required}),
    times AS (SELECT macaddress, "start", min(CASE WHEN errorlabel IN (1, 2) THEN errorlabel END) AS lab
              FROM joined GROUP BY ALL),
    ahead AS (SELECT macaddress, "start",
                     first_value(CASE WHEN lab IS NOT NULL THEN "start" END IGNORE NULLS) OVER later AS next_start,
                     first_value(lab IGNORE NULLS) OVER later AS next_lab
              FROM times WINDOW later AS (PARTITION BY macaddress ORDER BY "start" ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    marked AS (SELECT j.* EXCLUDE (errorlabel), CASE WHEN errorlabel IN (0, 3)
                      AND CAST(a.next_start AS TIMESTAMP) - INTERVAL 1 DAY <= CAST(j."start" AS TIMESTAMP)
                      THEN a.next_lab ELSE errorlabel END AS errorlabel
               FROM joined j JOIN ahead a ON j.macaddress = a.macaddress AND j."start" = a."start")
    SELECT * EXCLUDE ({', '.join(mart.VERSIONS)}, additionalvalue), CAST(additionalvalue AS VARCHAR) AS additionalvalue, {versions} FROM marked"""


def ten_minute_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten-minute measures for the mart, handed over because each family reads them."""
    return mart.hand_over(device_ten_minutes(spark, sf_dir).drop("end"), "mart-readings")


@query(_mart_sql())
def device_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1-4, SET1, PRJ3-5, NUL1, FLT3-4, WIN7-8: the wide mart of two device families."""
    ten = ten_minute_state(spark, sf_dir)
    errors = telemetry.error_windows(error_rows(spark, sf_dir))
    status = telemetry.status_windows(side_rows(spark, sf_dir, _STATUS, _STATUS_WHERE))
    devices = telemetry.device_windows(side_rows(spark, sf_dir, _DEVICE, _DEVICE_WHERE))
    connection = telemetry.connection_windows(side_rows(spark, sf_dir, _CONNECTION, _CONNECTION_WHERE), [])
    weather = (
        table(spark, sf_dir, "events")
        .groupBy(F.window("ts", "10 minutes").alias("w"))
        .agg(F.min(F.floor("value") % 40).alias("temperature"))
        .select(F.col("w.start").cast("string").alias("datetime"), "temperature")
    )
    readings = {number: ten.where(F.col("additionalvalue") == parity) for number, parity in ((2, 0), (3, 1))}
    families = mart.family_rows(readings, status, errors, devices)
    return mart.build_mart(
        families,
        connection,
        weather,
        tiebreak=["operationmode", "hotwatertemperaturemin", "boilercontrollerswsubversion"],
        slice_width="12 hours",
    )


def month_zone(spark: SparkSession, rows: DataFrame, name: str) -> str:
    zone = shared_folder(spark, f"{name}-zone")
    write_partitioned(rows, zone, telemetry.PARTITION)
    return zone


_MONTH = "WHERE \"year\" = '2024' AND \"month\" = '01'"


@query(
    f"""
    WITH {_side_sql('connection_raw', _CONNECTION, _CONNECTION_WHERE)}, {_CONNECTION_SQL}, {_side_sql('status_raw', _STATUS, _STATUS_WHERE)}, {_STATUS_SQL},
    {_side_sql('device_raw', _DEVICE, _DEVICE_WHERE)}, {_DEVICE_SQL}, {_side_sql('error_raw', _ERROR_RAW, _ERROR_WHERE)}, {_error_sql()}
    SELECT 'connection' AS side, macaddress, "start", "day", status AS told FROM connection {_MONTH}
    UNION ALL SELECT 'status', macaddress, "start", "day", CAST(operationbusy AS VARCHAR) FROM status {_MONTH}
    UNION ALL SELECT 'device', macaddress, "start", "day", CAST(roomcontrollerswversion AS VARCHAR) FROM device {_MONTH}
    UNION ALL SELECT 'error', macaddress, "start", "day", CAST(errorcode_low AS VARCHAR) FROM error {_MONTH}"""
)
def device_side_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1-2, SNK1, AGG3-8: the month jobs of all side tables, each from its zone to stored windows."""
    told = {"connection": "status", "status": "operationbusy", "device": "roomcontrollerswversion", "error": "errorcode_low"}
    parts = []
    for side, records in (
        ("connection", side_rows(spark, sf_dir, _CONNECTION, _CONNECTION_WHERE)),
        ("status", side_rows(spark, sf_dir, _STATUS, _STATUS_WHERE)),
        ("device", side_rows(spark, sf_dir, _DEVICE, _DEVICE_WHERE)),
        ("error", error_rows(spark, sf_dir)),
    ):
        target = shared_folder(spark, f"{side}-windows")
        stored = telemetry.side_month_job(spark, side, month_zone(spark, records, side), target, dt.date(2024, 2, 3))
        parts.append(stored.select(F.lit(side).alias("side"), "macaddress", "start", "day", F.col(told[side]).cast("string").alias("told")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
