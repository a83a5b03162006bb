"""Compare registered queries with their SQL. Run as a script: ``python tests/compare.py sf_dir [name ...]``."""

from __future__ import annotations

import collections
import datetime as dt
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, bool | int):
        return int(value)
    return value


def bag(columns, rows) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, run, sql: str, sf_dir: str) -> tuple[int, list]:
    """(row count, differences); a difference is ('name', left, right) or ('row', side, values)."""
    df = run(spark, sf_dir)
    left_columns = df.columns
    result = con.execute(sql)
    right_columns = [c[0] for c in result.description]
    if sorted(left_columns) != sorted(right_columns):
        return 0, [("columns", sorted(left_columns), sorted(right_columns))]
    left = bag(left_columns, df.collect())
    right = bag(right_columns, result.fetchall())
    diffs = [("spark", row) for row in (left - right)] + [("sql", row) for row in (right - left)]
    return sum(left.values()), diffs


def main(sf_dir: str, names: list[str]) -> None:
    from sluiceway.plans.registry import load_all
    from sluiceway.session import local_session

    spark = local_session(**{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name, registered in load_all().items():
        if names and name not in names:
            continue
        begun = time.time()
        try:
            if registered.oracle is None:
                n, diffs = registered.run(spark, sf_dir).count(), []
            else:
                n, diffs = compare(spark, con, registered.run, registered.oracle, sf_dir)
        except Exception as error:  # report and go on with the next query
            n, diffs = 0, [("error", str(error)[:600])]
        mark = "ok " if not diffs else "BAD"
        print(f"{mark} {name} rows={n} diffs={len(diffs)} {time.time() - begun:.2f}s", flush=True)
        for diff in diffs[:2] + diffs[-2:]:
            print("      ", str(diff)[:700])
        if diffs:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
