"""Change data under a schema that changes: each change is read under the columns that its table had at its position."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DDL = r"(?i)^\s*ALTER\s+TABLE\s+`?(?:\w+`?\.`?)?(\w+)`?\s+(ADD|DROP|RENAME|CHANGE|MODIFY)\s+(?:COLUMN\s+)?`?(\w+)`?\s*(.*?)\s*;?\s*$"
_STATE = "array<struct<names: array<struct<file: string, pos: bigint, name: string>>, kind: string, dropped: boolean>>"
#: Types of the database, by how they begin, and what they are here.
KINDS = {
    "tinyint": "int",
    "smallint": "int",
    "mediumint": "int",
    "bigint": "bigint",
    "int": "int",
    "decimal": "decimal",
    "numeric": "decimal",
    "double": "double",
    "float": "double",
    "datetime": "timestamp",
    "timestamp": "timestamp",
    "date": "date",
    "bool": "boolean",
}


def spark_type(kind: str | None) -> str:
    """A database type as one of Spark; what is not known is text."""
    kind = (kind or "").strip().lower()
    for start, known in KINDS.items():
        if kind.startswith(start):
            size = re.match(r"\w+\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", kind)
            return f"decimal({size[1]},{size[2] or 0})" if known == "decimal" and size else "decimal(10,0)" if known == "decimal" else known
    return "string"


def ddl_events(messages: DataFrame, column: str = "value") -> DataFrame:
    """``source_table, file, pos, verb, name, rest`` of the column changes among the messages; other DDL is left out."""
    text = F.col(column).cast("string")
    told = messages.select(
        F.coalesce(F.get_json_object(text, "$.payload.ddl"), F.get_json_object(text, "$.ddl")).alias("ddl"),
        F.coalesce(F.get_json_object(text, "$.payload.source.file"), F.lit("")).alias("file"),
        F.get_json_object(text, "$.payload.source.pos").cast("bigint").alias("pos"),
    ).where(F.col("ddl").rlike(_DDL))
    part = [F.regexp_extract("ddl", _DDL, i + 1) for i in range(4)]
    return told.select(part[0].alias("source_table"), "file", "pos", F.upper(part[1]).alias("verb"), part[2].alias("name"), part[3].alias("rest"))


def schema_versions(events: DataFrame, first: dict[str, dict[str, str]]) -> DataFrame:
    """``source_table, columns``: the columns of each table with all names that they have had, folded in order of (file, pos).

    ``first`` has the columns of each table before any event, by name, with their database types. A table has few events, and
    they meet in one row. An event that is read twice counts once.
    """
    spark = events.sparkSession
    begun = [
        (table, [([("", -1, name)], kind, False) for name, kind in columns.items()]) for table, columns in first.items()
    ]
    base = spark.createDataFrame(begun, f"source_table string, base {_STATE}")
    told = F.array_sort(F.collect_set(F.struct("file", "pos", "verb", "name", "rest"))).alias("events")
    folded = base.join(events.groupBy("source_table").agg(told), "source_table", "left")

    def step(state: Column, e: Column) -> Column:
        target = F.regexp_extract(e["rest"], r"(?i)^(?:TO\s+)?`?(\w+)`?\s*(.*)$", 1)
        kind_after = F.regexp_extract(e["rest"], r"(?i)^(?:TO\s+)?`?(\w+)`?\s*(.*)$", 2)
        renames = e["verb"].isin("RENAME", "CHANGE")

        def changed(c: Column) -> Column:
            named = F.concat(c["names"], F.array(F.struct(e["file"].alias("file"), e["pos"].alias("pos"), target.alias("name"))))
            kind = F.when(e["verb"] == "MODIFY", e["rest"]).when(e["verb"] == "CHANGE", kind_after).otherwise(c["kind"])
            here = (F.element_at(c["names"], -1)["name"] == e["name"]) & ~c["dropped"]
            return F.when(
                here,
                F.struct(
                    F.when(renames, named).otherwise(c["names"]).alias("names"), kind.alias("kind"), (e["verb"] == "DROP").alias("dropped")
                ),
            ).otherwise(c)

        added = F.struct(
            F.array(F.struct(e["file"].alias("file"), e["pos"].alias("pos"), e["name"].alias("name"))).alias("names"),
            e["rest"].alias("kind"),
            F.lit(False).alias("dropped"),
        )
        return F.when(e["verb"] == "ADD", F.concat(state, F.array(added))).otherwise(F.transform(state, changed)).cast(_STATE)

    none = F.array().cast("array<struct<file: string, pos: bigint, verb: string, name: string, rest: string>>")
    state = F.aggregate(F.coalesce("events", none), F.col("base").cast(_STATE), step)
    return folded.select("source_table", state.alias("columns"))


def unwrap_maps(messages: DataFrame, column: str = "value") -> DataFrame:
    """``source_table, file, pos, op, row`` of every change; ``row`` maps the names of its time to values as text."""
    envelope = (
        "payload struct<before: map<string, string>, after: map<string, string>, op: string, "
        "source: struct<file: string, pos: bigint, `table`: string>>"
    )
    payload = messages.select(F.from_json(F.col(column).cast("string"), envelope)["payload"].alias("p")).where("p.op IS NOT NULL")
    return payload.select(
        F.col("p.source.table").alias("source_table"),
        F.coalesce("p.source.file", F.lit("")).alias("file"),
        F.col("p.source.pos").alias("pos"),
        "p.op",
        F.coalesce("p.after", "p.before").alias("row"),
    )


def under_final_schema(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """The rows of ``unwrap_maps`` under the last names of their tables: renamed columns follow, dropped ones go, new ones are null."""
    at = F.struct("file", "pos")

    def value(c: Column) -> Column:
        known = F.filter(c["names"], lambda n: F.struct(n["file"], n["pos"]) <= at)
        name = F.try_element_at(known, F.lit(-1))["name"]
        return F.struct(F.element_at(c["names"], -1)["name"].alias("name"), F.try_element_at("row", name).alias("value"))

    live = F.filter("columns", lambda c: ~c["dropped"])
    rows = changes.join(versions, "source_table")
    return rows.select("source_table", "file", "pos", "op", F.map_from_entries(F.transform(live, value)).alias("row"))


def latest_rows(changes: DataFrame, versions: DataFrame, table: str, key: str) -> DataFrame:
    """The current rows of one table, typed as its last schema says; ``key`` is the last name of the key column.

    The newest row is found by sorting, so changes are shuffled by key before and not after it: a task sorts a share of the keys and
    not all changes of its input, which a small file may unfold into.
    """
    rows = under_final_schema(changes.where(F.col("source_table") == table), versions)
    newest = F.max_by(F.struct("op", "row"), F.struct("file", "pos")).alias("newest")
    by_key = rows.select(F.col("row")[key].alias("_key"), "file", "pos", "op", "row").repartition("_key")
    current = by_key.groupBy("_key").agg(newest).where("newest.op <> 'd'")
    columns = versions.where(F.col("source_table") == table).select("columns").first()[0]
    typed = [(c["names"][-1]["name"], spark_type(c["kind"])) for c in columns if not c["dropped"]]
    return current.select(*[F.col("newest.row")[name].try_cast(kind).alias(name) for name, kind in typed])
