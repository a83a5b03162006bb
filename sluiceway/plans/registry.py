"""The registered queries: a Spark callable each, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFunction
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(oracle: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function under its own name."""

    def register(function: QueryFunction) -> QueryFunction:
        if function.__name__ in REGISTRY:
            raise ValueError(f"two queries named {function.__name__}")
        REGISTRY[function.__name__] = Query(function, oracle)
        return function

    return register


def table_path(sf_dir: str, name: str) -> str:
    """Where a table lies: a file, or a folder of files."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def load_all() -> dict[str, Query]:
    from sluiceway.plans import on_devices, on_events, on_loads, on_orders, on_storage, on_text  # noqa: F401

    return REGISTRY
