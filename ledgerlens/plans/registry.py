"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where SQL
can express it, the equivalent DuckDB SQL over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    fn: QueryFn
    sql: str | None
    section: str


REGISTRY: dict[str, Entry] = {}


def register(name: str, section: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql, section)
        return fn
    return deco
