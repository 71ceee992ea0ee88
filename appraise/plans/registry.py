"""Named queries over the landed tables, each with its SQL form where one exists.

A query is a callable ``(spark, base_dir) -> DataFrame``. Its SQL form (if any)
is the plain-SQL statement of the same result over views named like the tables;
queries whose work is iterative or streaming have none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco
