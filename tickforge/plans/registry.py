"""Named queries over the driver's tables: a Spark builder and (when SQL can say it) the
equivalent DuckDB SQL used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn

    return deco
