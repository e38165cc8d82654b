"""Query registry (kept separate from the catalog so query modules can import each other)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[dict, SparkSession], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    ops: str = ""


CATALOG: dict[str, Query] = {}


def query(name: str, ops: str = "", sql: str | None = None, doubles: list[str] | None = None):
    """Decorator registering ``fn(t, spark) -> DataFrame`` where ``t`` is the dict of tables."""
    def deco(fn):
        CATALOG[name] = Query(name, fn, sql, list(doubles or []), ops)
        return fn
    return deco
