"""Named queries: a Spark builder (spark, sf_dir) -> DataFrame and, when the
operator is expressible in ANSI SQL, its DuckDB twin over the raw tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str = ""  # SURVEY §2 ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def with_ctes(ctes, body: str) -> str:
    """WITH c1, c2, ... body  -- drops repeated CTE definitions, keeps order."""
    seen, out = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return ("WITH " + ",\n".join(out) + "\n" if out else "") + body
