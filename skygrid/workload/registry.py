"""Registered queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from skygrid.workload.fixtures import Tables, check_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, uses: Sequence[str] = (), sql: str | None = None):
    """Register ``fn(tables)``; ``sql`` is a SELECT, or a WITH list and a SELECT, over ``uses``."""
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = compose(uses, sql)
        return fn
    return register


def compose(uses: Sequence[str], sql: str) -> str:
    body, head = sql.strip(), check_ctes(uses)
    if not head:
        return body
    if body.lower().startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"
