"""Registry of named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None, name: str | None = None):
    """Register a function under its own or a given name, with its checking
    SQL if any."""
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if check is not None:
            CHECKS[key] = check
        return fn
    return add


def load_all() -> None:
    from rulemill.plans import (  # noqa: F401
        agents, documents, evaluation, inference, mining, payloads, profiling,
        prompts, rulesets, tracking, vectors, versions)
