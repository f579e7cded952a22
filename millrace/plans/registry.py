"""Queries over the driver tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.views import oracle as _oracle
from millrace.plans.views import view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``f(v)`` where ``v(name)`` reads a table or view; ``sql`` is its twin."""

    def register(f):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are named {key}")
        QUERIES[key] = lambda spark, sf_dir: f(lambda n: view(spark, sf_dir, n))
        if sql:
            ORACLES[key] = _oracle(sql)
        return f

    return register


def raw_query(sql: str | None = None):
    """Register ``f(spark, sf_dir)``."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = _oracle(sql)
        return f

    return register


for _module in ("text", "validation", "dedup", "events", "scoring", "retrieval", "jobs", "evaluation", "stream"):
    import_module(f"millrace.plans.{_module}_queries")
