"""All registered queries, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from icelens.catalog.oracle import assemble
from icelens.catalog.shape import shaped, shaped_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, spec: str, sql: str | None = None):
    """Register ``fn(spark, folder)``; ``sql`` is its DuckDB statement over the oracle blocks."""
    def wrap(fn):
        QUERIES[name] = lambda spark, folder: shaped(fn(spark, folder), spec)
        if sql is not None:
            ORACLES[name] = shaped_sql(assemble(f"out AS ({sql})"), spec, "out")
        return fn
    return wrap


from icelens.catalog import ingest, intervals, models, scalars, totals, values  # noqa: E402,F401
