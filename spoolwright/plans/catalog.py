"""All queries of the core, by name, and the SQL equivalent of those that have one."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("interval_queries", "text_queries", "lookup_queries", "sequence_queries", "metric_queries", "stream_queries", "signal_queries", "manifest_queries", "record_queries", "source_queries")


def _modules() -> list:
    return [import_module(f"spoolwright.plans.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for m in _modules() for name, run in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
