"""Registered queries and, where SQL can state them, the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_THEMES = ("cohorts", "sales", "modelling", "projection", "metrics", "drift", "quality", "lifecycle", "upkeep")


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for theme in _THEMES:
        found.update(import_module(f"{__name__}.{theme}").QUERIES)
    return found


def all_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for theme in _THEMES:
        found.update(import_module(f"{__name__}.{theme}").SQL)
    return found
