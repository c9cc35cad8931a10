"""Keyed feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows, and the existing rows whose key is not among them. New columns are null on old rows."""
    if existing is None:
        return incoming
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return incoming.unionByName(kept, allowMissingColumns=True)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness, null keys included, with their row counts. Empty on a sound table."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter((F.col("n_rows") > 1) | has_null)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when the key is not unique. Runs one job."""
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"rows repeat or lack the key {tuple(keys)}")
