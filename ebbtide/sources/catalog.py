"""Catalog tables over the folders of the store: one name to query, partitions and statistics for the planner."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.schemas import create_table_sql
from ebbtide.sources.writers import path_exists

#: Partitions that one statement adds.
ADDED = 100


def create_external(spark: SparkSession, name: str, schema: T.StructType, path: str, partition_by: Sequence[str] = ()) -> None:
    """A table over the Parquet files below ``path``, unless it is there. Dropping it leaves the files.

    Of a partitioned table the catalog knows only partitions that have been added: queries list no folders.
    """
    spark.sql(create_table_sql(name, schema, partition_by=partition_by, location=path))
    if partition_by and path_exists(spark, path):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")  # what the folder held before


def written_partitions(df: DataFrame, partition_by: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``df``, and what will tell the partitions of its rows once it has been written: they are seen on the way."""
    seen = Observation()
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])
    return df.observe(seen, F.collect_set(values).alias("partitions")), seen


def _literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_partitions(spark: SparkSession, name: str, partition_by: Sequence[str], values: Iterable[Row]) -> None:
    """Tell the catalog of partitions (values as text). Known ones stay as they are."""
    specs = [", ".join(f"`{c}` = {_literal(row[c])}" for c in partition_by) for row in values]
    for at in range(0, len(specs), ADDED):
        parts = " ".join(f"PARTITION ({spec})" for spec in specs[at : at + ADDED])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(name)


def forget_partitions(spark: SparkSession, name: str) -> None:
    """Make the catalog's partitions those of the folders, after a table was replaced as a whole."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


@contextmanager
def _with_histograms(spark: SparkSession, bins: int) -> Iterator[None]:
    wanted = {"spark.sql.statistics.histogram.enabled": "true", "spark.sql.statistics.histogram.numBins": str(bins)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def analyze(spark: SparkSession, name: str, bins: int = 64) -> None:
    """Row count and size of the table, and for each column its extremes, nulls, distinct values and a histogram of equal
    heights. The planner estimates filters and joins by them in a session with ``spark.sql.cbo.enabled``."""
    with _with_histograms(spark, bins):
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def estimated_rows(df: DataFrame) -> int | None:
    """The planner's estimate of the rows of a frame, before it runs; none without statistics."""
    rows = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    return int(str(rows.get())) if rows.isDefined() else None


def table_rows(spark: SparkSession, name: str) -> int | None:
    """The rows that the catalog knows of, from the last ``analyze``."""
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    counted = re.search(r"(\d+) rows", about.get("Statistics") or "")
    return int(counted[1]) if counted else None


def column_statistics(spark: SparkSession, name: str, column: str) -> dict[str, str]:
    """What the catalog knows of a column."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name} `{column}`").collect()
    return {r["info_name"]: r["info_value"] for r in rows}
