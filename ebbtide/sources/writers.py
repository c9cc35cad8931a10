"""Frames -> tables and files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.upsert import assert_unique, keyed_upsert
from ebbtide.schemas import conform
from ebbtide.session import materialize


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    """Append to a log. A given schema is enforced; without one, new columns show up on reading."""
    rows = conform(df, schema) if schema is not None else df
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write the partitions that have rows in ``df``, in the place of what they held. Others stay."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a log, columns of every batch; older batches have null in newer columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def upsert_table(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Create the keyed table, or merge into it: incoming rows replace those of the same key.

    With ``partition_by``, columns that the key determines, only the partitions of incoming rows are read and
    rewritten; the files of the others stay. Without, the whole table is. The merged rows are written in the shared
    folder first, since they come from what they replace.
    """
    spark = df.sparkSession
    assert_unique(df, keys)
    if not path_exists(spark, path):
        df.write.partitionBy(*partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)
    old = read_log(spark, path)
    if partition_by:
        touched = df.select(*[F.col(c).alias(f"_touched_{c}") for c in partition_by]).distinct()
        own = [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in partition_by]
        old = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        old = old.join(touched, own, "left_semi")
    merged = materialize(keyed_upsert(old, df, keys), "upsert")
    if partition_by:
        replace_partitions(merged, path, partition_by)
    else:
        merged.write.mode("overwrite").parquet(path)
    return spark.read.schema(merged.schema).parquet(path).select(*merged.columns)


def append_snapshot(df: DataFrame, path: str, stamp: str, catalog: str, schema: str) -> None:
    """Freeze the training features of a run; each run is a partition of its own."""
    stamped = df.withColumns(
        {"catalog": F.lit(catalog), "schema": F.lit(schema), "snapshot_timestamp": F.lit(stamp).cast("timestamp")}
    )
    stamped.write.mode("append").partitionBy("snapshot_timestamp").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition."""
    df.write.mode("overwrite").csv(path, header=True)
