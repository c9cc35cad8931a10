"""Row helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Bytes of text that a task looks at in one go; a longer text is taken whole, alone.
SLICE_BYTES = 1 << 19

#: Rows that Spark hands to a task's Python at a time, at most. They are copied some times on either side.
BATCH_ROWS = 1000


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application: they may not have it on their path. Texts are long
    rows, so a session that hands over more than BATCH_ROWS at a time is set to that."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    root, context = Path(__file__).resolve().parents[1], spark.sparkContext
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="ebbtide-package-")) / "ebbtide.zip"  # Spark copies it to the executors
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def number_rows(df: DataFrame, keys: list[str], order: list[str], number: str, name: str) -> DataFrame:
    """``df`` with ``number``: gapless from 0 within each value of ``keys``, however many rows a value has.

    Rows are dealt to parts by their place in the input and written once, so that the dealing is the same on every
    reading. A part numbers its own rows of a key; where a part begins follows from the counts by part.
    """
    spark = df.sparkSession
    parts = 2 * shuffle_partitions(spark)
    dealt = materialize(df.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")), name)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        dealt.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(k).alias(f"_key_{k}") for k in keys],
            F.col("_part").alias("_first_part"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        )
    )
    within = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)) - 1
    own = dealt.withColumn("_within", within)
    same = own["_part"] == first["_first_part"]
    for k in keys:
        same &= own[k].eqNullSafe(first[f"_key_{k}"])
    return (
        own.join(first, same)
        .withColumn(number, F.col("_first") + F.col("_within"))
        .drop("_part", "_first_part", "_first", "_within", *[f"_key_{k}" for k in keys])
    )


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about SLICE_BYTES of text in ``column``."""
    begin, held = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if held and held + n > SLICE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def map_texts(
    df: DataFrame, columns: list[Column | str], work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``work`` over runs of rows of ``columns``, of which the last is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                yield work(part)

    return df.select(*columns).mapInArrow(run, schema)
