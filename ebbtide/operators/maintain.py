"""Manifests and compaction of Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import materialize

#: Size of the files that a compaction aims at.
FILE_BYTES = 128 << 20


def canonical_row(df: DataFrame) -> Column:
    """The row as one text that any engine can write: fractions with six decimals, times to the second, ``~`` for null,
    each value after its length."""

    def text(name: str) -> Column:
        kind, value = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            value = value.cast("decimal(38,6)")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        shown = F.coalesce(value.cast("string"), F.lit("~"))
        return F.concat(F.length(shown).cast("string"), F.lit(":"), shown)

    return F.concat(*[text(c) for c in df.columns])


def _content(df: DataFrame) -> list[Column]:
    """Row count, and the sum of the first 15 hexadecimal digits of each row's md5.

    The hashes are summed as DECIMAL, so the sum neither overflows nor depends on the order of addition.
    """
    digits = F.substring(F.md5(canonical_row(df).cast("binary")), 1, 15)
    row_hash = F.conv(digits, 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(row_hash), F.lit(0)).cast("string")
    return [F.count("*").alias("row_count"), total.alias("content_hash")]


def content_summary(df: DataFrame) -> DataFrame:
    """One row: row count and a hash of the content that does not depend on row order or partitioning."""
    return df.agg(*_content(df))


def manifest(df: DataFrame, dataset_name: str, source: str, environment: str, recorded_at: str) -> DataFrame:
    """The version record of a dataset: what it held, with which schema, when."""
    return _version(content_summary(df), df.schema, dataset_name, source, environment, recorded_at)


def _version(
    summary: DataFrame, schema: T.StructType, dataset_name: str, source: str, environment: str, recorded_at: str
) -> DataFrame:
    return summary.select(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(source).alias("source_table"),
        "row_count",
        F.lit(len(schema)).alias("n_columns"),
        "content_hash",
        F.lit(schema.json()).alias("schema_json"),
        F.lit(environment).alias("environment"),
        F.lit(recorded_at).cast("timestamp").alias("recorded_at"),
    )


def partition_contents(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], known: DataFrame | None = None
) -> DataFrame:
    """For each partition of a table: its columns (as text), files_hash, row_count, content_hash, and whether it was ``read``.

    Only partitions whose files are not those of ``known``, an earlier result, are read and hashed; the others keep what
    it says, and those that are gone go. Hashes of rows are added up, so the parts' sums are the table's: see
    ``manifest_of_parts``.
    """
    now = _by_partition(file_listing(spark, path, partition_by), partition_by).select(*partition_by, "files_hash")
    if known is None:
        known = now.limit(0).withColumns({"row_count": F.lit(0).cast("long"), "content_hash": F.lit("")})
    kept = known.select(*partition_by, F.col("files_hash").alias("_then"), "row_count", "content_hash")
    now = materialize(_same_keys(now, kept, partition_by, "left"), "partitions")
    same = F.col("files_hash").eqNullSafe(F.col("_then"))
    changed = now.filter(~same)
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in schema])
    rows = _same_keys(spark.read.schema(text).parquet(path), changed.select(*partition_by), partition_by, "left_semi")
    folders = {f"_folder_{c}": F.col(c) for c in partition_by}
    typed = rows.withColumns(folders).withColumns({c: F.col(c).cast(schema[c].dataType) for c in partition_by})
    hashed = typed.groupBy(*folders).agg(*_content(typed.select(*schema.names)))
    hashed = hashed.withColumnsRenamed({f"_folder_{c}": c for c in partition_by})
    read = _same_keys(changed.drop("row_count", "content_hash"), hashed, partition_by, "left")
    columns = [*partition_by, "files_hash", "row_count", "content_hash"]
    return now.filter(same).select(*columns, F.lit(False).alias("read")).union(read.select(*columns, F.lit(True).alias("read")))


def manifest_of_parts(
    parts: DataFrame, schema: T.StructType, dataset_name: str, source: str, environment: str, recorded_at: str
) -> DataFrame:
    """The manifest of a table from its ``partition_contents``: equal to that of all its rows."""
    total = F.coalesce(F.sum(F.col("content_hash").cast("decimal(38,0)")), F.lit(0)).cast("string")
    summary = parts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), total.alias("content_hash"))
    return _version(summary, schema, dataset_name, source, environment, recorded_at)


def cluster(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows ranged and sorted by the columns, so that filters on them skip files.

    A hash of the row is the last range key: a value with very many rows is cut into several files, not put into one.
    """
    spread = F.xxhash64(*df.columns)
    keys = [F.col(c) for c in columns]
    ranged = df.repartitionByRange(files, *keys, spread) if files else df.repartitionByRange(*keys, spread)
    return ranged.sortWithinPartitions(*keys)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files of a table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str] = (),
    files: int | None = None,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Rewrite a Parquet table clustered by the columns, and compare the content before handing it over.

    Writes ``target`` and returns one row (rows and hash before and after, ``same_content``); swap the tables only when
    that is true. Without columns it only compacts; without ``files`` their number follows from the table's size. What
    is written is counted and hashed on its way, so the source is not read again for that.
    """
    files = files or max(1, -(-table_bytes(spark, source) // file_bytes))
    before = spark.read.parquet(source)
    rewritten = cluster(before, columns, files) if columns else before.repartition(files, F.xxhash64(*before.columns))
    seen = Observation()
    rewritten.observe(seen, *_content(before)).write.mode("errorifexists").parquet(target)
    after = spark.read.schema(before.schema).parquet(target)
    return (
        content_summary(after)
        .select(
            F.lit(seen.get["row_count"]).alias("rows_before"),
            F.lit(seen.get["content_hash"]).alias("hash_before"),
            F.col("row_count").alias("rows_after"),
            F.col("content_hash").alias("hash_after"),
        )
        .withColumn("same_content", _agrees())
    )


def _written_columns(spark: SparkSession, path: str, partition_by: Sequence[str]) -> T.StructType:
    """The table's schema with the partition columns as text, as the names of the folders hold them: read so, they
    are written under the same names."""
    schema = spark.read.parquet(path).schema
    missing = [c for c in partition_by if c not in schema.names]
    if missing:
        raise ValueError(f"{path} is not partitioned by {', '.join(missing)}")
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in schema])


def file_listing(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """The Parquet files of a partitioned table, without reading them: partition columns (as text), path, length."""
    fixed = "path string, modificationTime timestamp, length long, content binary"
    schema = ", ".join([fixed, *[f"`{c}` string" for c in partition_by]])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").schema(schema).load(path)
    return files.select(*partition_by, "path", "length")


def _by_partition(files: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Files, bytes, and a sum over the files' names and lengths that tells whether any came or went."""
    names = F.sum(F.xxhash64("path", "length").cast("decimal(38,0)"))
    return files.groupBy(*partition_by).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"), names.alias("files_hash")
    )


def scattered(spark: SparkSession, path: str, partition_by: Sequence[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """The partitions worth a rewrite, with the number of files they need (``bins``): those that fit into one file and
    have several, and larger ones with at least two more than they need. A partition just rewritten is not among them.
    """
    found = _by_partition(file_listing(spark, path, partition_by), partition_by)
    found = found.withColumn("bins", F.greatest(F.ceil(F.col("bytes") / file_bytes), F.lit(1)))
    return found.filter(F.col("n_files") > F.when(F.col("bins") == 1, 1).otherwise(F.col("bins") + 1))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    joined = left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], how)
    return joined.drop(*[f"_key_{k}" for k in keys])


def _agrees() -> Column:
    return (F.col("rows_before") == F.col("rows_after")) & (F.col("hash_before") == F.col("hash_after"))


def compact_partitions(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str],
    columns: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Rewrite the scattered partitions of a table beside it, each in as few files as its size needs.

    Returns the report (one row: partitions, rows and hash before and after, ``same_content``) and the partitions
    that ``target`` holds, for ``swap_partitions``. Other partitions are neither read nor written. A partition that fits
    into one file goes to one task; larger ones are cut by ranges of the clustering columns and, within a value, of
    a row hash. Without scattered partitions nothing is written, and the report counts none.
    """
    schema = _written_columns(spark, source, partition_by)
    known = materialize(scattered(spark, source, partition_by, file_bytes), "scattered")
    small, large, bins = known.agg(
        F.count_if(F.col("bins") == 1), F.count_if(F.col("bins") > 1), F.sum(F.when(F.col("bins") > 1, F.col("bins")))
    ).first()
    rows = _same_keys(spark.read.schema(schema).parquet(source), known.select(*partition_by, "bins"), partition_by, "inner")
    order, rows_before, hash_before = [*partition_by, *columns], 0, 0
    for single, some in ((True, small), (False, large)):
        if not some:
            continue
        own, seen = rows.filter((F.col("bins") == 1) == single).select(*schema.names), Observation()
        if single:
            dealt = own.repartition(*partition_by)
        else:
            dealt = own.repartitionByRange(bins, *order, F.xxhash64(*schema.names))
        watched = dealt.sortWithinPartitions(*order).observe(seen, *_content(own))
        watched.write.mode("append").partitionBy(*partition_by).parquet(target)
        rows_before += seen.get["row_count"]
        hash_before += int(seen.get["content_hash"])
    stored = spark.read.schema(schema).parquet(target) if small or large else rows.limit(0)
    report = content_summary(stored.select(*schema.names)).select(
        F.lit(small + large).alias("partitions"),
        F.lit(rows_before).cast("long").alias("rows_before"),
        F.lit(str(hash_before)).alias("hash_before"),
        F.col("row_count").alias("rows_after"),
        F.col("content_hash").alias("hash_after"),
    )
    return report.withColumn("same_content", _agrees()), known


def swap_partitions(
    spark: SparkSession, path: str, replacement: str, kept_as: str, partition_by: Sequence[str], known: DataFrame
) -> None:
    """Put rewritten partitions in the place of the old ones, which are kept under another path. Only paths change.

    ``known`` are the partitions as they were when they were read. If a file has come or gone in one of them since, nothing
    is moved: a writer that does not wait for the rewrite loses no rows by it, but the rewrite is.
    """
    now = _by_partition(file_listing(spark, path, partition_by), partition_by).select(*partition_by, F.col("files_hash").alias("_now"))
    still = _same_keys(known, now, partition_by, "left")
    if still.filter(~F.col("files_hash").eqNullSafe(F.col("_now"))).count():
        raise RuntimeError(f"{path} was written to while it was rewritten")
    jvm = spark._jvm.org.apache.hadoop.fs
    root, new_root, kept_root = jvm.Path(path), jvm.Path(replacement), jvm.Path(kept_as)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(parent, depth: int) -> list[str]:
        """Relative names of the partitions, one a partition: they are folders, not files."""
        if not depth:
            return [""]
        found = [s.getPath() for s in system.listStatus(parent) if s.isDirectory() and "=" in s.getPath().getName()]
        return [f"{p.getName()}/{rest}".rstrip("/") for p in found for rest in folders(p, depth - 1)]

    moved: list[tuple[str, str]] = []

    def move(a: str, b: str) -> None:
        system.mkdirs(jvm.Path(b).getParent())
        if not system.rename(jvm.Path(a), jvm.Path(b)):
            for x, y in reversed(moved):
                system.rename(jvm.Path(y), jvm.Path(x))
            raise OSError(f"{a} could not be moved")
        moved.append((a, b))

    for name in folders(new_root, len(partition_by)):
        move(f"{root}/{name}", f"{kept_root}/{name}")
        move(f"{new_root}/{name}", f"{root}/{name}")


def swap(spark: SparkSession, path: str, replacement: str, kept_as: str) -> None:
    """Put a rewritten table in the place of the old one, which is kept under another path. Only paths change."""
    files = spark._jvm.org.apache.hadoop.fs
    old, new, kept = files.Path(path), files.Path(replacement), files.Path(kept_as)
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.rename(old, kept):
        raise OSError(f"{path} could not be moved")
    if not system.rename(new, old):
        system.rename(kept, old)
        raise OSError(f"{replacement} could not be moved")


def analyze_table(spark: SparkSession, table: str) -> None:
    """Refresh the planner's statistics of every column."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
