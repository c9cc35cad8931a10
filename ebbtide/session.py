"""Spark session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SHARED: dict[str, str] = {}


def shuffle_partitions(input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Shuffle partitions to start from for an input of that size; adaptive execution merges the small ones."""
    return max(200, -(-input_bytes // partition_bytes))


#: Rows that one task may hold in a hash aggregate: some 100 MB for each aggregate of the task.
TASK_ROWS = 500_000


def row_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for an explicit ``repartition`` of that many rows, so that a task's share does not grow with them.

    Adaptive execution sizes partitions by their compressed bytes, of which narrow rows need few: 64 MB of them can be
    gigabytes in a hash aggregate. Below that size every core gets a share.
    """
    return max(1, -(-rows // TASK_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows * 10 // TASK_ROWS)))


def build_session(
    app_name: str = "ebbtide", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster, pass no master, and the size of the largest input: the default of 200 shuffle partitions would
    give each task far more than fits in memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.cbo.enabled": "true",  # only tables with statistics in the catalog are planned by it
        "spark.ui.enabled": "false",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets one temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can read and write")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="ebbtide-")
    return _LOCAL_SHARED[app]


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before, in a folder of this application's own: the whole folder can go when it has ended."""
    return f"{shared_folder(spark)}/ebbtide/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result has no lineage to recompute, so a lost executor costs one re-read and not the whole job, and its file
    size is known to the planner, which then decides on broadcasting by size.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
