"""Weekly rewrite of the stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.maintain import FILE_BYTES, analyze_table, compact, compact_partitions, swap, swap_partitions
from ebbtide.schemas import PARTITIONED_BY
from ebbtide.session import materialize
from ebbtide.sources.store import Store

# The columns each table is clustered by; tables without columns are only compacted.
CLUSTERING: dict[str, tuple[str, ...]] = {
    "inference_predictions": ("product", "scored_at"),
    "monitoring_metrics": ("product", "logged_at"),
    "drift_results": ("feature", "run_timestamp"),
    "cohort_matrix": ("product", "cohort", "reporting_period"),
    "feature_store_cohort": ("product", "cohort"),
    "training_feature_snapshots": ("snapshot_timestamp",),
    "dataset_versions": (),
    "model_approvals": (),
    "model_cards": (),
    "data_quality_results": (),
    "model_eval_metrics": (),
}
ANALYZED = ("cohort_matrix", "inference_predictions", "feature_store_cohort")


def rewrite_all(spark: SparkSession, paths: Mapping[str, str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite each table beside the old one, and put it in its place if the content is the same.

    Of a partitioned table, only the partitions with too many files are rewritten and swapped, folder by folder; the
    files of the others stay as they are. One row per table: how many partitions were rewritten (null for tables without),
    and where the old files are kept (remove them when nothing reads them any more), or, if the content differs,
    where the rewritten ones are. The number of files follows from each table's, or partition's, size.
    """
    report: DataFrame | None = None
    for table, path in paths.items():
        own, partition_by = path.rstrip("/"), PARTITIONED_BY.get(table, ())
        beside, kept = f"{own}.rewritten-{uuid.uuid4().hex}", f"{own}.before-{uuid.uuid4().hex}"
        # the partition columns are the same in all rows of a folder, so they cluster nothing there
        clustering = [c for c in CLUSTERING.get(table, ()) if c not in partition_by]
        if partition_by:
            row, known = compact_partitions(spark, own, beside, partition_by, clustering, file_bytes)
        else:
            row = compact(spark, own, beside, clustering, file_bytes=file_bytes)
            row = row.withColumn("partitions", F.lit(None).cast("long"))
        row = materialize(row, "compaction")
        found = row.first()
        same = found["same_content"]
        if same and not partition_by:
            swap(spark, own, beside, kept)
        elif same and found["partitions"]:
            swap_partitions(spark, own, beside, kept, partition_by, known)
        swapped = same and found["partitions"] != 0
        left_at = kept if swapped else None if same else beside
        row = row.select(F.lit(table).alias("table"), F.lit(swapped).alias("swapped"), F.lit(left_at).cast("string").alias("left_at"), "*")
        report = row if report is None else report.unionByName(row)
    if report is None:
        raise ValueError("no tables given")
    return report


def analyze_all(spark: SparkSession, names: Mapping[str, str]) -> None:
    """Refresh column statistics of the tables most queries read."""
    for table in ANALYZED:
        analyze_table(spark, names[table])


def maintain_job(store: Store, file_bytes: int = FILE_BYTES) -> DataFrame:
    """The weekly job: rewrite what has too many files, let the catalog see the new ones, refresh the statistics of the
    tables most queries read. Returns the report of ``rewrite_all``; tables that nothing has written are left out."""
    paths = {table: store.path(table) for table in CLUSTERING if store.exists(table)}
    report = rewrite_all(store.spark, paths, file_bytes)
    if store.names is not None:
        for table in paths:
            if store.spark.catalog.tableExists(store.names[table]):
                store.spark.catalog.refreshTable(store.names[table])
        for table in ANALYZED:
            if table in paths:
                store.analyze(table)
    return report
