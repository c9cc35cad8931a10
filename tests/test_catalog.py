"""Catalog tables over stored folders."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ebbtide.plans import maintenance
from ebbtide.schemas import PREDICTIONS, TABLES, TableNames, create_all, create_table_sql
from ebbtide.sources import catalog, readers
from ebbtide.sources.store import Store

TABLE = "inference_predictions"


def batch(spark, stamp, rows, first=0):
    own = spark.range(first, first + rows)
    return own.select(
        F.concat(F.lit("P"), F.col("id") % 3).alias("product"), F.lit("2000-01-01").cast("date").alias("cohort"),
        (F.col("id") % 60).cast("int").alias("months_since_start"), (F.col("id") * 1.5).alias("balance_pred"),
        F.lit(stamp).cast("timestamp").alias("scored_at"),
    )


@pytest.fixture
def store(spark, folder, request):
    names = TableNames("t_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower()))
    yield Store(spark, f"{folder}/store", names)
    spark.sql(f"DROP SCHEMA IF EXISTS {names.schema} CASCADE")


def same(a, b):
    assert a.columns == b.columns
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_names_see_every_write(spark, store):
    for k, stamp in enumerate(("2001-01-01 10:20:30", "2001-02-01 00:00:00", None)):
        store.append(batch(spark, stamp, 4, 10 * k), TABLE)
        same(store.named(TABLE), store.read(TABLE))
    assert store.named(TABLE).count() == 12
    newest = store.named(TABLE).filter(F.col("scored_at") == F.lit("2001-02-01").cast("timestamp"))
    plan = newest._jdf.queryExecution().toString()
    assert newest.count() == 4 and "PartitionFilters: [isnotnull(scored_at" in plan
    assert spark.sql(f"SHOW PARTITIONS {store.names[TABLE]}").count() == 3

    rows = spark.createDataFrame([("P", "m", "it's", 3, 0), ("P", "m", "2", 3, 0)], "product string, model_name string, model_version string, months_since_start int, bin_id int")
    store.replace(rows, "training_ratio_tables")
    store.replace(rows.withColumn("bin_id", F.lit(5)).filter("model_version = '2'"), "training_ratio_tables")
    same(store.named("training_ratio_tables"), store.read("training_ratio_tables"))
    assert sorted(r.bin_id for r in store.named("training_ratio_tables").collect()) == [0, 5]

    store.overwrite(batch(spark, "2001-09-01 00:00:00", 2), TABLE)
    same(store.named(TABLE), store.read(TABLE))
    store.append(spark.createDataFrame([("m", 1, "registered")], "model_name string, version int, event string"), "model_versions")
    same(store.named("model_versions"), store.read("model_versions"))
    store.append(batch(spark, "2001-10-01 00:00:00", 0), TABLE)
    same(store.named(TABLE), store.read(TABLE))


def test_a_name_over_files_that_were_there(spark, store):
    bare = Store(spark, store.root)
    bare.append(batch(spark, "2001-01-01 10:20:30", 5), TABLE)
    store.append(batch(spark, "2001-02-01 10:20:30", 5), TABLE)
    same(store.named(TABLE), bare.read(TABLE))
    spark.sql(f"DROP TABLE {store.names[TABLE]}")
    assert bare.read(TABLE).count() == 10  # the files stay
    with pytest.raises(ValueError, match="no names"):
        bare.named(TABLE)


def test_statistics_reach_the_planner(spark, store):
    for k in range(3):
        store.append(batch(spark, "2001-01-01 00:00:00", 300, 300 * k).coalesce(1), TABLE)
    store.append(batch(spark, "2001-02-01 00:00:00", 100).coalesce(1), TABLE)
    assert catalog.estimated_rows(store.named(TABLE)) is None
    report = maintenance.maintain_job(store).collect()
    assert [(r.table, r.swapped, r.partitions) for r in report] == [(TABLE, True, 1)]
    same(store.named(TABLE), store.read(TABLE))
    assert catalog.estimated_rows(store.named(TABLE)) == 1000
    known = catalog.column_statistics(spark, store.names[TABLE], "balance_pred")
    assert known["min"] == "0.0" and known["max"] == "1348.5" and known["histogram"] != "NULL"
    low = store.named(TABLE).filter("balance_pred < 135")  # a fifth by the histogram, a tenth by the extremes
    assert low.count() == 180 and 150 <= catalog.estimated_rows(low) <= 210
    text = low._sc._jvm.PythonSQLUtils.explainString(low._jdf.queryExecution(), "cost")
    assert "rowCount=" in text
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"


def test_created_tables_are_partitioned(spark, store, folder):
    made = create_all(spark, store.names, f"{folder}/made")
    assert len(made) == len(TABLES)
    spark.sql(f"INSERT INTO {store.names['model_versions']} VALUES ('m', 1, 'registered', NULL, 1.0)")
    assert readers.read_table(spark, store.names["model_versions"]).count() == 1
    assert Store(spark, f"{folder}/made").read("model_versions").first().event == "registered"
    assert "PARTITIONED BY (`scored_at`)" in create_table_sql("t", PREDICTIONS, partition_by=("scored_at",))
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {store.names[TABLE]}").collect()}
    assert described["Type"] == "EXTERNAL" and described["Location"].endswith(f"/made/{TABLE}")
    assert described["Partition Provider"] == "Catalog"
