from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.operators import maintain
from ebbtide.session import materialize, shared_folder
from ebbtide.sources import readers, writers

LINES = "/root/testdata/sf0.001/lineitem.parquet"


def test_rates_and_products_files(spark, folder):
    spark.createDataFrame([("2023-06", "HL", 0.03)], "period string, mapping_category string, best_buy double").coalesce(1).write.csv(
        f"{folder}/rates", header=True
    )
    row = readers.read_rates(spark, f"{folder}/rates").first()
    assert (row.period, row.mapping_category, row.best_buy) == (date(2023, 6, 1), "HL", 0.03)
    spark.createDataFrame([("P001", "HL ISA")], ["Product Code", "QRM Category"]).write.csv(f"{folder}/products", header=True)
    assert readers.read_products(spark, f"{folder}/products").first().asDict() == {"product_code": "P001", "category": "HL ISA"}


def test_raw_account_names(spark, folder):
    names = list(readers.RAW_ACCOUNT_NAMES)
    row = ("a", date(2023, 1, 5), "2023-02", "P", 1.0, 2.0, 3.0, 4.0, float("nan"), 2.0)
    spark.createDataFrame([row], names).write.parquet(f"{folder}/raw")
    got = readers.read_accounts(spark, f"{folder}/raw").first()
    assert got.reporting_period == date(2023, 2, 1) and got.interest_rate is None and got.receipt == 3.0


def test_upsert_table(spark, folder):
    path = f"{folder}/features"
    writers.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
    merged = writers.upsert_table(spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string"), path, ["k"])
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "a"), (2, "B"), (3, "C")]


def test_log_grows_columns(spark, folder):
    writers.append(spark.createDataFrame([(1,)], "a int"), f"{folder}/log")
    writers.append(spark.createDataFrame([(2, "x")], "a int, b string"), f"{folder}/log")
    assert sorted((r.a, r.b) for r in writers.read_log(spark, f"{folder}/log").collect()) == [(1, None), (2, "x")]


def test_overwrite_and_non_empty(spark, folder):
    df = spark.createDataFrame([(1,)], "a int")
    writers.overwrite(df, f"{folder}/t")
    writers.overwrite(df, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 1
    with pytest.raises(ValueError, match="nothing here"):
        readers.require_rows(df.limit(0), "nothing here: t")


def test_conform(spark):
    df = spark.createDataFrame([("f", "0.5", 1)], "feature string, psi string, other int")
    got = schemas.conform(df, schemas.DRIFT)
    assert got.schema.fieldNames() == schemas.DRIFT.fieldNames() and got.first().psi == 0.5
    with pytest.raises(ValueError):
        schemas.conform(df, schemas.COHORT_MATRIX)


def test_tables(spark):
    names = schemas.TableNames("ebbtide_test")
    created = schemas.create_all(spark, names)
    assert len(created) == len(schemas.TABLES) == 19 and schemas.create_all(spark, names) == created
    stored = spark.table(names["model_approvals"]).schema
    assert [f.dataType for f in stored.fields] == [f.dataType for f in schemas.APPROVALS.fields]
    maintain.analyze_table(spark, names["drift_results"])
    assert schemas.TableNames("s", "c")["drift_results"] == "c.s.drift_results"
    with pytest.raises(KeyError):
        names["unknown"]


def test_content_hash_ignores_order_and_sees_changes(spark):
    lines = spark.read.parquet(LINES)
    base = maintain.content_summary(lines).first()
    assert maintain.content_summary(lines.repartition(7).orderBy("l_partkey")).first() == base
    assert maintain.content_summary(lines.withColumn("l_tax", F.col("l_tax") + 1)).first().content_hash != base.content_hash
    assert maintain.content_summary(lines.limit(0)).first().content_hash == "0"


def test_compaction_keeps_content_and_splits_a_hot_value(spark, folder):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    hot.write.parquet(f"{folder}/hot")
    row = maintain.compact(spark, f"{folder}/hot", f"{folder}/compact", ["k"], files=6).first()
    assert row.same_content and row.rows_after == 3000
    sizes = spark.read.parquet(f"{folder}/compact").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) < 1000
    plain = maintain.compact(spark, f"{folder}/hot", f"{folder}/plain", files=2).first()
    assert plain.same_content


def test_materialize_goes_to_the_shared_folder(spark):
    df = materialize(spark.range(5), "numbers")
    assert df.count() == 5 and all(f.startswith(f"file:{shared_folder(spark)}") for f in (p.replace("file://", "file:") for p in df.inputFiles()))


def test_maintenance_reports_every_table(spark, folder):
    from ebbtide.plans import maintenance

    paths = {}
    for table in ("drift_results", "model_cards"):
        paths[table] = f"{folder}/{table}"
        spark.range(50).select(F.col("id").cast("string").alias("feature"), F.lit("t").alias("run_timestamp")).write.parquet(paths[table])
    report = maintenance.rewrite_all(spark, paths).collect()
    assert [r.table for r in report] == list(paths) and all(r.same_content and r.rows_after == 50 for r in report)
    assert all(r.swapped for r in report)
    # one file now, of the size that is aimed at, in the old place; the old ones are kept
    swapped = spark.read.parquet(paths["drift_results"])
    assert swapped.count() == 50 and len(swapped.inputFiles()) == 1
    assert spark.read.parquet(report[0].left_at).count() == 50
    with pytest.raises(ValueError):
        maintenance.rewrite_all(spark, {})


def test_an_upsert_leaves_untouched_partitions_alone(spark, folder):
    from ebbtide.sources import writers

    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, None, "x")], "k int, month string, v string")
    path = f"{folder}/keyed"
    writers.upsert_table(rows, path, ("k",), ("month",))
    before = {f for f in spark.read.parquet(path).inputFiles()}
    new = spark.createDataFrame([(2, "a", "new"), (5, "c", "new"), (4, None, "new")], "k int, month string, v string")
    merged = writers.upsert_table(new, path, ("k",), ("month",))
    assert merged.columns == rows.columns
    assert sorted((r.k, r.month or "", r.v) for r in merged.collect()) == [
        (1, "a", "x"), (2, "a", "new"), (3, "b", "x"), (4, "", "new"), (5, "c", "new"),
    ]
    after = {f for f in spark.read.parquet(path).inputFiles()}
    assert {f for f in before if "month=b" in f} == {f for f in after if "month=b" in f}
    assert not {f for f in before if "month=a" in f} & after


def test_logs_are_partitioned_by_run(spark, folder):
    from ebbtide.operators import metrics
    from ebbtide.sources.store import Store

    store = Store(spark, folder)
    for stamp in ("2001-01-01 00:00:00", "2001-02-01 10:20:30"):
        batch = spark.range(3).select(F.col("id").cast("string").alias("product"), F.lit(stamp).cast("timestamp").alias("scored_at"))
        store.append(batch.withColumns({c: F.lit(d).cast(t) for c, d, t in (("cohort", "2000-01-01", "date"), ("months_since_start", 3, "int"))}), "inference_predictions")
    log = store.read("inference_predictions")
    assert log.columns == schemas.PREDICTIONS.names
    newest = metrics.latest_batch(log)
    assert newest.count() == 3 and newest.first().scored_at.isoformat() == "2001-02-01T10:20:30"
    assert "PartitionFilters: [isnotnull(scored_at" in newest._jdf.queryExecution().toString()


def test_ingest_fills_the_raw_tables(spark, folder):
    from ebbtide.plans import jobs
    from ebbtide.sources.store import Store

    names = {v: k for k, v in readers.RAW_ACCOUNT_NAMES.items()}
    accounts = spark.range(4).select(
        F.col("id").cast("string").alias(names["account_id"]), F.lit("2020-01-05").alias(names["opening_date"]),
        F.lit("2020-02-01").alias(names["reporting_period"]), F.lit("P1").alias(names["product_code"]), F.lit(1.5).alias(names["period_balance"]),
    )
    accounts.write.parquet(f"{folder}/accounts")
    spark.createDataFrame([("2020-02", "A", 1.0)], readers.RAW_RATES).write.csv(f"{folder}/rates", header=True)
    store = Store(spark, f"{folder}/store")
    jobs.ingest_job(store, f"{folder}/accounts", f"{folder}/rates")
    assert store.read("raw_base_data").count() == 4 and store.read("raw_best_buy").first().best_buy == 1.0
    accounts.limit(0).write.parquet(f"{folder}/none")
    with pytest.raises(ValueError, match="no rows"):
        jobs.ingest_job(store, f"{folder}/none", f"{folder}/rates")
    assert store.read("raw_base_data").count() == 4


def _batch(spark, stamp, rows=3, first=0):
    batch = spark.range(first, first + rows).select(F.concat(F.lit("p"), F.col("id")).alias("product"), F.lit(stamp).cast("timestamp").alias("scored_at"))
    return batch.withColumns({"cohort": F.lit("2000-01-01").cast("date"), "months_since_start": F.lit(3), "balance_pred": F.rand(1)})


def test_a_rewritten_log_keeps_its_partitions(spark, folder):
    from ebbtide.plans import maintenance
    from ebbtide.sources.store import Store

    store, table = Store(spark, folder), "inference_predictions"
    for k in range(3):  # three files in one partition
        store.append(_batch(spark, "2001-01-01 10:20:30", first=3 * k).coalesce(1), table)
    store.append(_batch(spark, "2001-02-01 00:00:00").coalesce(1), table)
    null = _batch(spark, "2001-02-01 00:00:00", 2, 50).withColumn("scored_at", F.lit(None).cast("timestamp"))
    store.append(null.repartition(2), table)
    before = sorted(store.read(table).collect(), key=str)
    files = set(spark.read.parquet(store.path(table)).inputFiles())

    report = maintenance.rewrite_all(spark, {table: store.path(table)}).first()
    assert report.swapped and report.same_content and report.partitions == 2 and report.rows_before == 11
    assert sorted(store.read(table).collect(), key=str) == before
    now = set(spark.read.parquet(store.path(table)).inputFiles())
    assert all("scored_at=" in f for f in now) and len(now) == 3
    assert {f for f in files if "2001-02-01" in f} == {f for f in now if "2001-02-01" in f}
    assert len(spark.read.parquet(report.left_at).inputFiles()) == 5

    store.append(_batch(spark, "2001-03-01 00:00:00"), table)
    store.append(_batch(spark, "2001-01-01 10:20:30", 1, 90), table)
    assert store.read(table).count() == 18  # 14 before
    kept = set(spark.read.parquet(store.path(table)).inputFiles())
    again = maintenance.rewrite_all(spark, {table: store.path(table)}).first()
    assert again.partitions >= 1 and store.read(table).count() == 18
    third = maintenance.rewrite_all(spark, {table: store.path(table)}).first()
    assert third.partitions == 0 and not third.swapped and third.left_at is None and kept - now


def test_large_partitions_get_as_many_files_as_they_need(spark, folder):
    rows = spark.range(40_000).select((F.col("id") % 2).alias("month"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.rand(3).alias("v"))
    rows.filter("month = 0").repartition(12).write.partitionBy("month").parquet(f"{folder}/t")
    rows.filter("month = 1 AND id % 100 = 1".replace("id", "k")).coalesce(1).write.mode("append").partitionBy("month").parquet(f"{folder}/t")
    size = maintain.table_bytes(spark, f"{folder}/t")
    row, known = maintain.compact_partitions(spark, f"{folder}/t", f"{folder}/new", ["month"], ["k"], file_bytes=size // 4)
    assert row.first().same_content and row.first().partitions == 1 and known.first().month == "0"
    new = spark.read.parquet(f"{folder}/new")
    sizes = [r["count"] for r in new.groupBy(F.input_file_name()).count().collect()]
    assert 4 <= len(sizes) <= 6 and max(sizes) < 8000  # the hot value is in several
    ranges = sorted((r.low, r.high) for r in new.groupBy(F.input_file_name()).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_a_rewrite_gives_way_to_a_writer(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (2, "a")], "k int, month string")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").partitionBy("month").parquet(f"{folder}/t")
    _, known = maintain.compact_partitions(spark, f"{folder}/t", f"{folder}/new", ["month"])
    rows.coalesce(1).write.mode("append").partitionBy("month").parquet(f"{folder}/t")
    with pytest.raises(RuntimeError, match="written to"):
        maintain.swap_partitions(spark, f"{folder}/t", f"{folder}/new", f"{folder}/old", ["month"], known)
    assert spark.read.parquet(f"{folder}/t").count() == 6
    with pytest.raises(ValueError, match="not partitioned"):
        maintain.compact_partitions(spark, f"{folder}/t", f"{folder}/other", ["k2"])


def test_only_changed_partitions_are_hashed(spark, folder):
    path, by = f"{folder}/log", ["month"]
    rows = spark.range(40).select("id", (F.col("id") * 0.5).alias("v"), F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("month"))
    rows = rows.withColumn("month", F.when(F.col("id") % 4 < 3, F.col("month")))  # one partition is null
    schema = spark.createDataFrame([], "id long, v double, month date").schema

    def state(known=None):
        found = materialize(maintain.partition_contents(spark, path, schema, by, known), "contents")
        stored = spark.read.schema(schema).parquet(path).select(*schema.names)
        own = maintain.manifest_of_parts(found, schema, "d", "s", "e", "2001-01-01 00:00:00").first()
        assert own == maintain.manifest(stored, "d", "s", "e", "2001-01-01 00:00:00").first()
        return found, {r.month for r in found.filter("read").collect()}

    writers.append(rows.filter("id < 30"), path, partition_by=by)
    first, read = state()
    assert len(read) == 4 and None in read
    assert state(first)[1] == set()
    writers.append(rows.filter("id >= 30 AND id % 4 = 1"), path, partition_by=by)
    second, read = state(first)
    assert read == {"2001-01-02"}
    writers.upsert_table(rows.filter("id = 4").withColumn("v", F.lit(-1.0)), path, ["id"], by)
    third, read = state(second)
    assert read == {"2001-01-01"}
    writers.replace_partitions(rows.filter("month IS NULL").limit(2), path, by)
    assert state(third)[1] == {None}


def test_bad_lines_are_counted_and_kept(spark, folder):
    from ebbtide.plans import jobs
    from ebbtide.sources.store import Store

    lines = ["period,mapping_category,best_buy", "2020-02,A,1.5", "2020-03,B,much", "2020-04,C", "20x0-05,D,2.0", ",E,3.0", "2020-06,F,4.0,extra", "2020-07,G,NaN"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/rates")
    good, rejects = readers.read_rates_checked(spark, f"{folder}/rates")
    assert sorted((r.mapping_category, str(r.period), r.best_buy) for r in good.collect()) == [
        ("A", "2020-02-01", 1.5), ("E", "None", 3.0), ("G", "2020-07-01", None),
    ]
    found = {r.line: r.reason for r in rejects.collect()}
    assert {k for k, v in found.items() if v == "does not fit the schema"} == {"2020-03,B,much", "2020-04,C", "2020-06,F,4.0,extra"}
    assert [v for k, v in found.items() if "20x0-05" in k] == ["no value for period"] and len(found) == 4

    names = {v: k for k, v in readers.RAW_ACCOUNT_NAMES.items()}
    spark.range(2).select(
        F.col("id").cast("string").alias(names["account_id"]), F.lit("2020-01-05").alias(names["opening_date"]),
        F.lit("2020-02-01").alias(names["reporting_period"]), F.lit("P1").alias(names["product_code"]), F.lit(1.5).alias(names["period_balance"]),
    ).write.parquet(f"{folder}/accounts")
    store = Store(spark, f"{folder}/store")
    assert jobs.ingest_job(store, f"{folder}/accounts", f"{folder}/rates", now="2021-01-01 00:00:00") == 4
    assert store.read("raw_best_buy").count() == 3 and store.read("ingest_rejects").count() == 4
