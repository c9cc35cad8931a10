"""Profiles, manifests, compaction, logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators import maintain, profile
from ebbtide.plans import dashboards
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.schemas import RATIO_TABLES
from ebbtide.session import materialize, new_table_path
from ebbtide.sources import catalog, readers, writers
from ebbtide.sources.sample_views import read_table

PROFILED = ("value", "user_id")
STAMP = "2024-01-31 00:00:00"
TABLES = ("customer", "orders", "lineitem", "events", "part", "supplier")
_ROUNDED = ("null_rate", "mean", "deviation", "p25", "p50", "p75")


def _profiled(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in _ROUNDED})


def _by_window(granularity: str):
    def query(spark, sf_dir):
        events = read_table(spark, sf_dir, "events")
        return _profiled(profile.profile(events, PROFILED, ["event_type"], "ts", granularity))

    return query


def table_profiles(spark, sf_dir):
    """The events' profiles by day, week and month and as a whole, from one plan."""
    return _profiled(profile.profiles(read_table(spark, sf_dir, "events"), PROFILED, ["event_type"], "ts"))


def table_snapshot(spark, sf_dir):
    return _profiled(profile.profile(read_table(spark, sf_dir, "events"), PROFILED, ["event_type"]))


def feature_snapshot_profile(spark, sf_dir):
    """Snapshot profile of the feature table by product."""
    feats = inputs.features_table(spark, sf_dir)
    return _profiled(profile.profile(feats, ["balance_lag_1", "n_accounts", "months_since_start"], ["product"]))


def _manifests(spark, sf_dir):
    parts = [maintain.manifest(read_table(spark, sf_dir, t), t, f"{t}.parquet", "test", STAMP) for t in TABLES]
    return reduce(DataFrame.unionByName, parts)


def dataset_manifest(spark, sf_dir):
    """Manifests; of the schema, the names of the columns."""
    names = F.from_json("schema_json", "struct<fields: array<struct<name: string>>>")["fields"]["name"]
    return (
        _manifests(spark, sf_dir)
        .withColumn("recorded_at", F.date_format("recorded_at", "yyyy-MM-dd"))
        .withColumn("column_names", F.array_join(names, ","))
        .drop("schema_json")
    )


def dataset_versions(spark, sf_dir):
    return _manifests(spark, sf_dir).select(
        "dataset_name", "source_table", "row_count", "n_columns", "environment",
        F.date_format("recorded_at", "yyyy-MM-dd").alias("recorded_at"),
    )


def manifest_of_growing_log(spark, sf_dir):
    """The manifest of an event log after a new partition was appended: only that one is hashed, the sum is the log's."""
    events = read_table(spark, sf_dir, "events")
    path = new_table_path(spark, "growing")
    late = F.col("event_type") == "purchase"
    writers.append(events.filter(~late), path, partition_by=["event_type"])
    known = materialize(maintain.partition_contents(spark, path, events.schema, ["event_type"]), "contents")
    writers.append(events.filter(late), path, partition_by=["event_type"])
    parts = materialize(maintain.partition_contents(spark, path, events.schema, ["event_type"], known), "contents")
    row = maintain.manifest_of_parts(parts, events.schema, "events", "events.parquet", "test", STAMP)
    read = parts.agg(F.count_if("read").alias("n_read"))
    return row.select("dataset_name", "row_count", "n_columns", "content_hash").withColumn("n_read", read.scalar())


def dash_dataset_history(spark, sf_dir):
    history = dashboards.dataset_history(_manifests(spark, sf_dir)).drop("content_hash")
    return history.withColumn("recorded_at", F.date_format("recorded_at", "yyyy-MM-dd"))


def compact_table(spark, sf_dir):
    """Order lines rewritten by part and ship date; the content must not change."""
    target = new_table_path(spark, "compacted")
    row = maintain.compact(spark, f"{sf_dir}/lineitem.parquet", target, ["l_partkey", "l_shipdate"])
    return row.select("rows_before", "rows_after", "same_content")


def compact_log(spark, sf_dir):
    """Events appended in three batches to a log partitioned by type, whose partitions are then rewritten; a fourth batch
    comes after. All rows are read, from folders that are still those of the types."""
    events = read_table(spark, sf_dir, "events").select("event_id", "value", "event_type", (F.col("event_id") % 4).alias("batch"))
    path, rewritten = new_table_path(spark, "event_log"), new_table_path(spark, "event_log_rewritten")

    def append(k):
        writers.append(events.filter(F.col("batch") == k).drop("batch").coalesce(2), path, partition_by=["event_type"])

    def files():
        listed = maintain.file_listing(spark, path, ["event_type"])
        return listed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_files"))

    for k in range(3):
        append(k)
    before = materialize(files().withColumnRenamed("n_files", "n_before"), "files")
    report, known = maintain.compact_partitions(spark, path, rewritten, ["event_type"], ["event_id"])
    same = report.first()["same_content"]
    if same:
        maintain.swap_partitions(spark, path, rewritten, f"{path}.before", ["event_type"], known)
    after = materialize(files(), "files")
    append(3)
    rows = spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("value").cast("decimal(20,6)")).cast("double").alias("value")
    )
    fewer = (F.col("n_files") < F.col("n_before")) & F.lit(same)
    return rows.join(before, "event_type").join(after, "event_type").select("event_type", "n_rows", "value", fewer.alias("rewritten"))


def catalog_log(spark, sf_dir):
    """Orders appended by priority to an external table of the catalog, analysed, and one status read by its name; the
    planner knows the table's rows before it reads any."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    path = new_table_path(spark, "orders_log")
    name = "orders_" + path[-32:]
    schema = T.StructType([f for f in orders.schema if f.name != "o_orderstatus"] + [orders.schema["o_orderstatus"]])
    catalog.create_external(spark, name, schema, path, ["o_orderstatus"])
    for part in (F.col("o_orderpriority") < "3", F.col("o_orderpriority") >= "3"):
        rows, seen = catalog.written_partitions(orders.filter(part).select(*schema.names), ["o_orderstatus"])
        writers.append(rows, path, partition_by=["o_orderstatus"])
        catalog.add_partitions(spark, name, ["o_orderstatus"], seen.get["partitions"])
    catalog.analyze(spark, name)
    known = int(catalog.table_rows(spark, name) or -1)
    chosen = readers.read_table(spark, name).filter(F.col("o_orderstatus") == "F")
    return chosen.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double").alias("total"),
        F.lit(known).cast("long").alias("known_rows"),
    )


def log_evolution(spark, sf_dir):
    """Two appends to one log, the second with a column more; both read back whole."""
    path = new_table_path(spark, "log")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.append(orders.drop("o_orderstatus").filter(F.col("o_totalprice") < 250_000), path)
    writers.append(orders.filter(F.col("o_totalprice") >= 250_000), path)
    return readers.require_rows(writers.read_log(spark, path), "log")


def feature_snapshots(spark, sf_dir):
    """The training features frozen by two runs."""
    feats = inputs.features_table(spark, sf_dir)
    path = new_table_path(spark, "snapshots")
    for stamp in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"):
        writers.append_snapshot(feats, path, stamp, "test", "cohorts")
    frozen = spark.read.parquet(path)
    return frozen.groupBy(F.date_format("snapshot_timestamp", "yyyy-MM-dd").alias("snapshot"), "catalog", "product").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("balance").cast("decimal(20,2)")).cast("double").alias("balance")
    )


def ratio_store(spark, sf_dir):
    """Two versions appended to the ratio table store; the tables of the newer one read back by its version."""
    table = inputs.given_ratios(inputs.features_table(spark, sf_dir))
    path = new_table_path(spark, "ratio_store")
    for version in ("1", "2"):
        writers.append(table.withColumn("model_version", F.lit(version)), path, RATIO_TABLES, ["model_version"])
    stored = spark.read.schema(RATIO_TABLES).parquet(path).drop("model_name")
    return stored.filter(F.col("model_version") == stored.agg(F.max("model_version")).scalar())


def csv_export(spark, sf_dir):
    """Customers exported as CSV and read back with a schema."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    path = new_table_path(spark, "csv")
    writers.export_csv(customers, path)
    return readers.read_csv(spark, path, customers.schema)


def csv_rejects(spark, sf_dir):
    """Customers exported as text, some with a word for a balance or a cell too many; read with a schema, every line is
    either loaded or kept as a reject."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    key = F.col("c_custkey")
    balance = F.when(key % 7 == 0, "none").otherwise(F.col("c_acctbal").cast("string"))
    text = customers.select("c_custkey", "c_mktsegment", F.concat(balance, F.when(key % 11 == 0, ";1").otherwise("")).alias("c_acctbal"))
    path = new_table_path(spark, "csv_lines")
    lines = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_mktsegment", F.regexp_replace("c_acctbal", ";", ","))
    text.select(lines.alias("value")).write.text(path)
    good, rejects = readers.read_csv_checked(spark, path, customers.schema, header=False)
    loaded = good.select("c_mktsegment", F.col("c_acctbal").cast("decimal(20,2)").alias("balance"), F.lit(0).alias("rejected"))
    kept = rejects.select(F.split("line", ",")[1].alias("c_mktsegment"), F.lit(None).cast("decimal(20,2)").alias("balance"), F.lit(1).alias("rejected"))
    return loaded.union(kept).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("rejected").alias("n_rejected"), F.sum("balance").cast("double").alias("balance")
    )


QUERIES = {f"table_profile_{g}": _by_window(g) for g in ("day", "week", "month")}
QUERIES.update(
    {
        f.__name__: f
        for f in (
            table_profiles, table_snapshot, feature_snapshot_profile, dataset_manifest, manifest_of_growing_log, dataset_versions, dash_dataset_history, compact_table, compact_log, catalog_log, log_evolution,
            feature_snapshots, ratio_store, csv_export, csv_rejects,
        )
    }
)


def _profile_sql(source: str, columns, keys: str) -> str:
    parts = [
        f"""SELECT {keys}, '{c}' AS column_name, count(*) AS n_rows,
  round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, CAST(min({c}) AS DOUBLE) AS minimum,
  CAST(max({c}) AS DOUBLE) AS maximum, round(CAST(sum(CAST({c} AS DECIMAL(28,6))) AS DOUBLE) / count({c}), 6) AS mean, round(stddev_samp({c}), 6) AS deviation,
  count(DISTINCT {c}) AS n_distinct, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25,
  round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75
FROM {source} GROUP BY ALL"""
        for c in columns
    ]
    return "\nUNION ALL ".join(parts)


# The columns of the sample tables; f: a fraction, t: a time.
_COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal:f c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice:f o_orderdate:t o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:f l_extendedprice:f l_discount:f l_tax:f "
    "l_returnflag l_linestatus l_shipdate:t",
    "events": "event_id ts:t user_id event_type value:f props",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:f",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal:f",
}
_RENDERED = {
    "": "CAST({c} AS VARCHAR)",
    "f": "CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
}


def _manifest_sql(table: str) -> str:
    columns = [c.partition(":")[::2] for c in _COLUMNS[table].split()]
    shown = [f"coalesce({_RENDERED[kind].format(c=c)}, '~')" for c, kind in columns]
    row = " || ".join(f"length({x}) || ':' || {x}" for x in shown)
    digits = f"CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT)"
    return f"""SELECT '{table}' AS dataset_name, '{table}.parquet' AS source_table, count(*) AS row_count,
  {len(columns)} AS n_columns, CAST(coalesce(sum({digits}), 0) AS VARCHAR) AS content_hash, 'test' AS environment,
  '2024-01-31' AS recorded_at, '{",".join(c for c, _ in columns)}' AS column_names FROM {table}"""


_WIDTHS = {"customer": 5, "orders": 6, "lineitem": 11, "events": 6, "part": 6, "supplier": 4}

SQL = {
    f"table_profile_{g}": _profile_sql("events", PROFILED, f"date_trunc('{g}', ts)::DATE AS window_start, event_type")
    for g in ("day", "week", "month")
}
SQL.update(
    {
        "table_profiles": "\nUNION ALL ".join(
            f"SELECT '{g}' AS granularity, * FROM ({_profile_sql('events', PROFILED, f'{start} AS window_start, event_type')})"
            for g, start in [*((g, f"date_trunc('{g}', ts)::DATE") for g in profile.WINDOWS), ("total", "NULL::DATE")]
        ),
        "table_snapshot": _profile_sql("events", PROFILED, "event_type"),
        "feature_snapshot_profile": sql.with_ctes(
            sql.FEATURE_CTES, _profile_sql("features", ["balance_lag_1", "n_accounts", "months_since_start"], "product")
        ),
        "dataset_manifest": " UNION ALL ".join(_manifest_sql(t) for t in TABLES),
        "manifest_of_growing_log": f"SELECT dataset_name, row_count, n_columns, content_hash, 1 AS n_read FROM ({_manifest_sql('events')})",
        "dataset_versions": " UNION ALL ".join(
            f"""SELECT '{t}' AS dataset_name, '{t}.parquet' AS source_table, count(*) AS row_count, {n} AS n_columns,
  'test' AS environment, '2024-01-31' AS recorded_at FROM {t}"""
            for t, n in _WIDTHS.items()
        ),
        "dash_dataset_history": " UNION ALL ".join(
            f"""SELECT '{t}' AS dataset_name, '{t}.parquet' AS source_table, count(*) AS row_count,
  'test' AS environment, '2024-01-31' AS recorded_at FROM {t}"""
            for t in TABLES
        ),
        "compact_table": "SELECT count(*) AS rows_before, count(*) AS rows_after, true AS same_content FROM lineitem",
        "compact_log": """SELECT event_type, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(20,6))) AS DOUBLE) AS value,
  true AS rewritten FROM events GROUP BY 1""",
        "catalog_log": """SELECT o_orderpriority, count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS total,
  (SELECT count(*) FROM orders) AS known_rows FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
        "log_evolution": """SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice >= 250000 THEN o_orderstatus END AS o_orderstatus
FROM orders""",
        "feature_snapshots": sql.with_ctes(
            sql.FEATURE_CTES,
            """SELECT snapshot, 'test' AS catalog, product, count(*) AS n_rows,
  CAST(sum(CAST(balance AS DECIMAL(20,2))) AS DOUBLE) AS balance
FROM features CROSS JOIN (VALUES ('2024-01-01'), ('2024-02-01')) v(snapshot) GROUP BY ALL""",
        ),
        "ratio_store": sql.with_ctes(
            sql.FEATURE_CTES + sql.GIVEN_RATIO_CTES, "SELECT *, '2' AS model_version FROM given"
        ),
        "csv_rejects": """SELECT c_mktsegment, count(*) AS n_lines, count_if(c_custkey % 7 = 0 OR c_custkey % 11 = 0) AS n_rejected,
  CAST(sum(CAST(c_acctbal AS DECIMAL(20,2))) FILTER (c_custkey % 7 <> 0 AND c_custkey % 11 <> 0) AS DOUBLE) AS balance
FROM customer GROUP BY 1""",
        "csv_export": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
    }
)
