"""Typed schemas of every stored table, and their names.

Months are DATE (first of the month), stamps are TIMESTAMP, flags are BOOLEAN, lists are arrays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    """Schema from ``name type`` pairs; a trailing ``!`` on the type forbids nulls."""
    kinds = {
        "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
        "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
        "strings": T.ArrayType(T.StringType()), "flags": T.MapType(T.StringType(), T.BooleanType()),
        "doubles": T.ArrayType(T.DoubleType()), "bigints": T.ArrayType(T.LongType()),
    }
    fields = []
    for pair in ddl.split(","):
        name, kind = pair.split()
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


_KEY = "cohort date!, product string!, months_since_start int!, reporting_period date"
_FLOWS = "balance double, withdrawals double, receipts double, transfers double"
_RATES = "int_rate double, best_buy double, delta_to_best_buy double, bin_id int, dbb_range string"
_SHARES = "rec_prop double, outflow_prop double, withdrawal_prop_of_outflow double"
_SIZE = "tenure_months double, n_accounts bigint"
_WHERE = "catalog string, schema string"

ACCOUNTS = _schema(
    "account_id string, opening_date date, reporting_period date, product_code string, period_balance double, "
    "withdrawal double, receipt double, internal_transfer double, interest_rate double, tenure_months int"
)
RATES = _schema("period date, mapping_category string, num_products int, best_buy double")
PRODUCTS = _schema("product_code string, category string")
COHORT_MATRIX = _schema(f"{_KEY}, {_FLOWS}, {_RATES}, {_SIZE}, balance_lag_1 double, {_SHARES}")
COHORT_FEATURES = COHORT_MATRIX
SCORING_FEATURES = _schema(f"{_KEY}, balance double, balance_lag_1 double, {_RATES}, {_SIZE}")
PREDICTIONS = _schema(
    "product string, cohort date, reporting_period date, months_since_start int, balance_pred double, "
    "receipts_pred double, withdrawals_pred double, transfers_pred double, balance double, receipts double, "
    "withdrawals double, transfers double, ape_balance double, ape_receipts double, ape_withdrawals double, "
    "ape_transfers double, rec_pct_pred double, outflow_pct_pred double, transfer_pct_pred double, "
    "scored_at timestamp, model_name string, model_version string, model_alias string"
)
EVAL_METRICS = _schema(
    "product string, evaluated_at timestamp, mape_balance double, rmse_balance double, mape_receipts double, "
    "rmse_receipts double, mape_withdrawals double, rmse_withdrawals double, mape_transfers double, "
    "rmse_transfers double, baseline_mape double, improvement_vs_baseline_pct double, beats_baseline boolean"
)
MONITORING = _schema(
    "product string, run_timestamp timestamp, n_predictions bigint, null_prediction_rate double, has_actuals boolean, "
    "mape_balance double, mape_receipts double, mape_withdrawals double, mape_transfers double, rmse_balance double, "
    "logged_at timestamp"
)
DRIFT = _schema(
    "drift_type string, feature string, psi double, out_of_range_rate double, ref_min double, ref_max double, "
    "status string, run_timestamp timestamp"
)
QUALITY = _schema(
    "check_no int, check_name string, passed boolean, detail string, validated_at timestamp, stage string"
)
DATASET_VERSIONS = _schema(
    "dataset_name string, source_table string, row_count bigint, n_columns int, content_hash string, "
    "schema_json string, environment string, recorded_at timestamp"
)
SNAPSHOTS = _schema(f"{_KEY}, {_FLOWS}, {_RATES}, {_SIZE}, balance_lag_1 double, snapshot_timestamp timestamp, {_WHERE}")
APPROVALS = _schema(
    "request_id string, decision_id bigint, model_name string, model_version string, validation_passed boolean, "
    "approver string, approval_status string, approval_ts timestamp, challenger_mape double, champion_mape double, "
    f"checks_passed flags, rejection_reason string, {_WHERE}"
)
MODEL_CARDS = _schema(
    "model_name string, model_version string, run_id string, alias string, cutoff_period date, trained_at timestamp, "
    "n_products int, portfolio_mape double, features strings, labels strings, framework string, "
    f"promoted boolean, promotion_reason string, card_generated_at timestamp, {_WHERE}"
)
BASELINES = _schema(
    "int_rate double, best_buy double, delta_to_best_buy double, tenure_months double, n_accounts bigint, "
    "model_version string, baseline_frozen_at timestamp"
)
PREDICTION_BASELINES = _schema(
    "balance_pred double, rec_pct_pred double, outflow_pct_pred double, transfer_pct_pred double, "
    "model_version string, baseline_frozen_at timestamp"
)
VERSION_LOG = _schema("model_name string, version int, event string, event_ts timestamp, metric double")
RATIO_TABLES = _schema(
    "product string, model_name string, model_version string, months_since_start int, bin_id int, rate_bin string, "
    "rec_pct double, outflow_pct double, transfer_pct double"
)

HISTOGRAMS = _schema(
    "feature string, edges doubles, counts bigints, low double, high double, n bigint, model_name string, "
    "model_version string, baseline_frozen_at timestamp"
)

TABLES: dict[str, T.StructType] = {
    "raw_base_data": ACCOUNTS,
    "raw_best_buy": RATES,
    "raw_products": PRODUCTS,
    "cohort_matrix": COHORT_MATRIX,
    "feature_store_cohort": COHORT_FEATURES,
    "inference_features": SCORING_FEATURES,
    "inference_predictions": PREDICTIONS,
    "model_eval_metrics": EVAL_METRICS,
    "monitoring_metrics": MONITORING,
    "drift_results": DRIFT,
    "data_quality_results": QUALITY,
    "dataset_versions": DATASET_VERSIONS,
    "training_feature_snapshots": SNAPSHOTS,
    "model_approvals": APPROVALS,
    "model_cards": MODEL_CARDS,
    "reference_feature_snapshot": BASELINES,
    "reference_prediction_snapshot": PREDICTION_BASELINES,
    "model_versions": VERSION_LOG,
    "training_ratio_tables": RATIO_TABLES,
}

#: What the stages of a run report, and tables that only save reading others again.
DERIVED: dict[str, T.StructType] = {
    "ingest_rejects": _schema("source string, line string, parsed string, reason string, loaded_at timestamp"),
    "run_log": _schema("run_id string, entry_id bigint, key string, value string, logged_at timestamp"),
    "reference_feature_histogram": HISTOGRAMS,
    "reference_prediction_histogram": HISTOGRAMS,
}

#: Logs are partitioned by run and tables by version, so that the newest batch does not cost the whole history; keyed
#: tables by a month that the key determines, so that an upsert rewrites the months it touches.
PARTITIONED_BY: dict[str, tuple[str, ...]] = {
    "feature_store_cohort": ("reporting_period",),
    "inference_features": ("reporting_period",),
    "inference_predictions": ("scored_at",),
    "model_eval_metrics": ("evaluated_at",),
    "monitoring_metrics": ("logged_at",),
    "training_feature_snapshots": ("snapshot_timestamp",),
    "reference_feature_snapshot": ("model_version",),
    "reference_prediction_snapshot": ("model_version",),
    "training_ratio_tables": ("model_name", "model_version"),
    "reference_feature_histogram": ("model_name", "model_version"),
    "reference_prediction_histogram": ("model_name", "model_version"),
}


def table_schema(table: str) -> T.StructType:
    """The schema of a stored table; a KeyError for any other name."""
    return TABLES[table] if table in TABLES else DERIVED[table]


@dataclass(frozen=True)
class TableNames:
    """Full names of the tables of one schema (and catalog, where the session has several)."""

    schema: str
    catalog: str | None = None

    def __getitem__(self, table: str) -> str:
        table_schema(table)
        return ".".join(p for p in (self.catalog, self.schema, table) if p)


def create_table_sql(
    name: str, schema: T.StructType, fmt: str = "parquet", partition_by: Sequence[str] = (), location: str | None = None
) -> str:
    """A table unless it is there; with a location, over files that stay when it is dropped."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    where = " LOCATION '{}'".format(location.replace("'", "\\'")) if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{parts}{where}"


def create_all(spark: SparkSession, names: TableNames, root: str | None = None) -> list[str]:
    """Create every missing table, partitioned; over the folders below ``root``, if one is given. Returns the full names."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {names.schema}")
    created = []
    for table, schema in TABLES.items():
        location = f"{root.rstrip('/')}/{table}" if root else None
        spark.sql(create_table_sql(names[table], schema, partition_by=PARTITIONED_BY.get(table, ()), location=location))
        created.append(names[table])
    return created


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order and type; columns the frame lacks become null, unless they forbid nulls."""
    columns = []
    for f in schema.fields:
        if f.name in df.columns:
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.nullable:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name} is missing")
    return df.select(*columns)
