"""The frames the registered queries start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.constants import FIRST_PROJECTED_AGE, RATE_LABELS
from ebbtide.functions.dates import month_text
from ebbtide.functions.ratios import rate_label
from ebbtide.operators import cohort
from ebbtide.operators.decide import PROMOTED, REGISTERED, REJECTED
from ebbtide.operators.ratio_tables import composites
from ebbtide.session import materialize
from ebbtide.sources import sample_views as views
from ebbtide.sources.sample_views import read_table

# Horizon of the ratio table that needs no fit, and the first month whose actuals have not landed.
GIVEN_HORIZON = 60
LANDED_UNTIL = "2001-08-01"

_STORED: dict[tuple[str, str, str], DataFrame] | None = None


def store_inputs(on: bool) -> None:
    """Whether the tables below are written once for all queries of an application, or by each query anew (the
    default). For timing the operators apart from what they start from; the sample tables must not change meanwhile."""
    global _STORED
    _STORED = {} if on else None


def _written(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    if _STORED is None:
        return materialize(make(), name)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = materialize(make(), name)
    return _STORED[key]


def accounts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account months, written once: the rates, the covered range and the matrix all read them."""
    return _written(spark, sf_dir, "account_month", lambda: views.account_month(spark, sf_dir))


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = accounts_table(spark, sf_dir)
    return cohort.cohort_matrix(accounts, views.best_buy(accounts))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.training_features(matrix(spark, sf_dir))


def features_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort features, written once for queries that read them several times."""
    return _written(spark, sf_dir, "features", lambda: features(spark, sf_dir))


def matrix_output(m: DataFrame) -> DataFrame:
    """Months as text, as exported tables hold them."""
    return m.withColumns({c: month_text(F.col(c)) for c in ("cohort", "reporting_period")})


def given_ratios(feats: DataFrame) -> DataFrame:
    """A ratio table that needs no fit: product means, bent by age and bin. Product means are scalars per product."""
    age, b = F.col("months_since_start"), F.col("bin_id")
    means = feats.groupBy("product").agg(
        F.round(F.avg("rec_prop"), 6).alias("rec_mean"),
        F.round(F.avg("outflow_prop"), 6).alias("out_mean"),
        F.round(F.avg("withdrawal_prop_of_outflow"), 6).alias("wd_mean"),
    )
    grid = means.withColumn(
        "months_since_start", F.explode(F.sequence(F.lit(FIRST_PROJECTED_AGE), F.lit(GIVEN_HORIZON)))
    ).withColumn("bin_id", F.explode(F.sequence(F.lit(0), F.lit(len(RATE_LABELS) - 1))))
    predicted = grid.select(
        "product", "months_since_start", "bin_id",
        (F.col("rec_mean") * 0.5 * (b * 0.01 + 1) / (age * 0.002 + 1)).alias("rec_pred"),
        (F.col("out_mean") * (1 - b * 0.01)).alias("outflow_pred"),
        (F.col("wd_mean") / (age * 0.002 + 1)).alias("wd_pred"),
    )
    return composites(predicted).withColumn("rate_bin", rate_label(b))


def predictions(feats: DataFrame) -> DataFrame:
    """Three scored batches that need no fit. Amounts are DECIMAL, so their sums are exact.

    Each batch predicts a fixed share of the lag; the actuals of the last months have not landed when it is scored.
    """
    batch = F.col("batch")

    def money(name: str):
        return F.col(name).cast("decimal(20,4)")

    landed = F.col("reporting_period") < F.lit(LANDED_UNTIL).cast("date")
    rows = feats.withColumn("batch", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return rows.select(
        "product", "cohort", "reporting_period", "months_since_start",
        F.when(landed, money("balance")).alias("balance"),
        *[F.when(landed, money(m)).alias(m) for m in ("receipts", "withdrawals", "transfers")],
        (F.col("balance_lag_1") * (batch * 0.01 + 0.95)).cast("decimal(20,4)").alias("balance_pred"),
        (money("receipts") + batch * 10).alias("receipts_pred"),
        (money("withdrawals") + batch * 5).alias("withdrawals_pred"),
        (money("transfers") - batch).alias("transfers_pred"),
        (F.col("rec_prop") * (batch * 0.05 + 0.9)).alias("rec_pct_pred"),
        (F.col("outflow_prop") * (batch * 0.05 + 0.9)).alias("outflow_pct_pred"),
        (1 - F.col("withdrawal_prop_of_outflow")).alias("transfer_pct_pred"),
        F.timestamp_add("DAY", batch, F.lit("2024-01-01").cast("timestamp")).alias("scored_at"),
        batch.cast("string").alias("model_version"),
    )


def version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model version log from the event stream: model = user, version = event. Every event registers a version with
    its value as the error; a purchase promotes it a minute later, an error turns it down."""
    events = read_table(spark, sf_dir, "events")
    outcome = F.when(F.col("event_type") == "purchase", PROMOTED).when(F.col("event_type") == "error", REJECTED)
    kinds = F.array(F.struct(F.lit(REGISTERED).alias("event"), F.lit(0).alias("m")), F.struct(outcome.alias("event"), F.lit(1).alias("m")))
    return (
        events.select("*", F.explode(kinds).alias("_k"))
        .filter(F.col("_k.event").isNotNull())
        .select(
            F.col("user_id").alias("model_name"),
            F.col("event_id").alias("version"),
            "_k.event",
            F.timestamp_add("MINUTE", F.col("_k.m"), F.col("ts")).alias("event_ts"),
            F.col("value").alias("metric"),
        )
    )
