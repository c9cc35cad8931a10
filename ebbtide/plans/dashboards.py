"""Reporting views over the logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import MEASURES
from ebbtide.operators.metrics import latest_batch


def flows_by_product(predictions: DataFrame, measure: str) -> DataFrame:
    """Actual and predicted sums of one measure per month and product, newest batch."""
    return (
        latest_batch(predictions)
        .groupBy("reporting_period", "product")
        .agg(
            F.sum(measure).cast("double").alias(f"{measure}_actual"),
            F.sum(f"{measure}_pred").cast("double").alias(f"{measure}_predicted"),
        )
        .orderBy("product", "reporting_period")
    )


def portfolio_total(predictions: DataFrame) -> DataFrame:
    """Actual and predicted sums of all measures per month, newest batch."""
    sums = []
    for m in MEASURES:
        sums.append(F.sum(m).cast("double").alias(f"portfolio_{m}_actual"))
        sums.append(F.sum(f"{m}_pred").cast("double").alias(f"portfolio_{m}_predicted"))
    return latest_batch(predictions).groupBy("reporting_period").agg(*sums).orderBy("reporting_period")


def quality_over_time(monitoring: DataFrame) -> DataFrame:
    return monitoring.select(
        "run_timestamp", "product", "mape_balance", "rmse_balance", "null_prediction_rate"
    ).orderBy(F.desc("run_timestamp"))


def mape_trend(monitoring: DataFrame) -> DataFrame:
    """Errors of every measure over time, runs with actuals only."""
    return (
        monitoring.filter("has_actuals")
        .select("run_timestamp", "product", *[f"mape_{m}" for m in MEASURES])
        .orderBy(F.desc("run_timestamp"), "product")
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.select("run_timestamp", "drift_type", "feature", "psi", "status").orderBy(
        F.desc("run_timestamp"), F.desc_nulls_last("psi")
    )


def checks_trend(quality: DataFrame) -> DataFrame:
    status = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    return quality.select("check_name", status.alias("check_status"), "validated_at", "detail").orderBy(
        F.desc("validated_at"), "check_name"
    )


def dataset_history(versions: DataFrame) -> DataFrame:
    return versions.select(
        "dataset_name", "source_table", "row_count", "content_hash", "recorded_at", "environment"
    ).orderBy(F.desc("recorded_at"), "dataset_name")


def ratio_heatmap(ratios: DataFrame, product: str) -> DataFrame:
    """Receipt ratio of one product by age and bin."""
    return (
        ratios.filter(F.col("product") == product)
        .select(F.col("months_since_start").alias("cohort_month"), "rate_bin", F.col("rec_pct").alias("receipt_pct"), "bin_id")
        .orderBy("cohort_month", "bin_id")
        .drop("bin_id")
    )
