"""Scored batch -> monitoring, drift, quality -> retraining signal."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ebbtide.operators import decide, drift, metrics


def retraining_signals(drift_report: DataFrame, monitoring: DataFrame) -> DataFrame:
    """One row: worst null rate and mean error of the batch, and whether anything drifted."""
    detected = drift.alert_summary(drift_report).select("drift_detected").scalar()
    return metrics.portfolio_rollup(monitoring).withColumn("drift_detected", detected)


def retraining_decision(drift_report: DataFrame, monitoring: DataFrame) -> DataFrame:
    return decide.retraining_need(retraining_signals(drift_report, monitoring))
