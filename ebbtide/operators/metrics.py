"""Evaluation, baseline, selection and monitoring metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import MEASURES
from ebbtide.functions.errors import ape, mape, rmse, zero_actuals

SIDES = tuple(name for m in MEASURES for name in (m, f"{m}_pred"))


def portfolio_flows(projected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Actual and predicted sums of the four measures; missing values count as 0, and are counted."""
    sums = [F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(c) for c in SIDES]
    missing = F.count_if(F.col("balance_pred").isNull()).alias("n_missing_pred")
    return projected.groupBy(*keys).agg(*sums, missing)


def error_metrics(flows: DataFrame, keys: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """MAPE (percent, zero actuals left out and counted) and RMSE of each measure."""
    columns: list[Column] = []
    for m in measures:
        actual, predicted = F.col(m), F.col(f"{m}_pred")
        columns += [mape(actual, predicted).alias(f"mape_{m}"), rmse(actual, predicted).alias(f"rmse_{m}")]
    columns.append(zero_actuals(F.col("balance"), F.col("balance_pred")).alias("n_zero_actual"))
    return flows.groupBy(*keys).agg(*columns)


def naive_baseline(matrix: DataFrame, is_train: Column, keys: Sequence[str] = ("product",)) -> DataFrame:
    """MAPE of predicting last month's balance: over all rows, and over the training rows only."""
    miss = ape(F.col("balance"), F.col("balance_lag_1"))
    return matrix.groupBy(*keys).agg(
        (F.avg(miss) * 100).alias("baseline_all"), (F.avg(F.when(is_train, miss)) * 100).alias("baseline_train")
    )


def against_baseline(metrics: DataFrame, baseline: DataFrame, column: str = "baseline_train") -> DataFrame:
    """Relative improvement over the naive forecast in percent, and whether it is beaten."""
    known = F.col("baseline_mape").isNotNull() & (F.col("baseline_mape") != 0) & F.col("mape_balance").isNotNull()
    gain = F.try_divide(F.col("baseline_mape") - F.col("mape_balance"), F.col("baseline_mape")) * 100
    named = baseline.select("product", F.col(column).alias("baseline_mape"))
    return (
        metrics.join(named, "product", "left")
        .withColumn("improvement_vs_baseline_pct", F.when(known, gain))
        .withColumn("beats_baseline", F.when(known, F.col("mape_balance") < F.col("baseline_mape")))
    )


def portfolio_summary(evaluated: DataFrame) -> DataFrame:
    """Unweighted means over products and the share of products that beat the baseline."""
    beating = F.count_if(F.coalesce("beats_baseline", F.lit(False)))
    return evaluated.agg(
        F.avg("mape_balance").alias("portfolio_mape"),
        F.avg("rmse_balance").alias("portfolio_rmse"),
        F.count("*").alias("n_products_evaluated"),
        beating.alias("products_beating_baseline"),
        (F.try_divide(beating, F.count("*")) * 100).alias("baseline_coverage_pct"),
    )


def best_configuration(trials: DataFrame, select_by: str = "val_mape") -> DataFrame:
    """The trial with the lowest error per product; the earlier configuration wins ties, a missing error never wins.

    ``select_by`` may name the fold mean (``cv_mape``) instead.
    """
    rest = [c for c in trials.columns if c != "product"]
    usable = trials.filter(F.col(select_by).isNotNull() & ~F.isnan(F.col(select_by).cast("double")))
    best = usable.groupBy("product").agg(F.min_by(F.struct(*rest), F.struct(select_by, "grid_id")).alias("_best"))
    return best.select("product", "_best.*")


def latest_batch(predictions: DataFrame, stamp: str = "scored_at") -> DataFrame:
    """Rows of the newest batch. The newest stamp is a scalar subquery, which also prunes partitions by it."""
    return predictions.filter(F.col(stamp) == predictions.agg(F.max(stamp)).scalar())


def with_later_actuals(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Prefer the actual balance that landed since over the one stored at scoring."""
    keys = ["cohort", "product", "reporting_period"]
    landed = actuals.select(*keys, F.col("balance").alias("_actual"))
    return (
        predictions.join(landed, keys, "left")
        .withColumn("balance", F.coalesce("_actual", "balance"))
        .drop("_actual")
    )


def monitoring_metrics(predictions: DataFrame, keys: Sequence[str] = ("product",)) -> DataFrame:
    """Per product: rows, share without a prediction, whether actuals are known, errors of every measure."""
    return predictions.groupBy(*keys).agg(
        F.count("*").alias("n_predictions"),
        F.avg(F.col("balance_pred").isNull().cast("double")).alias("null_prediction_rate"),
        F.bool_or(F.col("balance").isNotNull()).alias("has_actuals"),
        rmse(F.col("balance").cast("double"), F.col("balance_pred").cast("double")).alias("rmse_balance"),
        *[mape(F.col(m).cast("double"), F.col(f"{m}_pred").cast("double")).alias(f"mape_{m}") for m in MEASURES],
    )


def portfolio_rollup(monitoring: DataFrame) -> DataFrame:
    return monitoring.agg(
        F.avg("mape_balance").alias("portfolio_mape"),
        F.max("null_prediction_rate").alias("max_null_rate"),
        F.sum("n_predictions").alias("n_predictions"),
    )


def total_balances(projected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total projected and actual balance per key."""
    return projected.groupBy(*keys).agg(
        F.sum("balance_pred").cast("double").alias("total_balance_pred"),
        F.sum("balance").cast("double").alias("total_balance_actual"),
    )
