"""Evaluation, baseline, selection, monitoring, dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.constants import MEASURES
from ebbtide.functions.dates import month_text
from ebbtide.operators import metrics as ops
from ebbtide.operators import project
from ebbtide.plans import dashboards
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.queries.modelling import CUTOFF, LAST_COHORT


def _flows(spark, sf_dir):
    """Monthly flows of the newest batch per product."""
    rows = ops.latest_batch(inputs.predictions(inputs.features_table(spark, sf_dir)))
    return ops.portfolio_flows(project.cohorts_until(rows, LAST_COHORT), ["product", "reporting_period"])


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


_ERRORS = [f"{kind}_{m}" for m in MEASURES for kind in ("mape", "rmse")]


def eval_metrics(spark, sf_dir):
    return _rounded(ops.error_metrics(_flows(spark, sf_dir), ["product"]), *_ERRORS)


def _baseline(feats):
    return ops.naive_baseline(feats, F.col("reporting_period") < F.lit(CUTOFF).cast("date"))


def naive_baseline(spark, sf_dir):
    return _rounded(_baseline(inputs.features(spark, sf_dir)), "baseline_all", "baseline_train")


def _judged(spark, sf_dir):
    feats = inputs.features_table(spark, sf_dir)
    rows = ops.latest_batch(inputs.predictions(feats))
    flows = ops.portfolio_flows(project.cohorts_until(rows, LAST_COHORT), ["product", "reporting_period"])
    return ops.against_baseline(ops.error_metrics(flows, ["product"]), _baseline(feats))


def beats_baseline(spark, sf_dir):
    judged = _judged(spark, sf_dir).select("product", "mape_balance", "baseline_mape", "improvement_vs_baseline_pct", "beats_baseline")
    return _rounded(judged, "mape_balance", "baseline_mape", "improvement_vs_baseline_pct")


def evaluation_summary(spark, sf_dir):
    row = ops.portfolio_summary(_judged(spark, sf_dir))
    return _rounded(row, "portfolio_mape", "portfolio_rmse", "baseline_coverage_pct")


def best_config(spark, sf_dir):
    """Batches as trials: the one with the lowest balance error per product, the earlier one on ties."""
    rows = inputs.predictions(inputs.features(spark, sf_dir))
    trials = rows.withColumn("grid_id", F.col("model_version").cast("int"))
    flows = ops.portfolio_flows(trials, ["product", "grid_id", "reporting_period"])
    scored = ops.error_metrics(flows, ["product", "grid_id"], ["balance"])
    trial = scored.select("product", "grid_id", F.round("mape_balance", 6).alias("val_mape"))
    return ops.best_configuration(trial)


def _latest(spark, sf_dir):
    return ops.latest_batch(inputs.predictions(inputs.features_table(spark, sf_dir)))


_MONITORED = ("null_prediction_rate", "rmse_balance", *[f"mape_{m}" for m in MEASURES])


def monitoring_metrics(spark, sf_dir):
    return _rounded(ops.monitoring_metrics(_latest(spark, sf_dir)), *_MONITORED)


def actuals_feedback(spark, sf_dir):
    """Balances that landed after scoring replace the missing ones; the newest month's never did."""
    feats = inputs.features_table(spark, sf_dir)
    latest = ops.latest_batch(inputs.predictions(feats))
    joined = ops.with_later_actuals(latest, feats.withColumn("balance", F.col("balance").cast("decimal(20,4)")))
    return _rounded(ops.monitoring_metrics(joined), *_MONITORED)


def portfolio_rollup(spark, sf_dir):
    row = ops.portfolio_rollup(ops.monitoring_metrics(_latest(spark, sf_dir)))
    return _rounded(row, "portfolio_mape", "max_null_rate")


def total_balances(spark, sf_dir):
    return ops.total_balances(inputs.predictions(inputs.features(spark, sf_dir)), ["model_version", "product"])


def product_coverage(spark, sf_dir):
    rows = inputs.predictions(inputs.features(spark, sf_dir))
    return rows.groupBy("model_version").agg(F.countDistinct("product").alias("n_products"), F.count("*").alias("n_rows"))


def _by_product(measure):
    def query(spark, sf_dir):
        rows = inputs.predictions(inputs.features_table(spark, sf_dir))
        return dashboards.flows_by_product(rows, measure).withColumn("reporting_period", month_text(F.col("reporting_period")))

    return query


def dash_portfolio_total(spark, sf_dir):
    rows = inputs.predictions(inputs.features_table(spark, sf_dir))
    return dashboards.portfolio_total(rows).withColumn("reporting_period", month_text(F.col("reporting_period")))


def _monitoring_log(spark, sf_dir):
    rows = inputs.predictions(inputs.features(spark, sf_dir))
    return ops.monitoring_metrics(rows, ["scored_at", "product"]).withColumnRenamed("scored_at", "run_timestamp")


def dash_mape_trend(spark, sf_dir):
    trend = dashboards.mape_trend(_monitoring_log(spark, sf_dir))
    return _rounded(trend, *[f"mape_{m}" for m in MEASURES]).withColumn("run_timestamp", F.date_format("run_timestamp", "yyyy-MM-dd"))


def dash_quality_over_time(spark, sf_dir):
    trend = dashboards.quality_over_time(_monitoring_log(spark, sf_dir))
    return _rounded(trend, "mape_balance", "rmse_balance", "null_prediction_rate").withColumn(
        "run_timestamp", F.date_format("run_timestamp", "yyyy-MM-dd")
    )


def dash_ratio_heatmap(spark, sf_dir):
    table = inputs.given_ratios(inputs.features(spark, sf_dir))
    return dashboards.ratio_heatmap(table, "BUILDING")


QUERIES = {
    f.__name__: f
    for f in (
        eval_metrics, naive_baseline, beats_baseline, evaluation_summary, best_config, monitoring_metrics,
        actuals_feedback, portfolio_rollup, total_balances, product_coverage, dash_portfolio_total, dash_mape_trend,
        dash_quality_over_time, dash_ratio_heatmap,
    )
}
QUERIES.update({f"dash_{m}_by_product": _by_product(m) for m in MEASURES})

_PRED = sql.FEATURE_CTES + sql.prediction_ctes(inputs.LANDED_UNTIL)
_LATEST = _PRED + ["latest AS (SELECT * FROM predictions WHERE scored_at = (SELECT max(scored_at) FROM predictions))"]
_SUMS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS DOUBLE) AS {c}" for c in ops.SIDES)
_FLOWS = f"flows AS (SELECT product, reporting_period, {_SUMS} FROM latest WHERE cohort <= DATE '{LAST_COHORT}' GROUP BY 1, 2)"


def _mape(m: str, cast: bool = False) -> str:
    a, p = (f"CAST({c} AS DOUBLE)" if cast else c for c in (m, f"{m}_pred"))
    return f"avg(CASE WHEN {a} <> 0 THEN abs({a} - {p}) / abs({a}) END) * 100"


def _rmse(m: str, cast: bool = False) -> str:
    a, p = (f"CAST({c} AS DOUBLE)" if cast else c for c in (m, f"{m}_pred"))
    return f"sqrt(avg(pow({a} - {p}, 2)))"


_ERROR_COLS = ", ".join(f"{_mape(m)} AS mape_{m}, {_rmse(m)} AS rmse_{m}" for m in MEASURES)
_EVALUATED = [
    _FLOWS,
    f"""evaluated AS (SELECT product, {_ERROR_COLS},
  count(*) FILTER (balance = 0 AND balance_pred IS NOT NULL) AS n_zero_actual FROM flows GROUP BY 1)""",
    f"""naive AS (SELECT product, avg(miss) * 100 AS baseline_all,
  avg(miss) FILTER (reporting_period < DATE '{CUTOFF}') * 100 AS baseline_train
  FROM (SELECT product, reporting_period, CASE WHEN balance <> 0 THEN abs(balance - balance_lag_1) / abs(balance) END AS miss
        FROM features) GROUP BY 1)""",
    """judged AS (SELECT e.*, baseline_train AS baseline_mape,
  (baseline_train - mape_balance) / baseline_train * 100 AS improvement, mape_balance < baseline_train AS beats
  FROM evaluated e LEFT JOIN naive n ON n.product = e.product)""",
]


def _monitoring(source: str, keys: str) -> str:
    mapes = ", ".join(f"round({_mape(m, True)}, 6) AS mape_{m}" for m in MEASURES)
    return f"""SELECT {keys}, count(*) AS n_predictions,
  round(avg(CASE WHEN balance_pred IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_prediction_rate,
  bool_or(balance IS NOT NULL) AS has_actuals, round({_rmse('balance', True)}, 6) AS rmse_balance, {mapes}
  FROM {source} GROUP BY ALL"""


SQL = {
    "eval_metrics": sql.with_ctes(
        _LATEST + _EVALUATED,
        "SELECT product, n_zero_actual, " + ", ".join(f"round({c}, 6) AS {c}" for c in _ERRORS) + " FROM evaluated",
    ),
    "naive_baseline": sql.with_ctes(
        _LATEST + _EVALUATED,
        "SELECT product, round(baseline_all, 6) AS baseline_all, round(baseline_train, 6) AS baseline_train FROM naive",
    ),
    "beats_baseline": sql.with_ctes(
        _LATEST + _EVALUATED,
        """SELECT product, round(mape_balance, 6) AS mape_balance, round(baseline_mape, 6) AS baseline_mape,
  round(improvement, 6) AS improvement_vs_baseline_pct, beats AS beats_baseline FROM judged""",
    ),
    "evaluation_summary": sql.with_ctes(
        _LATEST + _EVALUATED,
        """SELECT round(avg(mape_balance), 6) AS portfolio_mape, round(avg(rmse_balance), 6) AS portfolio_rmse,
  count(*) AS n_products_evaluated, count(*) FILTER (beats) AS products_beating_baseline,
  round(count(*) FILTER (beats) * 100.0 / count(*), 6) AS baseline_coverage_pct FROM judged""",
    ),
    "best_config": sql.with_ctes(
        _PRED
        + [
            """trial_flows AS (SELECT product, CAST(model_version AS INTEGER) AS grid_id, reporting_period,
  CAST(coalesce(sum(balance), 0) AS DOUBLE) AS balance, CAST(coalesce(sum(balance_pred), 0) AS DOUBLE) AS balance_pred
  FROM predictions GROUP BY 1, 2, 3)""",
            f"trials AS (SELECT product, grid_id, round({_mape('balance')}, 6) AS val_mape FROM trial_flows GROUP BY 1, 2)",
        ],
        """SELECT product, grid_id, val_mape FROM trials
QUALIFY row_number() OVER (PARTITION BY product ORDER BY val_mape NULLS LAST, grid_id) = 1""",
    ),
    "monitoring_metrics": sql.with_ctes(_LATEST, _monitoring("latest", "product")),
    "actuals_feedback": sql.with_ctes(
        _LATEST
        + [
            """fed AS (SELECT l.* REPLACE (coalesce(CAST(f.balance AS DECIMAL(20,4)), l.balance) AS balance)
  FROM latest l LEFT JOIN features f ON f.cohort = l.cohort AND f.product = l.product
    AND f.reporting_period = l.reporting_period)"""
        ],
        _monitoring("fed", "product"),
    ),
    "portfolio_rollup": sql.with_ctes(
        _LATEST
        + [
            f"""per_product AS (SELECT product, count(*) AS n, {_mape('balance', True)} AS mape,
  avg(CASE WHEN balance_pred IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM latest GROUP BY 1)"""
        ],
        """SELECT round(avg(mape), 6) AS portfolio_mape, round(max(null_rate), 6) AS max_null_rate,
  CAST(sum(n) AS BIGINT) AS n_predictions FROM per_product""",
    ),
    "total_balances": sql.with_ctes(
        _PRED,
        """SELECT model_version, product, CAST(sum(balance_pred) AS DOUBLE) AS total_balance_pred,
  CAST(sum(balance) AS DOUBLE) AS total_balance_actual FROM predictions GROUP BY 1, 2""",
    ),
    "product_coverage": sql.with_ctes(
        _PRED,
        "SELECT model_version, count(DISTINCT product) AS n_products, count(*) AS n_rows FROM predictions GROUP BY 1",
    ),
    "dash_portfolio_total": sql.with_ctes(
        _LATEST,
        "SELECT strftime(reporting_period, '%Y-%m') AS reporting_period, "
        + ", ".join(
            f"CAST(sum({m}) AS DOUBLE) AS portfolio_{m}_actual, CAST(sum({m}_pred) AS DOUBLE) AS portfolio_{m}_predicted"
            for m in MEASURES
        )
        + " FROM latest GROUP BY 1",
    ),
    "dash_mape_trend": sql.with_ctes(
        _PRED + [f"log AS ({_monitoring('predictions', 'scored_at, product')})"],
        "SELECT strftime(scored_at, '%Y-%m-%d') AS run_timestamp, product, "
        + ", ".join(f"mape_{m}" for m in MEASURES)
        + " FROM log WHERE has_actuals",
    ),
    "dash_quality_over_time": sql.with_ctes(
        _PRED + [f"log AS ({_monitoring('predictions', 'scored_at, product')})"],
        """SELECT strftime(scored_at, '%Y-%m-%d') AS run_timestamp, product, mape_balance, rmse_balance,
  null_prediction_rate FROM log""",
    ),
    "dash_ratio_heatmap": sql.with_ctes(
        sql.FEATURE_CTES + sql.GIVEN_RATIO_CTES,
        """SELECT months_since_start AS cohort_month, rate_bin, rec_pct AS receipt_pct
FROM given WHERE product = 'BUILDING'""",
    ),
}
SQL.update(
    {
        f"dash_{m}_by_product": sql.with_ctes(
            _LATEST,
            f"""SELECT strftime(reporting_period, '%Y-%m') AS reporting_period, product,
  CAST(sum({m}) AS DOUBLE) AS {m}_actual, CAST(sum({m}_pred) AS DOUBLE) AS {m}_predicted FROM latest GROUP BY 1, 2""",
        )
        for m in MEASURES
    }
)
