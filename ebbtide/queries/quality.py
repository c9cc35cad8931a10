"""Data-quality checks and guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.constants import SCORING_NULL_CHECKED, TRAINING_NULL_CHECKED
from ebbtide.operators import metrics
from ebbtide.operators import quality as ops
from ebbtide.plans import dashboards
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.queries.modelling import CUTOFF

STAMP = "2024-01-31"


def quality_training(spark, sf_dir):
    return ops.training_checks(inputs.features(spark, sf_dir))


def quality_scoring(spark, sf_dir):
    rows = inputs.features(spark, sf_dir).filter(F.col("reporting_period") >= F.lit(CUTOFF).cast("date"))
    return ops.scoring_checks(rows)


def quality_verdict(spark, sf_dir):
    """The training gate with and without the rows that cannot have a lag."""
    feats = inputs.features_table(spark, sf_dir)

    def verdict(skip: bool):
        row = ops.all_passed(ops.training_checks(feats, skip_first_age=skip))
        return row.select(F.lit(skip).alias("skip_first_age"), "passed", F.array_join("failures", ", ").alias("failures"))

    return verdict(False).unionByName(verdict(True))


def dash_quality(spark, sf_dir):
    log = ops.quality_log(ops.training_checks(inputs.features(spark, sf_dir)), f"{STAMP} 00:00:00", "training")
    return dashboards.checks_trend(log).withColumn("validated_at", F.date_format("validated_at", "yyyy-MM-dd"))


def null_prediction_guard(spark, sf_dir):
    latest = metrics.latest_batch(inputs.predictions(inputs.features_table(spark, sf_dir)))
    row = ops.null_prediction_guard(metrics.monitoring_metrics(latest))
    return row.withColumn("max_null_rate", F.round("max_null_rate", 6))


QUERIES = {
    f.__name__: f for f in (quality_training, quality_scoring, quality_verdict, dash_quality, null_prediction_guard)
}


def _checks(source: str, min_rows: int, columns, ranges, coverage: bool) -> str:
    rows = ["SELECT 'schema_columns' AS check_name, true AS passed, 'all required columns present' AS detail"]
    rows.append(
        f"SELECT 'row_count', count(*) >= {min_rows}, count(*) || ' rows (expected >= {min_rows})' FROM {source}"
    )
    rows += [
        f"""SELECT 'null_rate::{c}', count(*) FILTER ({c} IS NULL) <= 0.05 * count(*),
  printf('%.2f%% null (threshold 5%%)', 100.0 * count(*) FILTER ({c} IS NULL) / count(*)) FROM {source}"""
        for c in columns
    ]
    rows += [
        f"""SELECT 'value_range::{c}', count(*) FILTER ({c} < {lo} OR {c} > {hi}) = 0,
  count(*) FILTER ({c} < {lo} OR {c} > {hi}) || ' rows outside [{float(lo)}, {float(hi)}]' FROM {source}"""
        for c, (lo, hi) in ranges.items()
    ]
    if coverage:
        rows.append(
            f"""SELECT 'product_coverage', count(DISTINCT product) >= 5,
  count(DISTINCT product) || ' distinct products (expected >= 5)' FROM {source}"""
        )
    numbered = [r.replace("SELECT ", f"SELECT {i} AS check_no, ", 1) for i, r in enumerate(rows)]
    return " UNION ALL ".join(numbered)


_TRAINING_RANGES = {"outflow_prop": (0, 1), "rec_prop": (0, 5)}


def _training(source: str) -> str:
    return _checks(source, 500, TRAINING_NULL_CHECKED, _TRAINING_RANGES, True)


_LATER = ["later AS (SELECT * FROM features WHERE months_since_start > 1)"]

SQL = {
    "quality_training": sql.with_ctes(sql.FEATURE_CTES, _training("features")),
    "quality_scoring": sql.with_ctes(
        sql.FEATURE_CTES + [f"batch AS (SELECT * FROM features WHERE reporting_period >= DATE '{CUTOFF}')"],
        _checks("batch", 100, SCORING_NULL_CHECKED, {"delta_to_best_buy": (-3, 3)}, False),
    ),
    "quality_verdict": sql.with_ctes(
        sql.FEATURE_CTES
        + _LATER
        + [
            f"checks AS (SELECT false AS skip_first_age, * FROM ({_training('features')}) "
            f"UNION ALL SELECT true, * FROM ({_training('later')}))"
        ],
        """SELECT skip_first_age, bool_and(passed) AS passed,
  coalesce(string_agg(check_name, ', ' ORDER BY check_no) FILTER (NOT passed), '') AS failures FROM checks GROUP BY 1""",
    ),
    "dash_quality": sql.with_ctes(
        sql.FEATURE_CTES + [f"checks AS ({_training('features')})"],
        f"""SELECT check_name, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS check_status,
  '{STAMP}' AS validated_at, detail FROM checks""",
    ),
    "null_prediction_guard": sql.with_ctes(
        sql.FEATURE_CTES
        + sql.prediction_ctes(inputs.LANDED_UNTIL)
        + [
            """rates AS (SELECT avg(CASE WHEN balance_pred IS NULL THEN 1.0 ELSE 0.0 END) AS rate FROM predictions
  WHERE scored_at = (SELECT max(scored_at) FROM predictions) GROUP BY product)"""
        ],
        "SELECT round(max(rate), 6) AS max_null_rate, max(rate) < 0.5 AS passed FROM rates",
    ),
}
