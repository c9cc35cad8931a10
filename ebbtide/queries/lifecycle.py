"""Versions, promotion, validation, approvals, cards, run summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.constants import MODEL_FEATURES, MODEL_LABELS
from ebbtide.functions.errors import mape
from ebbtide.operators import decide as ops
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.sources.sample_views import read_table

# Which stage result each event type reports, and the value of a stage that never reported.
STAGE_KEYS = {
    "signup": "n_predictions", "click": "drift_detected", "error": "quality_passed", "purchase": "retrain_recommended",
}
MISSING = "N/A"


def alias_state(spark, sf_dir):
    return ops.alias_state(inputs.version_log(spark, sf_dir))


def version_listing(spark, sf_dir):
    rows = ops.version_state(inputs.version_log(spark, sf_dir))
    return rows.withColumn("registered_ts", F.date_format("registered_ts", "yyyy-MM-dd HH:mm:ss")).orderBy(
        "model_name", F.desc("version")
    )


def promotion_decision(spark, sf_dir):
    rows = ops.promotion(ops.champion_versus_challenger(inputs.version_log(spark, sf_dir)))
    return rows.withColumn("improvement_pct", F.round("improvement_pct", 6))


def decision_events(spark, sf_dir):
    decided = ops.promotion(ops.champion_versus_challenger(inputs.version_log(spark, sf_dir)))
    rows = ops.decision_events(decided, "2024-02-01 00:00:00")
    return rows.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd"))


def prior_champion(spark, sf_dir):
    return ops.prior_champion(inputs.version_log(spark, sf_dir))


def best_run(spark, sf_dir):
    """Events as runs: lowest positive value per event type and user."""
    runs = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment"), "user_id", F.col("event_id").alias("run_id"), F.col("value").alias("metric")
    )
    return ops.best_run(runs, ["experiment", "user_id"])


def _approvals(spark, sf_dir):
    """Approval log: request = user; purchases approve, errors reject, the rest is pending."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", " approved ").when(kind == "error", "Rejected").otherwise("pending")
    return read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("request_id"), F.col("event_id").alias("decision_id"), F.col("ts").alias("approval_ts"),
        status.alias("approval_status"), F.col("props").alias("approver"),
    )


def latest_approval(spark, sf_dir):
    rows = ops.latest_approvals(_approvals(spark, sf_dir))
    return rows.withColumn("approval_ts", F.date_format("approval_ts", "yyyy-MM-dd HH:mm:ss"))


# What each scenario of the gate does to a challenger.
_SCENARIOS = ("as it is", "without description", "twice the error", "half the balance", "a cohort less")


def challenger_gate(spark, sf_dir):
    """Batch 3 challenges batch 2, product by product, as it is and with a fault for each check.

    One product's cohorts stand for the products of a model.
    """
    rows = inputs.predictions(inputs.features(spark, sf_dir))

    def of(version: str, prefix: str):
        mine = F.col("model_version") == version
        pred = F.when(mine, F.col("balance_pred"))
        return [
            mape(F.col("balance").cast("double"), pred.cast("double")).alias(f"{prefix}_mape"),
            F.sum(pred).cast("double").alias(f"{prefix}_balance"),
            F.countDistinct(F.when(mine, F.col("cohort"))).alias(f"{prefix}_products"),
        ]

    pairs = rows.groupBy("product").agg(*of("3", "challenger"), *of("2", "champion"))
    scenario = F.col("scenario")
    tried = pairs.withColumn("scenario", F.explode(F.array(*[F.lit(x) for x in _SCENARIOS]))).withColumns(
        {
            "description": F.when(scenario == _SCENARIOS[1], " ").otherwise(F.col("product")),
            "challenger_mape": F.col("challenger_mape") * F.when(scenario == _SCENARIOS[2], 2.0).otherwise(1.0),
            "challenger_balance": F.col("challenger_balance") * F.when(scenario == _SCENARIOS[3], 0.5).otherwise(1.0),
            "challenger_products": F.col("challenger_products") - F.when(scenario == _SCENARIOS[4], 1).otherwise(0),
        }
    )
    gate = ops.challenger_gate(tried)
    return gate.withColumns({c: F.round(c, 6) for c in ("challenger_mape", "champion_mape")})


def model_card(spark, sf_dir):
    """A card for every version that is or was champion."""
    versions = ops.version_state(inputs.version_log(spark, sf_dir)).filter(F.col("stage").isin("champion", "retired"))
    cards = ops.model_cards(versions, {"framework": "spark glm", "environment": "test"}, MODEL_FEATURES, MODEL_LABELS)
    return cards.select(
        "model_name", "version", "stage", "metric", "framework", "environment",
        F.array_join("features", ",").alias("features"), F.size("labels").alias("n_labels"),
    )


def run_summary(spark, sf_dir):
    """Events as stage results: one row per user with the latest of each."""
    key = F.create_map(*[F.lit(x) for pair in STAGE_KEYS.items() for x in pair])
    log = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), key[F.col("event_type")].alias("key"), F.col("props").alias("value"),
        F.col("ts").alias("logged_at"), F.col("event_id").alias("entry_id"),
    )
    return ops.run_summary(log, {**{k: MISSING for k in STAGE_KEYS.values()}, "retrain_reason": MISSING})


QUERIES = {
    f.__name__: f
    for f in (
        alias_state, version_listing, promotion_decision, decision_events, prior_champion, best_run, latest_approval, challenger_gate,
        model_card, run_summary,
    )
}

_ALIASES = """aliases AS (SELECT model_name,
  arg_min(version, (event_ts, version)) FILTER (event = 'registered') AS baseline_version,
  arg_max(version, (event_ts, version)) FILTER (event = 'registered') AS challenger_version,
  arg_max(version, (event_ts, version)) FILTER (event = 'promoted') AS champion_version,
  count(*) FILTER (event = 'registered') AS n_versions FROM version_log GROUP BY 1)"""
_STAGES = """versions AS (SELECT user_id AS model_name, event_id AS version, ts AS registered_ts, value AS metric,
  event_type = 'purchase' AS was_promoted, event_type = 'error' AS was_rejected FROM events),
listing AS (SELECT v.model_name, version, registered_ts, metric,
  CASE WHEN version IS NOT DISTINCT FROM champion_version THEN 'champion' WHEN was_promoted THEN 'retired'
       WHEN was_rejected THEN 'rejected' WHEN version = challenger_version THEN 'challenger' ELSE 'archived' END AS stage,
  concat_ws(', ', CASE WHEN version = baseline_version THEN 'baseline' END,
    CASE WHEN version = challenger_version THEN 'challenger' END,
    CASE WHEN version = champion_version THEN 'champion' END) AS aliases
  FROM versions v JOIN aliases a ON a.model_name = v.model_name)"""
_LOG = sql.VERSION_LOG_CTES + [_ALIASES]
_GATE_MAPE = """avg(CASE WHEN balance <> 0 THEN abs(CAST(balance AS DOUBLE) - CAST(balance_pred AS DOUBLE))
    / abs(CAST(balance AS DOUBLE)) END) FILTER (model_version = '{v}') * 100"""


def _latest_stage(event: str, key: str) -> str:
    return f"coalesce(arg_max(props, (ts, event_id)) FILTER (event_type = '{event}'), '{MISSING}') AS {key}"


_PAIRS = """pairs AS (SELECT a.model_name, challenger_version, n.value AS challenger_metric, champion_version,
  o.value AS champion_metric, (o.value - n.value) / o.value * 100 AS pct
  FROM aliases a LEFT JOIN events n ON n.event_id = challenger_version LEFT JOIN events o ON o.event_id = champion_version)"""
_PROMOTED = "champion_version IS NULL OR coalesce(champion_metric, 0) = 0 OR coalesce(pct >= 15, false)"

SQL = {
    "alias_state": sql.with_ctes(_LOG, "SELECT * FROM aliases"),
    "version_listing": sql.with_ctes(
        _LOG + [_STAGES],
        "SELECT * REPLACE (strftime(registered_ts, '%Y-%m-%d %H:%M:%S') AS registered_ts) FROM listing",
    ),
    "promotion_decision": sql.with_ctes(
        _LOG + [_PAIRS],
        f"""SELECT model_name, challenger_version, challenger_metric, champion_version, champion_metric,
  round(pct, 6) AS improvement_pct, {_PROMOTED} AS promoted,
  CASE WHEN champion_version IS NULL THEN 'no champion yet' WHEN coalesce(champion_metric, 0) = 0 THEN 'champion has no comparable metric'
       WHEN pct >= 15 THEN 'improvement reaches the threshold' ELSE 'improvement below the threshold' END AS reason FROM pairs""",
    ),
    "decision_events": sql.with_ctes(
        _LOG + [_PAIRS],
        f"""SELECT model_name, challenger_version AS version, unnest(['registered',
  CASE WHEN {_PROMOTED} THEN 'promoted' ELSE 'rejected' END]) AS event, '2024-02-01' AS event_ts,
  challenger_metric AS metric FROM pairs""",
    ),
    "prior_champion": sql.with_ctes(
        _LOG,
        """SELECT l.model_name, champion_version, max(version) AS prior_champion_version FROM version_log l
JOIN aliases a ON a.model_name = l.model_name WHERE event = 'promoted' AND version <> champion_version GROUP BY 1, 2""",
    ),
    "best_run": """SELECT event_type AS experiment, user_id, event_id AS run_id, value AS metric FROM events WHERE value > 0
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY value, event_id) = 1""",
    "latest_approval": """SELECT user_id AS request_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS approval_ts, event_id AS decision_id,
  CASE event_type WHEN 'purchase' THEN 'APPROVED' ELSE 'REJECTED' END AS approval_status, props AS approver
FROM events WHERE event_type IN ('purchase', 'error')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "challenger_gate": sql.with_ctes(
        sql.FEATURE_CTES
        + sql.prediction_ctes(inputs.LANDED_UNTIL)
        + [
            f"""measured AS (SELECT product, {_GATE_MAPE.format(v='3')} AS challenger_mape,
  CAST(sum(balance_pred) FILTER (model_version = '3') AS DOUBLE) AS challenger_balance,
  count(DISTINCT cohort) FILTER (model_version = '3') AS challenger_products,
  {_GATE_MAPE.format(v='2')} AS champion_mape,
  CAST(sum(balance_pred) FILTER (model_version = '2') AS DOUBLE) AS champion_balance,
  count(DISTINCT cohort) FILTER (model_version = '2') AS champion_products
  FROM predictions GROUP BY 1)""",
            f"""pairs AS (SELECT product, scenario, champion_mape, champion_balance, champion_products,
  CASE WHEN scenario = '{_SCENARIOS[1]}' THEN ' ' ELSE product END AS description,
  challenger_mape * CASE WHEN scenario = '{_SCENARIOS[2]}' THEN 2 ELSE 1 END AS challenger_mape,
  challenger_balance * CASE WHEN scenario = '{_SCENARIOS[3]}' THEN 0.5::DOUBLE ELSE 1 END AS challenger_balance,
  challenger_products - CASE WHEN scenario = '{_SCENARIOS[4]}' THEN 1 ELSE 0 END AS challenger_products
  FROM measured, (SELECT unnest({list(_SCENARIOS)}) AS scenario))""",
            """checked AS (SELECT *, length(trim(description)) > 0 AS has_description,
  (champion_mape - challenger_mape) / champion_mape * 100 >= -5 AS mape_passed,
  abs(challenger_balance - champion_balance) / champion_balance * 100 <= 30 AS business_metric_passed,
  challenger_products >= champion_products AS coverage_passed FROM pairs)""",
        ],
        """SELECT * REPLACE (round(challenger_mape, 6) AS challenger_mape, round(champion_mape, 6) AS champion_mape),
  has_description AND mape_passed AND business_metric_passed AND coverage_passed AS validation_passed,
  concat_ws(', ', CASE WHEN NOT has_description THEN 'has_description' END, CASE WHEN NOT mape_passed THEN 'mape_passed' END,
    CASE WHEN NOT business_metric_passed THEN 'business_metric_passed' END,
    CASE WHEN NOT coverage_passed THEN 'coverage_passed' END) AS rejection_reason FROM checked""",
    ),
    "model_card": sql.with_ctes(
        _LOG + [_STAGES],
        f"""SELECT model_name, version, stage, metric, 'spark glm' AS framework, 'test' AS environment,
  '{','.join(MODEL_FEATURES)}' AS features, {len(MODEL_LABELS)} AS n_labels FROM listing WHERE stage IN ('champion', 'retired')""",
    ),
    "run_summary": "SELECT user_id AS run_id, "
    + ", ".join(_latest_stage(e, k) for e, k in STAGE_KEYS.items())
    + f", '{MISSING}' AS retrain_reason FROM events GROUP BY 1",
}
