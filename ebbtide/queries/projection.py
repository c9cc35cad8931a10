"""Ratio tables as given, balance projection, scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import MEASURES, RATE_LABELS
from ebbtide.functions.dates import month_text
from ebbtide.operators import metrics, project, ratio_tables
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.queries.modelling import CUTOFF, LAST_COHORT
from ebbtide.session import materialize

# The last months of the parts of the resumed projection.
PARTS = ("1996-06-01", CUTOFF)
_PREDICTED = [f"{m}_pred" for m in MEASURES]


def _months():
    return [month_text(F.col(c)).alias(c) for c in ("cohort", "reporting_period")]


def ratio_composites(spark, sf_dir):
    return inputs.given_ratios(inputs.features(spark, sf_dir)).select(
        "product", "months_since_start", "bin_id", "rate_bin",
        *ratio_tables.RATIOS,
    )


def ratio_pivot(spark, sf_dir):
    table = inputs.given_ratios(inputs.features(spark, sf_dir))
    return ratio_tables.pivot_ratio(table, "rec_pct", ["product"])


def _ratios(feats):
    """The ratio table, written: the planner knows its size and decides on the join by it."""
    return materialize(inputs.given_ratios(feats), "given_ratios")


def _projected(spark, sf_dir):
    feats = inputs.features_table(spark, sf_dir)
    return project.project(project.lookup_ratios(feats, _ratios(feats)))


def project_balances(spark, sf_dir):
    rows = _projected(spark, sf_dir)
    return rows.select(
        *_months(), "product", "months_since_start", *[F.round(c, 2).alias(c) for c in (*_PREDICTED, "balance_lag_1")]
    )


def resumed_projection(spark, sf_dir):
    """The projection in three parts, each from the stored state that the one before has left."""
    feats = inputs.features_table(spark, sf_dir)
    rows = materialize(project.lookup_ratios(feats, _ratios(feats)), "looked_up")
    state, parts, start = None, [], None
    for end in (*PARTS, None):
        month = F.col("reporting_period")
        own = rows if start is None else rows.filter(month > F.lit(start).cast("date"))
        own = own if end is None else own.filter(month <= F.lit(end).cast("date"))
        done = project.project(own) if state is None else project.resume(own, state)
        parts.append(materialize(done, "projected"))
        state = materialize(project.end_state(parts[-1], state), "state")
        start = end
    together = reduce(DataFrame.unionByName, parts)
    return together.select(
        *_months(), "product", "months_since_start", *[F.round(c, 2).alias(c) for c in (*_PREDICTED, "balance_lag_1")]
    )


def score_batch(spark, sf_dir):
    """The months from the cut-off on, scored by the given ratio table, with row errors and audit columns."""
    feats = inputs.features_table(spark, sf_dir)
    batch = project.between_periods(feats, CUTOFF, None)
    scored = project.score(batch, _ratios(feats))
    audited = project.add_audit(scored, "2024-01-31 00:00:00", "cohort_model", "7", "champion")
    return audited.select(
        *_months(), "product", "months_since_start", *[F.round(c, 2).alias(c) for c in _PREDICTED], *MEASURES,
        *[F.round(f"ape_{m}", 8).alias(f"ape_{m}") for m in MEASURES],
        *[f"{r}_pred" for r in ratio_tables.RATIOS],
        F.date_format("scored_at", "yyyy-MM-dd").alias("scored_at"), "model_name", "model_version", "model_alias",
    )


def projected_flows(spark, sf_dir):
    """Portfolio sums per month of the cohorts up to the last one evaluated."""
    rows = project.cohorts_until(_projected(spark, sf_dir), LAST_COHORT)
    exact = rows.withColumns({c: F.col(c).cast(f"decimal(20,{4 if c in MEASURES else 2})") for c in metrics.SIDES})
    flows = metrics.portfolio_flows(exact, ["reporting_period"])
    return flows.withColumn("reporting_period", month_text(F.col("reporting_period")))


def score_preview(spark, sf_dir):
    """The first 100 rows in key order: a top-k report."""
    return (
        score_batch(spark, sf_dir)
        .select("product", "cohort", "reporting_period", "months_since_start", "balance_pred", "receipts_pred", "model_version", "scored_at")
        .orderBy("product", "cohort", "reporting_period")
        .limit(100)
    )


QUERIES = {
    f.__name__: f
    for f in (ratio_composites, ratio_pivot, project_balances, resumed_projection, score_batch, projected_flows, score_preview)
}

_GIVEN = sql.FEATURE_CTES + sql.GIVEN_RATIO_CTES
_PROJECTED = _GIVEN + sql.projection_ctes("features", "given")
_BATCH = [f"batch AS (SELECT * FROM features WHERE reporting_period >= DATE '{CUTOFF}')"]
_KEYS = "strftime(cohort, '%Y-%m') AS cohort, strftime(reporting_period, '%Y-%m') AS reporting_period, product, months_since_start"
_PREDICTED_SQL = ", ".join(f"round({c}, 2) AS {c}" for c in _PREDICTED)
_APES = ", ".join(
    f"CASE WHEN {m} <> 0 THEN round(abs({m} - {m}_pred) / abs({m}), 8) END AS ape_{m}" for m in MEASURES
)
_USED = ", ".join(
    f"CASE WHEN months_since_start <> 1 AND balance_lag_1 IS NOT NULL THEN {c} END AS {r}_pred"
    for c, r in zip(("rec", "outf", "tr"), ratio_tables.RATIOS)
)
_SCORED = f"""SELECT {_KEYS}, {_PREDICTED_SQL}, {', '.join(MEASURES)}, {_APES}, {_USED},
  '2024-01-31' AS scored_at, 'cohort_model' AS model_name, '7' AS model_version, 'champion' AS model_alias FROM projected"""
_SCORED_CTES = _GIVEN + _BATCH + sql.projection_ctes("batch", "given")

SQL = {
    "ratio_composites": sql.with_ctes(
        _GIVEN,
        f"SELECT product, months_since_start, bin_id, rate_bin, {', '.join(ratio_tables.RATIOS)} FROM given",
    ),
    "ratio_pivot": sql.with_ctes(
        _GIVEN,
        "SELECT product, months_since_start, "
        + ", ".join(f"""max(rec_pct) FILTER (bin_id = {i}) AS "{label}" """ for i, label in enumerate(RATE_LABELS))
        + " FROM given GROUP BY 1, 2",
    ),
    "project_balances": sql.with_ctes(
        _PROJECTED,
        f"SELECT {_KEYS}, {_PREDICTED_SQL}, round(balance_lag_1, 2) AS balance_lag_1 FROM projected",
        recursive=True,
    ),
    "score_batch": sql.with_ctes(_SCORED_CTES, _SCORED, recursive=True),
    "projected_flows": sql.with_ctes(
        _PROJECTED,
        "SELECT strftime(reporting_period, '%Y-%m') AS reporting_period, "
        + ", ".join(
            f"CAST(coalesce(sum(CAST({c} AS DECIMAL(20,{4 if c in MEASURES else 2}))), 0) AS DOUBLE) AS {c}"
            for c in metrics.SIDES
        )
        + f""", count(*) FILTER (balance_pred IS NULL) AS n_missing_pred
FROM projected WHERE cohort <= DATE '{LAST_COHORT}' GROUP BY 1""",
        recursive=True,
    ),
    "score_preview": sql.with_ctes(
        _SCORED_CTES + [f"scored AS ({_SCORED})"],
        """SELECT product, cohort, reporting_period, months_since_start, balance_pred, receipts_pred, model_version, scored_at
FROM scored ORDER BY product, cohort, reporting_period LIMIT 100""",
        recursive=True,
    ),
}
SQL["resumed_projection"] = SQL["project_balances"]
