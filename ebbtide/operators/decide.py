"""Retraining, promotion, validation and the model version log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.constants import (
    GATE_MAX_BALANCE_DEVIATION_PCT,
    GATE_MAX_REGRESSION_PCT,
    PROMOTION_MIN_IMPROVEMENT_PCT,
    RETRAIN_MAPE,
    RETRAIN_NULL_RATE,
)
from ebbtide.operators.quantiles import sort_key

REGISTERED, PROMOTED, REJECTED = "registered", "promoted", "rejected"
APPROVED = "APPROVED"
TURNED_DOWN = "REJECTED"
PENDING = "PENDING"
GATE_CHECKS = ("has_description", "mape_passed", "business_metric_passed", "coverage_passed")


def retraining_need(
    signals: DataFrame, null_rate_limit: float = RETRAIN_NULL_RATE, mape_limit: float = RETRAIN_MAPE
) -> DataFrame:
    """Adds ``retrain`` and ``reason`` to rows of (drift_detected, max_null_rate, portfolio_mape)."""
    drift = F.coalesce("drift_detected", F.lit(False))
    nulls = F.coalesce("max_null_rate", F.lit(0.0)) > null_rate_limit
    error = F.coalesce(F.col("portfolio_mape") > mape_limit, F.lit(False))
    reasons = F.concat_ws(
        "; ",
        F.when(drift, "PSI alert detected"),
        F.when(
            nulls,
            F.concat(
                F.lit("Null prediction rate "), F.format_string("%.2f", F.col("max_null_rate") * 100),
                F.lit(f"% > threshold {null_rate_limit:.2%}"),
            ),
        ),
        F.when(
            error,
            F.concat(
                F.lit("Portfolio MAPE "), F.format_string("%.2f", F.col("portfolio_mape")),
                F.lit(f" > threshold {mape_limit:.2f}"),
            ),
        ),
    )
    return signals.withColumn("retrain", drift | nulls | error).withColumn(
        "reason", F.when(F.col("retrain"), reasons).otherwise("No retraining trigger crossed")
    )


def promotion(
    metrics: DataFrame, lower_is_better: bool = True, threshold_pct: float = PROMOTION_MIN_IMPROVEMENT_PCT
) -> DataFrame:
    """Adds ``improvement_pct``, ``promoted`` and ``reason`` to rows of (champion_metric, challenger_metric).

    A row without a champion version, or with a champion that has no usable metric, promotes.
    """
    old, new = F.col("champion_metric"), F.col("challenger_metric")
    change = F.try_divide(old - new, old) * 100
    change = change if lower_is_better else -change
    first = F.col("champion_version").isNull()
    incomparable = old.isNull() | (old == 0)
    return (
        metrics.withColumn("improvement_pct", change)
        .withColumn(
            "promoted",
            first | incomparable | F.coalesce(F.col("improvement_pct") >= threshold_pct, F.lit(False)),
        )
        .withColumn(
            "reason",
            F.when(first, "no champion yet")
            .when(incomparable, "champion has no comparable metric")
            .when(F.col("promoted"), "improvement reaches the threshold")
            .otherwise("improvement below the threshold"),
        )
    )


def challenger_gate(
    pairs: DataFrame,
    max_regression_pct: float = GATE_MAX_REGRESSION_PCT,
    max_deviation_pct: float = GATE_MAX_BALANCE_DEVIATION_PCT,
) -> DataFrame:
    """The four validation checks on rows of challenger_/champion_ mape, balance and products, and description."""
    old, new = F.col("champion_mape"), F.col("challenger_mape")
    improvement = F.try_divide(old - new, old) * 100
    deviation = F.try_divide(F.abs(F.col("challenger_balance") - F.col("champion_balance")), F.col("champion_balance"))
    no_balance = F.coalesce(F.col("champion_balance"), F.lit(0.0)) == 0
    covered = F.col("challenger_products") >= F.coalesce(F.col("champion_products"), F.lit(0))
    checked = pairs.withColumns(
        {
            "has_description": F.coalesce(F.length(F.trim("description")) > 0, F.lit(False)),
            "mape_passed": old.isNull() | F.coalesce(improvement >= -max_regression_pct, F.lit(False)),
            "business_metric_passed": no_balance | F.coalesce(deviation * 100 <= max_deviation_pct, F.lit(False)),
            "coverage_passed": F.coalesce(covered, F.lit(False)),
        }
    )
    failed = F.concat_ws(", ", *[F.when(~F.col(c), F.lit(c)) for c in GATE_CHECKS])
    passed = F.lit(True)
    for c in GATE_CHECKS:
        passed = passed & F.col(c)
    return checked.withColumn("validation_passed", passed).withColumn("rejection_reason", failed)


# --- picks: the last of many rows by (time, number), as one number that a hash aggregate can hold --------------------

_NUMBERS = 10**18


def _stamped(ts: Column, number: Column) -> Column:
    """(time, number) in one DECIMAL of the same order; a struct would make Spark sort all rows before aggregating."""
    return (F.unix_micros(ts.cast("timestamp")).cast("decimal(38,0)") * F.lit(_NUMBERS).cast("decimal(19,0)") + number.cast("decimal(19,0)")).cast("decimal(38,0)")


def _number_of(stamped: Column) -> Column:
    return F.pmod(stamped, F.lit(_NUMBERS).cast("decimal(19,0)")).cast("long")


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the row with the largest ``_stamp``: the stamps are reduced first, the rest of the row is joined to
    what remains. A row without a stamp is no candidate."""
    last = rows.groupBy(*keys).agg(F.max("_stamp").alias("_stamp"))
    return rows.join(last, [*keys, "_stamp"]).drop("_stamp").dropDuplicates(list(keys))


# --- version log: (model_name, version, event, event_ts, metric) --------------------------------------------------


def alias_state(log: DataFrame) -> DataFrame:
    """Who holds each alias of a model now: the first registered version is the baseline, the last one the challenger,
    the last promoted one the champion. Plain hash aggregates, so a model with very many events is combined map-side.
    Versions are whole numbers from 0 on."""
    when = _stamped(F.col("event_ts"), F.col("version"))
    kind = log.schema["version"].dataType
    registered = F.when(F.col("event") == REGISTERED, when)
    promoted = F.when(F.col("event") == PROMOTED, when)
    return log.groupBy("model_name").agg(
        _number_of(F.min(registered)).cast(kind).alias("baseline_version"),
        _number_of(F.max(registered)).cast(kind).alias("challenger_version"),
        _number_of(F.max(promoted)).cast(kind).alias("champion_version"),
        F.count_if(F.col("event") == REGISTERED).alias("n_versions"),
    )


def version_state(log: DataFrame) -> DataFrame:
    """One row per version: metric, stage and aliases.

    Stage: the champion; a former champion (``retired``); the newest version (``challenger``) or, if it was turned
    down, ``rejected``; any other version is archived. Join sides are left to the planner: the alias side has one row
    per model, and a model with very many versions is split as a skewed join.
    """
    versions = log.groupBy("model_name", "version").agg(
        F.min(F.when(F.col("event") == REGISTERED, F.col("event_ts"))).alias("registered_ts"),
        F.max("metric").alias("metric"),
        F.bool_or(F.col("event") == PROMOTED).alias("was_promoted"),
        F.bool_or(F.col("event") == REJECTED).alias("was_rejected"),
    )
    held = versions.join(alias_state(log).drop("n_versions"), "model_name")

    def holds(alias: str) -> Column:
        return F.coalesce(F.col("version") == F.col(f"{alias}_version"), F.lit(False))

    stage = (
        F.when(holds("champion"), "champion")
        .when(F.col("was_promoted"), "retired")
        .when(F.col("was_rejected"), "rejected")
        .when(holds("challenger"), "challenger")
        .otherwise("archived")
    )
    aliases = F.concat_ws(", ", *[F.when(holds(a), a) for a in ("baseline", "challenger", "champion")])
    return held.select("model_name", "version", "registered_ts", "metric", stage.alias("stage"), aliases.alias("aliases"))


def champion_versus_challenger(log: DataFrame, version: int | None = None) -> DataFrame:
    """One row per model: both versions and their metrics, ready for ``promotion``. The challenger is the version that
    is asked for, or the last registered one; it is null if that one is not registered."""
    kind = log.schema["version"].dataType
    when = _stamped(F.col("event_ts"), F.col("version"))
    newest, leader = (F.when(F.col("event") == event, when) for event in (REGISTERED, PROMOTED))
    if version is not None:
        newest = F.when(F.col("version") == version, newest)
    return log.groupBy("model_name").agg(
        _number_of(F.max(newest)).cast(kind).alias("challenger_version"),
        F.max_by("metric", newest).alias("challenger_metric"),
        _number_of(F.max(leader)).cast(kind).alias("champion_version"),
        F.max_by("metric", leader).alias("champion_metric"),
    )


def decision_events(decided: DataFrame, decided_at: str) -> DataFrame:
    """Log rows for decided promotions: the challenger's registration and its promotion or rejection."""
    outcome = F.when(F.col("promoted"), PROMOTED).otherwise(REJECTED)
    return decided.select(
        "model_name",
        F.col("challenger_version").alias("version"),
        F.explode(F.array(F.lit(REGISTERED), outcome)).alias("event"),
        F.lit(decided_at).cast("timestamp").alias("event_ts"),
        F.col("challenger_metric").alias("metric"),
    )


def prior_champion(log: DataFrame) -> DataFrame:
    """The version to fall back to per model: the highest promoted one that is not the champion now."""
    champions = alias_state(log).select("model_name", "champion_version")
    promoted = log.filter(F.col("event") == PROMOTED).select("model_name", "version").join(champions, "model_name")
    return (
        promoted.filter(F.col("version") != F.col("champion_version"))
        .groupBy("model_name", "champion_version")
        .agg(F.max("version").alias("prior_champion_version"))
    )


_RUNS = 1 << 63


def best_run(runs: DataFrame, keys: Sequence[str], metric: str = "metric", run: str = "run_id") -> DataFrame:
    """Lowest positive metric per key; the lower run id wins ties.

    Run ids that are whole numbers, from 0 on, make one DECIMAL with the metric's sort key, which a hash aggregate can
    hold; others are compared as they are, after a sort.
    """
    positive = runs.filter(F.col(metric) > 0)
    kind, of_metric = runs.schema[run].dataType, runs.schema[metric].dataType
    if not isinstance(kind, (T.IntegerType, T.LongType)) or not isinstance(of_metric, T.DoubleType):
        best = F.min(F.struct(metric, run))
        return positive.groupBy(*keys).agg(best[run].alias(run), best[metric].alias(metric))
    size = F.when(F.isnan(metric), F.lit(_RUNS - 1)).otherwise(sort_key(F.col(metric)))
    wide = F.lit(str(_RUNS)).cast("decimal(19,0)")
    code = (size.cast("decimal(19,0)") * wide).cast("decimal(38,0)") + F.col(run).cast("decimal(19,0)")
    best = F.pmod(F.min(code.cast("decimal(38,0)")), wide).cast(kind)
    return positive.groupBy(*keys).agg(best.alias(run), F.min(metric).alias(metric))


def latest_approvals(approvals: DataFrame) -> DataFrame:
    """Last decision per request; rows still pending do not count."""
    status = F.upper(F.trim("approval_status"))
    decided = approvals.withColumn("approval_status", status).filter(status.isin(APPROVED, TURNED_DOWN)).select(
        "request_id", "approval_ts", "decision_id", "approval_status", "approver",
        _stamped(F.col("approval_ts"), F.col("decision_id")).alias("_stamp"),
    )
    return _latest(decided, ["request_id"])


def approval_requests(checked: DataFrame, requested_at: str) -> DataFrame:
    """A row for the approval log for each validated challenger (model_name, model_version and the gate's columns):
    pending if the gate passed, turned down by the gate if not. The request is named after model and version."""
    status = F.when(F.col("validation_passed"), PENDING).otherwise(TURNED_DOWN)
    flags = F.create_map(*[x for c in GATE_CHECKS for x in (F.lit(c), F.col(c))])
    return checked.withColumns(
        {
            "request_id": F.concat_ws("-", "model_name", "model_version"),
            "decision_id": F.lit(0).cast("long"),
            "approver": F.when(~F.col("validation_passed"), "validation"),
            "approval_status": status,
            "approval_ts": F.lit(requested_at).cast("timestamp"),
            "checks_passed": flags,
        }
    )


def decision_rows(pending: DataFrame, decision: str, approver: str, decided_at: str, comments: str = "") -> DataFrame:
    """Approval rows for the pending requests, ready to append to the log."""
    decision = decision.strip().upper()
    if decision not in (APPROVED, TURNED_DOWN):
        raise ValueError("decision must be APPROVED or REJECTED")
    return pending.withColumns(
        {
            "approver": F.lit(approver.strip()),
            "approval_status": F.lit(decision),
            "approval_ts": F.lit(decided_at).cast("timestamp"),
            "rejection_reason": F.lit(comments if decision == TURNED_DOWN else ""),
        }
    )


def model_cards(versions: DataFrame, constants: Mapping[str, str], features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """One card per version: the constants, the feature and label lists, and the version's own columns."""
    return versions.withColumns(
        {
            **{k: F.lit(v) for k, v in constants.items()},
            "features": F.array(*[F.lit(x) for x in features]),
            "labels": F.array(*[F.lit(x) for x in labels]),
        }
    )


def run_summary(log: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """One row per run with the latest value of each stage result; stages that never reported keep the default."""
    stamped = log.select("run_id", "key", "value", _stamped(F.col("logged_at"), F.col("entry_id")).alias("_stamp"))
    last = _latest(stamped.filter(F.col("key").isin(*defaults)), ["run_id", "key"])
    found = last.groupBy("run_id").agg(*[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in defaults])
    shown = [F.coalesce(F.col(k), F.lit(d)).alias(k) for k, d in defaults.items()]
    return log.select("run_id").distinct().join(found, "run_id", "left").select("run_id", *shown)
