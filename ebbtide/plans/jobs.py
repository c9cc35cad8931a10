"""The three jobs over the stored tables: train, score, monitor. Only these functions run actions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ebbtide.constants import DRIFT_FEATURES, DRIFT_PREDICTIONS, FOLD_OFFSETS, MATRIX_KEYS, MODEL_FEATURES, MODEL_LABELS, PARAM_GRID
from ebbtide.operators import cohort, decide, drift, maintain, metrics, project, quality
from ebbtide.operators.prep import MAIN_WINDOW
from ebbtide.plans import monitoring, training
from ebbtide.session import materialize
from ebbtide.sources import readers
from ebbtide.sources.readers import require_rows
from ebbtide.sources.store import Store

CHAMPION = "champion"


def _stamp(now: str):
    return F.lit(now).cast("timestamp")


def evaluate(run: training.Training, features: DataFrame, cutoff: str, last_cohort: str) -> DataFrame:
    """Errors of every measure of each product's best configuration, beside the naive baseline."""
    chosen = run.projected.filter(F.col("window_id") == MAIN_WINDOW).join(
        run.best.select("product", "grid_id"), ["product", "grid_id"], "left_semi"
    )
    flows = metrics.portfolio_flows(project.cohorts_until(chosen, last_cohort), ["product", "reporting_period"])
    baseline = metrics.naive_baseline(features, F.col("reporting_period") < F.lit(cutoff).cast("date"))
    return metrics.against_baseline(metrics.error_metrics(flows, ["product"]), baseline)


# What the stages of a run report; a stage that has not reported shows the last one.
RUN_KEYS = (
    "checks_failed", "portfolio_mape", "validation", "promotion", "served_version", "n_predictions", "drift_detected", "retrain", "retrain_reason",
)
NOT_REPORTED = "not reported"


def log_run(store: Store, run_id: str, now: str, **results: object) -> None:
    """Append what a stage reports to the run log; the last report of a key counts."""
    unknown = set(results) - set(RUN_KEYS)
    if unknown:
        raise ValueError(f"unknown results {sorted(unknown)}")
    shown = [(run_id, RUN_KEYS.index(k), k, "" if v is None else str(v)) for k, v in results.items()]
    rows = store.spark.createDataFrame(shown, "run_id string, entry_id long, key string, value string")
    store.append(rows.withColumn("logged_at", _stamp(now)), "run_log")


def run_report(store: Store) -> DataFrame:
    """One row per run with the last report of each stage."""
    return decide.run_summary(store.read("run_log"), dict.fromkeys(RUN_KEYS, NOT_REPORTED))


def ingest_job(store: Store, accounts: str, rates: str, products: str | None = None, now: str | None = None) -> int:
    """Raw files into the raw tables; an empty file is refused before anything is replaced. Returns the number of lines
    that do not fit their schema: they are kept in ``ingest_rejects``, and the others are loaded."""
    found = {"raw_base_data": readers.read_accounts(store.spark, accounts)}
    rejects = store.spark.createDataFrame([], readers.REJECTS)
    checked = {"raw_best_buy": (readers.read_rates_checked, rates), "raw_products": (readers.read_products_checked, products)}
    for table, (read, path) in checked.items():
        if path is not None:
            found[table], bad = read(store.spark, path)
            rejects = rejects.union(bad)
    for table, rows in found.items():
        require_rows(rows, table)
    stamped = rejects.withColumn("loaded_at", _stamp(now) if now is not None else F.current_timestamp())
    rejects = materialize(stamped, "rejects")
    store.append(rejects, "ingest_rejects")
    for table, rows in found.items():
        store.overwrite(rows, table)
    return rejects.count()


def train_job(
    store: Store,
    accounts: DataFrame,
    rates: DataFrame,
    products: DataFrame | None,
    mapping: Mapping[str, str] | None,
    cutoff: str,
    last_cohort: str,
    model_name: str,
    version: int,
    now: str,
    environment: str = "dev",
    grid: Sequence[tuple[int, bool]] = PARAM_GRID,
    offsets: Sequence[int] = FOLD_OFFSETS,
    gate: bool = True,
    description: str = "cohort cash-flow ratios",
    approval: bool = False,
) -> Row:
    """Matrix, checks, search, evaluation, validation, registration, promotion. Returns the promotion decision.

    Logs are written before a failed gate raises. A challenger that fails validation is logged as rejected and not
    registered, and leaves no ratio tables, so its number is free; one that passes leaves a pending request. With
    ``approval``, it is promoted only if the last decision on that request allows it: see ``promote_job``. A promoted
    version freezes the drift baseline; a rejected one is logged as such. The number of a registered version is refused.
    """
    taken = (F.col("model_name") == model_name) & (F.col("version") == version) & (F.col("event") == decide.REGISTERED)
    if not store.read("model_versions").filter(taken).isEmpty():
        raise ValueError(f"{model_name} has a version {version}")
    matrix = cohort.cohort_matrix(accounts, rates, products, mapping)
    features = require_rows(materialize(cohort.training_features(matrix), "features"), "cohort matrix")
    store.overwrite(features, "cohort_matrix")
    store.upsert(features, "feature_store_cohort", MATRIX_KEYS)
    store.append(
        maintain.manifest(features, "cohort_matrix", store.path("cohort_matrix"), environment, now), "dataset_versions"
    )
    stamped = {"snapshot_timestamp": _stamp(now), "catalog": F.lit(environment), "schema": F.lit(store.root)}
    store.append(features.withColumns(stamped), "training_feature_snapshots")

    checks = materialize(quality.training_checks(features), "checks")
    store.append(quality.quality_log(checks, now, "training"), "data_quality_results")
    run_id = f"train-{model_name}-{version}"
    log_run(store, run_id, now, checks_failed=checks.filter(~F.col("passed")).count())
    if gate:
        quality.require(checks)

    run = training.train(features, cutoff, last_cohort, grid, offsets)
    evaluated = materialize(evaluate(run, features, cutoff, last_cohort), "evaluated")
    store.append(evaluated.withColumn("evaluated_at", _stamp(now)), "model_eval_metrics")
    named = {"model_name": F.lit(model_name), "model_version": F.lit(str(version))}
    served = materialize(training.served_ratios(run.ratios, run.best).withColumns(named), "served")

    summary = metrics.portfolio_summary(evaluated)
    checked = materialize(validate(store, features, summary, served, model_name, version, cutoff, description), "validation")
    store.append(decide.approval_requests(checked, now), "model_approvals")
    verdict = checked.first()
    passed = "passed" if verdict["validation_passed"] else verdict["rejection_reason"]
    log_run(store, run_id, now, portfolio_mape=verdict["challenger_mape"], validation=passed)
    if not verdict["validation_passed"]:
        rejected = summary.select(
            F.lit(model_name).alias("model_name"), F.lit(version).alias("version"), F.lit(decide.REJECTED).alias("event"),
            _stamp(now).alias("event_ts"), F.col("portfolio_mape").alias("metric"),
        )
        store.append(rejected, "model_versions")
        raise ValueError(f"validation failed: {verdict['rejection_reason']}")
    store.replace(served, "training_ratio_tables")  # what a run that broke off has left under this number goes
    registered = summary.select(
        F.lit(model_name).alias("model_name"), F.lit(version).alias("version"), F.lit(decide.REGISTERED).alias("event"),
        _stamp(now).alias("event_ts"), F.col("portfolio_mape").alias("metric"),
    )
    store.append(registered, "model_versions")
    decision = promote_job(store, model_name, version, cutoff, now, environment, approval)
    log_run(store, run_id, now, promotion=decision["reason"])
    return decision


def ratio_tables(store: Store, model_name: str, version: int | str) -> DataFrame:
    """The stored ratio tables of one version."""
    own = (F.col("model_name") == model_name) & (F.col("model_version") == str(version))
    return store.read("training_ratio_tables").filter(own).drop("model_name")


def validate(
    store: Store, features: DataFrame, summary: DataFrame, served: DataFrame, model_name: str, version: int, cutoff: str,
    description: str,
) -> DataFrame:
    """The gate's row for a trained version against the champion: errors, projected balance since the cut-off, products.

    ``served`` are the version's own ratio tables, which nothing has stored yet. Without a champion its columns are null.
    """
    log = store.read("model_versions").filter(F.col("model_name") == model_name)
    champion = decide.champion_versus_challenger(log).first()
    later = features.filter(F.col("reporting_period") >= F.lit(cutoff).cast("date"))

    def standing(ratios: DataFrame) -> tuple[float | None, int | None]:
        balance = project.score(later, ratios).agg(F.sum("balance_pred").cast("double")).first()[0]
        return balance, ratios.agg(F.countDistinct("product")).first()[0]

    leader = champion["champion_version"] if champion else None
    new_balance, new_products = standing(served)
    old_balance, old_products = None, None
    if leader is not None:
        old_balance, old_products = standing(ratio_tables(store, model_name, leader))
    row = summary.select(
        F.lit(model_name).alias("model_name"),
        F.lit(str(version)).alias("model_version"),
        F.lit(description).alias("description"),
        F.col("portfolio_mape").alias("challenger_mape"),
        F.lit(champion["champion_metric"] if champion else None).cast("double").alias("champion_mape"),
        F.lit(new_balance).cast("double").alias("challenger_balance"),
        F.lit(old_balance).cast("double").alias("champion_balance"),
        F.lit(new_products).cast("long").alias("challenger_products"),
        F.lit(old_products).cast("long").alias("champion_products"),
    )
    return decide.challenger_gate(row)


def promote_job(
    store: Store, model_name: str, version: int, cutoff: str, now: str, environment: str = "dev", approval: bool = True
) -> Row:
    """Decide on the asked version, after its approval where one is asked for. Returns the promotion decision.

    The asked version meets the champion, whatever has been registered since. A version that was never registered, or
    has been turned down, is refused; one that waits for its approval stays as it is.
    """
    log = store.read("model_versions").filter(F.col("model_name") == model_name)
    last = log.filter(F.col("version") == version).groupBy("event").agg(F.max("event_ts").alias("ts"))
    own = {r["event"]: r["ts"] for r in last.collect()}
    if decide.REGISTERED not in own:
        raise ValueError(f"{model_name} has no version {version}")
    if decide.REJECTED in own and own[decide.REJECTED] >= own[decide.REGISTERED]:  # not one before it was trained again
        raise ValueError(f"version {version} of {model_name} was turned down")
    pair = decide.promotion(decide.champion_versus_challenger(log, version))
    if pair.first()["champion_version"] == version:  # nothing to decide
        return pair.withColumn("reason", F.lit("is the champion")).first()
    if approval:
        asked = F.col("request_id") == f"{model_name}-{version}"
        last = decide.latest_approvals(store.read("model_approvals").filter(asked)).first()
        if last is None or last["approval_status"] != decide.APPROVED:
            why = "waiting for approval" if last is None else "turned down"
            pair = pair.withColumn("promoted", F.lit(False)).withColumn("reason", F.lit(why))
            if last is None:
                return pair.first()
    decided = materialize(pair, "decided")
    outcome = decide.decision_events(decided, now).filter(F.col("event") != decide.REGISTERED)
    store.append(outcome, "model_versions")
    decision = decided.first()
    if decision["promoted"]:
        matrix = store.read("cohort_matrix")
        store.append(drift.freeze_baseline(matrix, str(version), now), "reference_feature_snapshot")
        frozen = drift.freeze_histograms(matrix, DRIFT_FEATURES, str(version), now)
        store.replace(frozen.withColumn("model_name", F.lit(model_name)), "reference_feature_histogram")
    card = decided.select(
        "model_name", F.col("challenger_version").cast("string").alias("model_version"), "promoted",
        F.col("reason").alias("promotion_reason"), F.col("challenger_metric").alias("portfolio_mape"),
        F.lit(cutoff).cast("date").alias("cutoff_period"), _stamp(now).alias("trained_at"),
        _stamp(now).alias("card_generated_at"),
    )
    constants = {"framework": "spark", "catalog": environment, "schema": store.root}
    store.append(decide.model_cards(card, constants, MODEL_FEATURES, MODEL_LABELS), "model_cards")
    return decision


def score_job(
    store: Store,
    accounts: DataFrame,
    rates: DataFrame,
    products: DataFrame | None,
    mapping: Mapping[str, str] | None,
    model_name: str,
    now: str,
    gate: bool = True,
) -> str:
    """Score the new months with the champion's ratio tables and append the batch. Returns the served version."""
    log = store.read("model_versions").filter(F.col("model_name") == model_name)
    state = decide.alias_state(log).first()
    if state is None or state["champion_version"] is None:
        raise ValueError(f"{model_name} has no champion")
    version = str(state["champion_version"])
    features = materialize(
        cohort.scoring_features(accounts, rates, store.read("cohort_matrix"), products, mapping), "scoring_features"
    )
    store.upsert(require_rows(features, "scoring features"), "inference_features", MATRIX_KEYS)
    checks = materialize(quality.scoring_checks(features), "checks")
    store.append(quality.quality_log(checks, now, "scoring"), "data_quality_results")
    if gate:
        quality.require(checks)
    ratios = ratio_tables(store, model_name, version)
    scored = project.add_audit(project.score(features, ratios), now, model_name, version, CHAMPION)
    written = materialize(scored, "scored")
    store.append(require_rows(written, "predictions"), "inference_predictions")
    failed = checks.filter(~F.col("passed")).count()
    log_run(store, f"score-{now}", now, served_version=version, n_predictions=written.count(), checks_failed=failed)
    return version


def drift_of_batch(store: Store, batch: DataFrame, model_name: str, version: str, now: str) -> DataFrame:
    """Drift report of the newest batch. A version whose baselines are frozen as histograms is compared with those; one
    from before that, with the rows of the baselines."""
    if not store.exists("reference_prediction_snapshot"):
        seed = drift.baseline_or_seed(None, batch, version, now, DRIFT_PREDICTIONS)
        store.append(seed, "reference_prediction_snapshot")
        frozen = drift.freeze_histograms(batch, DRIFT_PREDICTIONS, version, now)
        store.replace(frozen.withColumn("model_name", F.lit(model_name)), "reference_prediction_histogram")
    features_now = store.read("inference_features")
    own = (F.col("model_name") == model_name) & (F.col("model_version") == version)
    features, predictions = (store.read(f"reference_{side}_histogram").filter(own) for side in ("feature", "prediction"))
    if not features.isEmpty() and not predictions.isEmpty():
        return drift.full_report_frozen(features, features_now, predictions, batch)
    return drift.full_report(
        drift.baseline_for(store.read("reference_feature_snapshot"), version),
        features_now,
        drift.baseline_for(store.read("reference_prediction_snapshot"), version),
        batch,
    )


def monitor_job(store: Store, now: str, guard: bool = True) -> Row:
    """Errors, drift and quality of the newest batch. Returns the retraining decision.

    The first batch of a version without a prediction baseline becomes that baseline.
    """
    predictions = store.read("inference_predictions")
    batch = metrics.latest_batch(predictions)
    latest = materialize(metrics.with_later_actuals(batch, store.read("cohort_matrix")), "latest")
    stamps = {"run_timestamp": F.col("scored_at"), "logged_at": _stamp(now)}
    observed = materialize(metrics.monitoring_metrics(latest, ["product", "scored_at"]).withColumns(stamps), "observed")
    store.append(observed, "monitoring_metrics")

    served = require_rows(latest, "newest batch").select("model_name", "model_version").first()
    report = materialize(drift_of_batch(store, latest, served["model_name"], served["model_version"], now), "drift")
    store.append(report.withColumn("run_timestamp", _stamp(now)), "drift_results")
    decision = monitoring.retraining_decision(report, observed).first()
    run = dict(served_version=served["model_version"], drift_detected=decision["drift_detected"], retrain=decision["retrain"])
    log_run(store, f"monitor-{now}", now, **run, retrain_reason=decision["reason"])
    if guard:
        worst = quality.null_prediction_guard(observed).first()
        if not worst["passed"]:
            raise ValueError(f"share of missing predictions is {worst['max_null_rate']:.2f}")
    return decision
