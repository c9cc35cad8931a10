"""Train, score, monitor and retrain over stored tables, on the smallest sample."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import decide
from ebbtide.plans import jobs
from ebbtide.session import materialize
from ebbtide.sources import sample_views as views
from ebbtide.sources.store import Store

SF_DIR = "/root/testdata/sf0.001"


def test_three_jobs(spark, folder):
    store = Store(spark, folder)
    accounts = materialize(views.account_month(spark, SF_DIR), "accounts")
    rates = materialize(views.best_buy(accounts), "rates")
    until = F.lit("2001-01-01").cast("date")
    known, later = accounts.filter(F.col("reporting_period") < until), accounts.filter(F.col("reporting_period") >= until)

    with pytest.raises(ValueError, match="no champion"):
        jobs.score_job(store, later, rates, None, None, "m", "2001-01-02 00:00:00")

    settings = dict(cutoff="2000-01-01", last_cohort="1999-12-01", model_name="m", grid=((48, True), (60, True)), offsets=(6,), gate=False)
    first = jobs.train_job(store, known, rates, None, None, version=1, now="2001-01-01 00:00:00", **settings)
    assert first["promoted"] and first["reason"] == "no champion yet"
    assert store.read("data_quality_results").filter("NOT passed").count() > 0
    with pytest.raises(ValueError, match="failed checks"):
        jobs.train_job(Store(spark, folder + "/gated"), known, rates, None, None, version=1, now="2001-01-01 00:00:00", **{**settings, "gate": True})

    assert jobs.score_job(store, later, rates, None, None, "m", "2001-02-01 00:00:00", gate=False) == "1"
    scored = store.read("inference_predictions")
    assert scored.count() > 0 and scored.filter("balance_pred IS NULL").count() < 0.5 * scored.count()
    decision = jobs.monitor_job(store, "2001-02-02 00:00:00")
    assert decision["retrain"] in (True, False) and decision["reason"]
    drifted = {(r.drift_type, r.feature): r for r in store.read("drift_results").collect()}
    assert len(drifted) == 10 and drifted[("prediction", "balance_pred")].psi == pytest.approx(0.0, abs=1e-9)

    second = jobs.train_job(store, known, rates, None, None, version=2, now="2001-03-01 00:00:00", **settings)
    assert not second["promoted"] and second["improvement_pct"] == pytest.approx(0.0, abs=1e-9)
    events = {(r.version, r.event) for r in store.read("model_versions").collect()}
    assert events == {(1, "registered"), (1, "promoted"), (2, "registered"), (2, "rejected")}
    assert {r.model_version for r in store.read("reference_feature_snapshot").select("model_version").distinct().collect()} == {"1"}
    assert store.read("model_cards").count() == 2 and store.read("dataset_versions").select("content_hash").distinct().count() == 1
    matrix = store.read("cohort_matrix")
    assert store.read("feature_store_cohort").count() == matrix.count() > 0
    assert store.read("training_feature_snapshots").count() == 2 * matrix.count()

    assert {(r.request_id, r.approval_status) for r in store.read("model_approvals").collect()} == {("m-1", "PENDING"), ("m-2", "PENDING")}
    with pytest.raises(ValueError, match="has_description"):
        jobs.train_job(store, known, rates, None, None, version=3, now="2001-04-01 00:00:00", description=" ", **settings)
    third = {r.event for r in store.read("model_versions").filter("version = 3").collect()}
    assert third == {"rejected"}
    refused = store.read("model_approvals").filter("model_version = '3'").first()
    assert refused.approval_status == "REJECTED" and refused.checks_passed["coverage_passed"]

    other = {**settings, "model_name": "n"}
    waiting = jobs.train_job(store, known, rates, None, None, version=1, now="2001-05-01 00:00:00", approval=True, **other)
    assert not waiting["promoted"] and waiting["reason"] == "waiting for approval"
    pending = store.read("model_approvals").filter("model_name = 'n'").withColumn("decision_id", F.lit(1).cast("long"))
    store.append(materialize(decide.decision_rows(pending, "approved", "someone", "2001-05-02 00:00:00"), "decided"), "model_approvals")
    assert jobs.promote_job(store, "n", 1, "2000-01-01", "2001-05-03 00:00:00")["promoted"]
    assert jobs.promote_job(store, "n", 1, "2000-01-01", "2001-05-04 00:00:00")["champion_version"] == 1


def test_only_the_asked_version_is_promoted(spark, folder):
    """Version 2 is approved and 3 waits: promoting 2 must not touch 3; what was turned down or never registered is refused."""
    store = Store(spark, folder)
    log = [("m", 1, "registered", "2001-01-01 00:00:00", 9.0), ("m", 1, "promoted", "2001-01-01 00:00:01", 9.0)]
    log += [("m", 2, "registered", "2001-02-01 00:00:00", 5.0), ("m", 3, "registered", "2001-03-01 00:00:00", 4.0)]
    log += [("m", 4, "rejected", "2001-04-01 00:00:00", 99.0), ("m", 5, "registered", "2001-05-01 00:00:00", 1.0)]
    rows = spark.createDataFrame(log, "model_name string, version int, event string, event_ts string, metric double")
    store.append(rows, "model_versions")
    asked = [("m-2", 0, "PENDING", "2001-02-01 00:00:00"), ("m-3", 0, "PENDING", "2001-03-01 00:00:00"), ("m-2", 1, "APPROVED", "2001-03-02 00:00:00"), ("m-5", 1, "REJECTED", "2001-05-02 00:00:00")]
    store.append(spark.createDataFrame(asked, "request_id string, decision_id long, approval_status string, approval_ts string"), "model_approvals")
    matrix = [("2000-01-01", "P", 3, 0.01, 0.02, 0.01, 12.0, 5)]
    columns = "cohort string, product string, months_since_start int, int_rate double, best_buy double, delta_to_best_buy double, tenure_months double, n_accounts long"
    store.overwrite(spark.createDataFrame(matrix, columns), "cohort_matrix")

    promoted = jobs.promote_job(store, "m", 2, "2001-01-01", "2001-06-01 00:00:00")
    assert promoted["promoted"] and promoted["challenger_version"] == 2
    events = {(r.version, r.event) for r in store.read("model_versions").filter("event_ts >= '2001-06-01'").collect()}
    assert events == {(2, "promoted")}
    assert {r.model_version for r in store.read("reference_feature_snapshot").collect()} == {"2"}
    assert {(r.model_version, r.promoted) for r in store.read("model_cards").collect()} == {("2", True)}

    waiting = jobs.promote_job(store, "m", 3, "2001-01-01", "2001-07-01 00:00:00")
    assert not waiting["promoted"] and waiting["reason"] == "waiting for approval"
    assert not jobs.promote_job(store, "m", 5, "2001-01-01", "2001-07-02 00:00:00")["promoted"]
    for version, why in ((4, "no version"), (6, "no version"), (5, "turned down")):
        with pytest.raises(ValueError, match=why):
            jobs.promote_job(store, "m", version, "2001-01-01", "2001-08-01 00:00:00")
    again = jobs.promote_job(store, "m", 2, "2001-01-01", "2001-09-01 00:00:00")
    assert again["champion_version"] == 2 and again["reason"] == "is the champion"
    assert store.read("model_versions").filter("event_ts >= '2001-07-01'").select("version", "event").collect() == [(5, "rejected")]


def test_ratios_are_stored_once_and_after_the_gate(spark, folder):
    store = Store(spark, folder)
    accounts = materialize(views.account_month(spark, SF_DIR), "accounts")
    rates = materialize(views.best_buy(accounts), "rates")
    known = accounts.filter(F.col("reporting_period") < F.lit("2001-01-01").cast("date"))
    settings = dict(cutoff="2000-01-01", last_cohort="1999-12-01", model_name="m", grid=((48, True),), offsets=(6,), gate=False)
    with pytest.raises(ValueError, match="has_description"):
        jobs.train_job(store, known, rates, None, None, version=1, now="2001-01-01 00:00:00", description="", **settings)
    assert not store.exists("training_ratio_tables")
    # a run that broke off before it registered its version has left ratios behind
    left = spark.createDataFrame([("P", "m", "1", 3, 0), ("P", "n", "1", 3, 0)], "product string, model_name string, model_version string, months_since_start int, bin_id int")
    store.append(left, "training_ratio_tables")
    jobs.train_job(store, known, rates, None, None, version=1, now="2001-01-02 00:00:00", **settings)
    stored = store.read("training_ratio_tables")
    keys = ["product", "model_name", "model_version", "months_since_start", "bin_id"]
    assert stored.filter("model_name = 'm'").count() > 100 and stored.groupBy(*keys).count().filter("count > 1").isEmpty()
    assert stored.filter("model_name = 'm' AND product = 'P'").isEmpty() and stored.filter("model_name = 'n'").count() == 1
    with pytest.raises(ValueError, match="has a version 1"):
        jobs.train_job(store, known, rates, None, None, version=1, now="2001-01-03 00:00:00", **settings)
    runs = {r.run_id: r for r in jobs.run_report(store).collect()}
    assert set(runs) == {"train-m-1"}
    assert runs["train-m-1"].validation == "passed" and runs["train-m-1"].promotion == "no champion yet"
    assert float(runs["train-m-1"].portfolio_mape) > 0 and runs["train-m-1"].retrain == jobs.NOT_REPORTED
    with pytest.raises(ValueError, match="unknown results"):
        jobs.log_run(store, "r", "2001-01-03 00:00:00", other=1)
