from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ebbtide import constants
from ebbtide.functions.errors import mape, rmse, zero_actuals
from ebbtide.operators import decide, metrics, quality
from ebbtide.operators.upsert import assert_unique, keyed_upsert, repeated_keys


def checks(df, **kwargs):
    return {r.check_name: r for r in quality.quality_checks(df, **kwargs).collect()}


@pytest.fixture
def small(spark):
    return spark.createDataFrame(
        [("2023-01", "P", 10.0, 0.5), ("2023-02", None, None, 1.5)], "cohort string, product string, balance double, outflow_prop double"
    )


def test_thresholds_are_ordered():
    assert 0 < constants.PSI_WARN < constants.PSI_ALERT
    assert constants.RETRAIN_NULL_RATE > 0 and constants.RETRAIN_MAPE > 0
    assert constants.PROMOTION_MIN_IMPROVEMENT_PCT > 0


@pytest.mark.parametrize("least, passed", [(2, True), (3, False)])
def test_row_count(small, least, passed):
    assert checks(small, min_rows=least)["row_count"].passed is passed


def test_null_rates(small):
    got = checks(small, null_checked=["cohort", "balance"], max_null_rate=0.05)
    assert got["null_rate::cohort"].passed and not got["null_rate::balance"].passed
    assert got["null_rate::balance"].detail == "50.00% null (threshold 5%)"
    assert not checks(small.limit(0), null_checked=["balance"], max_null_rate=0.05)["null_rate::balance"].passed


def test_value_range(small):
    assert not checks(small, ranges={"outflow_prop": (0.0, 1.0)})["value_range::outflow_prop"].passed
    row = checks(small, ranges={"balance": (0.0, 10.0)})["value_range::balance"]
    assert row.passed and row.detail == "0 rows outside [0.0, 10.0]"


def test_schema_and_coverage(small):
    got = checks(small, required=["cohort", "missing"], coverage=("product", 2), null_checked=["missing"])
    assert not got["schema_columns"].passed and "missing" in got["schema_columns"].detail
    assert not got["product_coverage"].passed and "null_rate::missing" not in got


def test_verdict(small):
    rows = quality.quality_checks(small, min_rows=3, ranges={"outflow_prop": (0.0, 1.0)})
    verdict = quality.all_passed(rows).first()
    assert not verdict.passed and verdict.failures == ["row_count", "value_range::outflow_prop"]
    with pytest.raises(ValueError, match="row_count"):
        quality.require(rows)
    quality.require(quality.quality_checks(small, min_rows=1))


def test_null_prediction_guard(spark):
    df = spark.createDataFrame([("A", 0.1), ("B", 0.5)], "product string, null_prediction_rate double")
    assert quality.null_prediction_guard(df).first().passed is False
    assert quality.null_prediction_guard(df.filter("product = 'A'")).first().passed is True


@pytest.mark.parametrize(
    "drift, nulls, error, retrain, reason",
    [
        (True, 0.0, None, True, "PSI alert detected"),
        (False, 0.11, 3.0, True, "Null prediction rate 11.00% > threshold 10.00%"),
        (False, 0.0, 21.0, True, "Portfolio MAPE 21.00 > threshold 20.00"),
        (True, 0.2, 30.0, True, "PSI alert detected; Null prediction rate 20.00% > threshold 10.00%; Portfolio MAPE 30.00 > threshold 20.00"),
        (False, 0.1, 20.0, False, "No retraining trigger crossed"),
        (None, None, None, False, "No retraining trigger crossed"),
    ],
)
def test_retraining(spark, drift, nulls, error, retrain, reason):
    row = spark.createDataFrame([(drift, nulls, error)], "drift_detected boolean, max_null_rate double, portfolio_mape double")
    got = decide.retraining_need(row).first()
    assert (got.retrain, got.reason) == (retrain, reason)


@pytest.mark.parametrize(
    "version, old, new, promoted",
    [(None, None, 9.0, True), (1, None, 9.0, True), (1, 0.0, 9.0, True), (1, 10.0, 8.5, True), (1, 10.0, 8.6, False), (1, 10.0, None, False)],
)
def test_promotion(spark, version, old, new, promoted):
    row = spark.createDataFrame([(version, old, new)], "champion_version int, champion_metric double, challenger_metric double")
    assert decide.promotion(row).first().promoted is promoted


def test_promotion_where_higher_is_better(spark):
    row = spark.createDataFrame([(1, 10.0, 12.0)], "champion_version int, champion_metric double, challenger_metric double")
    assert decide.promotion(row, lower_is_better=False).first().promoted is True


def test_challenger_gate(spark):
    schema = (
        "description string, champion_mape double, challenger_mape double, champion_balance double, "
        "challenger_balance double, champion_products int, challenger_products int"
    )
    rows = [("d", 10.0, 10.5, 100.0, 130.0, 5, 5), (" ", 10.0, 10.6, 100.0, 69.0, 5, 4), ("d", None, 50.0, None, 1.0, None, 1)]
    good, bad, first = decide.challenger_gate(spark.createDataFrame(rows, schema)).collect()
    assert good.validation_passed and good.rejection_reason == ""
    assert bad.rejection_reason == "has_description, mape_passed, business_metric_passed, coverage_passed"
    assert first.validation_passed


def version_log(spark, rows):
    return spark.createDataFrame(rows, "model_name string, version int, event string, t string, metric double").withColumn(
        "event_ts", F.to_timestamp("t")
    )


def test_version_log(spark):
    log = version_log(
        spark,
        [
            ("m", 1, "registered", "2024-01-01", 9.0), ("m", 1, "promoted", "2024-01-02", 9.0),
            ("m", 2, "registered", "2024-02-01", 8.0), ("m", 2, "rejected", "2024-02-02", 8.0),
            ("m", 3, "registered", "2024-03-01", 5.0), ("m", 3, "promoted", "2024-03-02", 5.0),
            ("m", 4, "registered", "2024-04-01", 6.0), ("m", 5, "registered", "2024-05-01", 4.0),
            ("n", 1, "registered", "2024-01-01", 1.0),
        ],
    )
    state = {r.model_name: r for r in decide.alias_state(log).collect()}
    assert (state["m"].baseline_version, state["m"].challenger_version, state["m"].champion_version) == (1, 5, 3)
    assert state["n"].champion_version is None
    stages = {(r.model_name, r.version): (r.stage, r.aliases) for r in decide.version_state(log).collect()}
    assert stages[("m", 1)] == ("retired", "baseline") and stages[("m", 2)][0] == "rejected"
    assert stages[("m", 3)] == ("champion", "champion") and stages[("m", 4)][0] == "archived"
    assert stages[("m", 5)] == ("challenger", "challenger")
    assert stages[("n", 1)] == ("challenger", "baseline, challenger")
    assert [tuple(r) for r in decide.prior_champion(log).collect()] == [("m", 3, 1)]
    pair = {r.model_name: r for r in decide.promotion(decide.champion_versus_challenger(log)).collect()}
    assert pair["m"].promoted is True and pair["n"].reason == "no champion yet"


def test_approvals(spark):
    rows = [("R", 1, "2024-01-01", "pending", "a"), ("R", 2, "2024-01-02", " approved", "b"), ("R", 3, "2024-01-03", "pending", "c"), ("S", 4, "2024-01-01", "PENDING", "d")]
    log = spark.createDataFrame(rows, "request_id string, decision_id long, t string, approval_status string, approver string").withColumn(
        "approval_ts", F.to_timestamp("t")
    )
    assert [(r.request_id, r.approval_status, r.approver) for r in decide.latest_approvals(log).collect()] == [("R", "APPROVED", "b")]
    row = decide.decision_rows(log.filter("request_id = 'S'"), "rejected ", " x ", "2024-02-01 00:00:00", "too high").first()
    assert (row.approval_status, row.approver, row.rejection_reason) == ("REJECTED", "x", "too high")
    with pytest.raises(ValueError):
        decide.decision_rows(log, "maybe", "x", "2024-02-01 00:00:00")


def test_error_measures(spark):
    df = spark.createDataFrame([(10.0, 10.0), (20.0, 22.0), (0.0, 5.0), (None, 1.0), (1.0, None)], "a double, p double")
    a, p = F.col("a"), F.col("p")
    row = df.agg(mape(a, p).alias("m"), rmse(a, p).alias("r"), zero_actuals(a, p).alias("z")).first()
    assert row.m == pytest.approx(5.0) and row.r == pytest.approx((29 / 3) ** 0.5) and row.z == 1


def test_best_configuration(spark):
    rows = [("A", 0, 5.0, 1.0), ("A", 1, 5.0, 0.5), ("A", 2, float("nan"), 0.1), ("B", 0, None, 1.0), ("B", 1, 7.0, 2.0)]
    trials = spark.createDataFrame(rows, "product string, grid_id int, val_mape double, cv_mape double")
    assert {r["product"]: r.grid_id for r in metrics.best_configuration(trials).collect()} == {"A": 0, "B": 1}
    assert {r["product"]: r.grid_id for r in metrics.best_configuration(trials, "cv_mape").collect()} == {"A": 2, "B": 0}


def test_upsert_and_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "k int, v string, extra int")
    merged = keyed_upsert(old, new, ["k"])
    assert sorted((r.k, r.v, r.extra or 0) for r in merged.collect()) == [(1, "a", 0), (2, "B", 1), (3, "C", 1)]
    assert keyed_upsert(None, new, ["k"]).count() == 2
    assert repeated_keys(old, ["k"]).isEmpty()
    with pytest.raises(ValueError):
        assert_unique(old.union(old.limit(1)), ["k"])
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([(None, "a")], "k int, v string"), ["k"])


def test_best_runs_are_picked_without_a_sort(spark):
    rows = [("a", 7, 2.0), ("a", 3, 2.0), ("a", 1, 2.5), ("a", 0, -1.0), ("b", 5, 1e300), ("b", 2**62, 1e-300), ("c", 4, float("nan")), ("d", 1, 0.0)]
    runs = spark.createDataFrame(rows, "k string, run_id long, metric double")
    best = decide.best_run(runs, ["k"])
    assert {r.k: r.run_id for r in best.collect()} == {"a": 3, "b": 2**62, "c": 4}
    plan = best._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
    named = decide.best_run(runs.withColumn("run_id", F.col("run_id").cast("string")), ["k"])
    assert {r.k: (r.run_id, r.metric) for r in named.filter("k <> 'c'").collect()} == {"a": ("3", 2.0), "b": (str(2**62), 1e-300)}
