from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.constants import PSI_ALERT, PSI_WARN
from ebbtide.operators import drift


def frame(spark, **columns):
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def plain_psi(reference, current, buckets=10):
    edges = np.unique(np.quantile(reference, np.linspace(0, 1, buckets + 1)))
    shares = []
    for side in (reference, current):
        counts, _ = np.histogram(side, bins=edges)
        shares.append([c / counts.sum() if c else 1e-4 for c in counts])
    return sum((c - r) * np.log(c / r) for r, c in zip(*shares))


def psi_of(spark, reference, current):
    return drift.psi(frame(spark, x=reference), frame(spark, x=current), ["x"]).first().psi


def test_identical_is_zero(spark):
    s = np.random.default_rng(1).normal(size=1000)
    assert psi_of(spark, s, s) == pytest.approx(0.0, abs=1e-12)


def test_shift_is_an_alert(spark):
    rng = np.random.default_rng(2)
    assert psi_of(spark, rng.normal(size=500), rng.normal(5, 1, size=500)) > PSI_ALERT


@pytest.mark.parametrize("seed", range(3))
def test_agrees_with_a_plain_computation(spark, seed):
    rng = np.random.default_rng(seed)
    reference, current = rng.normal(size=700).round(seed), rng.normal(0.3, 1.2, size=400).round(seed)
    assert psi_of(spark, reference, current) == pytest.approx(plain_psi(reference, current), abs=1e-12)


def test_empty_and_constant_sides(spark):
    reference = frame(spark, a=[1, 2, 3], b=[4, 4, 4], c=[None] * 3, d=[1, 2, 3])
    current = frame(spark, a=[1, 2, 3], b=[4, 5, 6], c=[1, 2, 3], d=[None] * 3)
    got = {r.feature: (r.psi, r.status) for r in drift.drift_report(reference, current, ["a", "b", "c", "d"]).collect()}
    assert got["a"][1] == "OK"
    assert got["b"] == (0.0, "OK")
    assert got["c"] == (None, "NO_DATA")
    assert got["d"] == (None, "NO_DATA")


@pytest.mark.parametrize("value, status", [(0.0999, "OK"), (PSI_WARN, "WARN"), (0.2, "WARN"), (PSI_ALERT, "ALERT"), (None, "NO_DATA")])
def test_bands(spark, value, status):
    assert spark.createDataFrame([(value,)], "v double").select(drift.status_band(F.col("v")).alias("s")).first().s == status


def test_extrapolation(spark):
    reference = frame(spark, g=[0, 1, None])
    few = frame(spark, g=[0.5] * 95 + [2.0] * 5)
    many = frame(spark, g=[0.5] * 94 + [2.0] * 3 + [-1.0] * 3 + [None])
    assert drift.extrapolation_report(reference, few, "g").first().status == "OK"
    row = drift.extrapolation_report(reference, many, "g").first()
    assert (row.status, row.out_of_range_rate, row.ref_min, row.ref_max) == ("ALERT", 0.06, 0.0, 1.0)
    assert drift.extrapolation_report(reference, frame(spark, g=[None]), "g").first().status == "NO_DATA"


def test_alert_summary(spark):
    report = spark.createDataFrame(
        [("feature", "a", 0.3, "ALERT"), ("feature", "b", 0.1, "WARN"), ("prediction", "c", 0.5, "ALERT")],
        "drift_type string, feature string, psi double, status string",
    )
    row = drift.alert_summary(report).first()
    assert row.drift_detected and row.alerts == {"feature::a": 0.3, "prediction::c": 0.5} and row.max_value == 0.5
    assert drift.alert_summary(report.filter("status = 'WARN'")).first().drift_detected is False


def test_baseline_choice(spark):
    rows = [(1.0, "1", "2024-01-01"), (2.0, "2", "2024-02-01")]
    table = spark.createDataFrame(rows, "x double, model_version string, f string").select(
        "x", "model_version", F.to_timestamp("f").alias("baseline_frozen_at")
    )
    assert [r.x for r in drift.baseline_for(table, "1").collect()] == [1.0]
    assert [r.x for r in drift.baseline_for(table, "9").collect()] == [2.0]
    assert drift.baseline_for(table.select("x"), "9").count() == 2
    seeded = drift.baseline_or_seed(None, table.select("x"), "5", "2024-03-01 00:00:00", ["x"])
    assert {r.model_version for r in seeded.collect()} == {"5"}


def test_frozen_histograms_give_the_same_report(spark):
    rng = np.random.default_rng(11)
    columns = ["int_rate", "best_buy", "delta_to_best_buy", "flat", "empty"]

    def side(n, shift):
        values = np.stack([rng.normal(shift, 1, n), rng.integers(0, 3, n), rng.normal(0, 1 + shift, n).round(1), np.full(n, 2.0)], axis=1)
        rows = [(*[float(v) for v in r], None) for r in values] + [(None, float("nan"), None, None, None)]
        return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))

    reference, current = side(4000, 0.0), side(900, 0.4)
    frozen = drift.freeze_histograms(reference, columns, "3", "2024-01-01 00:00:00")
    assert frozen.count() == 4 and frozen.agg(F.max(F.size("counts"))).first()[0] == 10
    sums = {r.feature: (sum(r.counts), r.n) for r in frozen.collect()}
    assert all(b == 4000 and a == (0 if k == "flat" else 4000) for k, (a, b) in sums.items())

    def rows_of(report):
        return {(r.drift_type, r.feature): (r.psi, r.status, r.out_of_range_rate, r.ref_min, r.ref_max) for r in report.collect()}

    for now in (current, current.limit(0), reference):
        raw = rows_of(drift.full_report(reference, now, reference, now, columns, columns[:2]))
        from_frozen = rows_of(drift.full_report_frozen(frozen, now, frozen, now, columns, columns[:2]))
        assert raw == from_frozen and len(raw) == 8
