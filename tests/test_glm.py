from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from ebbtide.functions import spline
from ebbtide.functions.ratios import rate_label
from ebbtide.operators import glm, prep, ratio_tables

KEYS = ["product"]
TRAIN = (
    "product string, months_since_start int, delta_to_best_buy double, rec_prop double, outflow_prop double, "
    "withdrawal_prop_of_outflow double, bin_id int"
)


def training_rows(spark, zero_receipts=False, n=240):
    rng = np.random.default_rng(7)
    rows = []
    for product, shift in (("A", 0.0), ("B", 0.4)):
        for i in range(n):
            age, gap = int(i % 30) + 1, float(rng.uniform(-1, 0.1))
            receipt = float(np.exp(-2 - 0.02 * age + 0.5 * gap + shift) * rng.gamma(5, 0.2))
            share = float(rng.beta(4, 8 + 4 * shift))
            rows.append((product, age, gap, 0.0 if zero_receipts and i % 17 == 0 else receipt, share, float(rng.uniform()), 3))
    rows.append(("A", 5, -0.1, None, 1.4, None, 3))
    return spark.createDataFrame(rows, TRAIN)


def fitted(spark, zero_receipts=False):
    train = training_rows(spark, zero_receipts)
    return train, glm.fit_responses(train, KEYS, robust=True, trimmed=False)


@pytest.mark.parametrize("zero_receipts", [False, True])
def test_against_the_ml_library(spark, zero_receipts):
    train, models = fitted(spark, zero_receipts)
    assert {r.status for r in models.collect()} == {glm.CONVERGED}
    families = {r.family for r in models.filter(F.col("response") == glm.RECEIPTS).collect()}
    assert families == {"tweedie" if zero_receipts else "gamma"}
    rows = glm.model_rows(train, KEYS, trimmed=False)
    obs = glm.design(rows, glm.model_frames(rows, KEYS), KEYS)
    for model in models.collect():
        line = model.response == glm.WITHDRAWAL
        columns = ["x2"] if line else ["x1", "x2", "x3", "x4", "x5"]
        data = VectorAssembler(inputCols=columns, outputCol="x").transform(
            obs.filter((F.col("product") == model["product"]) & (F.col("response") == model.response))
        )
        settings = {"family": model.family, "link": "log"}
        if model.family == "binomial":
            settings["link"] = "logit"
        if model.family == "tweedie":
            settings = {"family": "tweedie", "variancePower": 1.5, "linkPower": 0.0}
        other = GeneralizedLinearRegression(
            featuresCol="x", labelCol="y", fitIntercept=line, maxIter=60, tol=1e-12, **settings
        ).fit(data)
        expected = [other.intercept, *other.coefficients] if line else list(other.coefficients)
        np.testing.assert_allclose(model.beta[: len(expected)], expected, rtol=1e-6, atol=1e-7)


def test_robust_errors_against_numpy(spark):
    train, models = fitted(spark)
    (model,) = models.filter((F.col("product") == "A") & (F.col("response") == glm.OUTFLOW)).collect()
    rows = glm.model_rows(train, KEYS, trimmed=False)
    obs = glm.design(rows, glm.model_frames(rows, KEYS), KEYS)
    data = obs.filter((F.col("product") == "A") & (F.col("response") == glm.OUTFLOW)).toPandas()
    x, y = data[["x1", "x2", "x3", "x4", "x5"]].to_numpy(), data["y"].to_numpy()
    mu = 1 / (1 + np.exp(-x @ np.array(model.beta)))
    bread = np.linalg.inv(x.T @ (x * (mu * (1 - mu))[:, None]))
    meat = x.T @ (x * ((y - mu) ** 2)[:, None])
    np.testing.assert_allclose(model.se_hc0, np.sqrt(np.diag(bread @ meat @ bread)), rtol=1e-8)
    assert (model.n_used, model.n_left_out) == (240, 1)


def test_long_table_names_the_terms(spark):
    _, models = fitted(spark)
    table = glm.coefficient_table(models, KEYS)
    assert table.filter("response = 'withdrawal'").count() == 2 * len(glm.LINE_TERMS)
    assert table.filter("response = 'outflow'").count() == 2 * len(glm.SPLINE_TERMS)
    assert table.filter("se_hc0 IS NULL OR coef IS NULL").count() == 0


def test_few_ages_fall_back_to_a_line(spark):
    rng = np.random.default_rng(3)
    rows = [("A", int(a), float(rng.uniform(-1, 0)), float(0.1 * a), float(0.1 * a), 0.5, 3) for a in rng.integers(1, 4, 60)]
    models = glm.fit_responses(spark.createDataFrame(rows, TRAIN), KEYS, trimmed=False)
    (model,) = models.filter(F.col("response") == glm.OUTFLOW).collect()
    assert model.knots is None and model.status == glm.CONVERGED and model.beta[2] == pytest.approx(0, abs=1e-9)


def test_model_without_usable_rows_has_no_coefficients(spark):
    rows = [("A", a, -0.1, 0.1, None, 0.5, 3) for a in range(1, 20)]
    models = glm.fit_responses(spark.createDataFrame(rows, TRAIN), KEYS, trimmed=False)
    assert models.filter((F.col("response") == glm.OUTFLOW) & F.col("beta").isNull()).count() == 1
    assert ratio_tables.models_by_window(models, KEYS).count() == 0


def basis_table(spark, points, ages):
    df = spark.createDataFrame([(float(x),) for x in ages], "x double").withColumn(
        "knots", F.array(*[F.lit(float(p)) for p in points])
    )
    df = spline.place(df.withColumn("curve", spline.curvature(F.col("knots"))), F.col("x"), F.col("knots"))
    rows = df.select("x", *spline.basis(F.col("x"), F.col("curve"))).orderBy("x").collect()
    return np.array([tuple(r) for r in rows])


def test_spline_properties(spark):
    points = (1, 7, 15, 25)
    table = basis_table(spark, points, np.arange(-5, 40, 0.5))
    x, basis = table[:, 0], table[:, 1:]
    np.testing.assert_allclose(basis.sum(axis=1), 1, atol=1e-12)
    np.testing.assert_allclose(basis @ np.array(points), x, atol=1e-10)
    np.testing.assert_allclose(basis[np.isin(x, points)], np.eye(4), atol=1e-12)
    for outside in (x < 1, x > 25):
        np.testing.assert_allclose(np.diff(basis[outside], 2, axis=0), 0, atol=1e-10)


def test_knots_are_thirds_of_the_distinct_ages(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6, 7],), ([1, 2, 4, 9, 30],), ([1, 2, 3],)], "a array<int>")
    got = [r.k for r in df.select(spline.knots(F.col("a")).alias("k")).collect()]
    assert got[0] == [1, 3, 5, 7]
    np.testing.assert_allclose(got[1], [1, *np.quantile([1, 2, 4, 9, 30], [1 / 3, 2 / 3]), 30])
    assert got[2] is None


def test_grid_and_pivot(spark):
    train, models = fitted(spark)
    reps = ratio_tables.representative_deltas(train, KEYS)
    windows = ratio_tables.models_by_window(models, KEYS).join(reps, KEYS).withColumn("month_end", F.lit(12))
    grid = ratio_tables.composites(ratio_tables.predict_grid(ratio_tables.grid_rows(windows), clip_age=True))
    assert grid.count() == 2 * 11 * 11
    bad = "rec_pct < 0 OR outflow_pred NOT BETWEEN 0 AND 1 OR transfer_pct NOT BETWEEN 0 AND 100 OR rec_pct IS NULL"
    assert grid.filter(bad).count() == 0
    wide = ratio_tables.pivot_ratio(grid.withColumn("rate_bin", rate_label(F.col("bin_id"))), "rec_pct", KEYS)
    assert wide.count() == 2 * 11 and len(wide.columns) == 13


def test_outliers_and_windows(spark):
    rows = [("A", f"2024-{m:02d}-01", m, 0.1 + 0.001 * m, None, 9.0 if m == 12 else 0.5) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "product string, p string, months_since_start int, rec_prop double, outflow_prop double, withdrawal_prop_of_outflow double")
    df = df.withColumn("reporting_period", F.to_date("p"))
    flags = {r.months_since_start: r for r in prep.outlier_flags(df).collect()}
    assert not flags[12].keep_withdrawal_prop_of_outflow and flags[12].keep_outflow_prop
    assert all(flags[m].keep_rec_prop for m in flags)
    parts = prep.split(df, "2024-07-01", drop_month2=True)
    assert parts.filter("is_train").count() == 5 and parts.filter("is_test").count() == 6
    assert prep.split(df, "2024-07-01").filter("is_train").count() == 6
    sizes = {(r.window_id, r.drop_month2): r["count"] for r in prep.training_windows(df, "2024-07-01", (3,)).groupBy("window_id", "drop_month2").count().collect()}
    assert sizes == {(0, True): 5, (0, False): 6, (1, True): 2, (1, False): 3}
