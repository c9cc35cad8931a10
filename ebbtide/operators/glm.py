"""Many small generalized linear models at once, by iteratively reweighted least squares.

One row per observation carries the keys of its model. An iteration is one grouped aggregation of the normal equations
of every model (combined map-side, so a model of any size is spread over all tasks), and a p x p solve per model.
Observations stay where they are; only the coefficient table, one small row per model, moves between iterations. It is
written to the shared folder each time, so a lost executor never replays earlier iterations.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import families, spline
from ebbtide.operators.prep import RATIO_COLUMNS, WINDOW_KEYS
from ebbtide.session import materialize

OUTFLOW, WITHDRAWAL, RECEIPTS = "outflow", "withdrawal", "receipts"
RESPONSE_COLUMN = {OUTFLOW: "outflow_prop", WITHDRAWAL: "withdrawal_prop_of_outflow", RECEIPTS: "rec_prop"}
SPLINE_TERMS = ("spline_1", "spline_2", "spline_3", "spline_4", "delta_to_best_buy")
LINE_TERMS = ("intercept", "delta_to_best_buy")
N_TERMS = len(SPLINE_TERMS)
FISHER_STEPS = 3
PATIENCE = 25
ACTIVE, CONVERGED, FAILED, STOPPED = "active", "converged", "failed", "stopped"
_PAIRS = [(i, j) for i in range(N_TERMS) for j in range(i, N_TERMS)]


def model_rows(
    train: DataFrame,
    keys: Sequence[str] = WINDOW_KEYS,
    trimmed: bool = True,
    wanted: Sequence[str] = tuple(RESPONSE_COLUMN),
) -> DataFrame:
    """One row per training row and wanted response the row was not trimmed from, rows without a response included."""
    responses = F.array(
        *[
            F.struct(
                F.lit(name).alias("response"),
                F.col(column).alias("y"),
                (F.col(f"keep_{column}") if trimmed else F.lit(True)).alias("keep"),
            )
            for name, column in RESPONSE_COLUMN.items()
            if name in wanted
        ]
    )
    assert set(RESPONSE_COLUMN.values()) == set(RATIO_COLUMNS)
    return (
        train.select(*keys, "months_since_start", "delta_to_best_buy", F.explode(responses).alias("_r"))
        .filter("_r.keep")
        .select(*keys, "_r.response", "months_since_start", "delta_to_best_buy", "_r.y")
    )


def _usable() -> Column:
    """Complete, and a response its family can take: shares within [0, 1], receipts not below 0."""
    y = F.col("y")
    valid = (y >= 0) & ((F.col("response") == RECEIPTS) | (y <= 1))
    return F.coalesce(valid & F.col("delta_to_best_buy").isNotNull(), F.lit(False))


def model_frames(rows: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Per model: family, knots over all its rows, mean response, used and left-out rows.

    The receipts family is Tweedie when any response is zero or below, gamma otherwise. The collected ages are the
    distinct months of a calendar, not rows.
    """
    nonpositive = F.coalesce(F.bool_or(F.col("y") <= 0), F.lit(False))
    family = F.when(F.first("response") != RECEIPTS, families.BINOMIAL).when(nonpositive, families.TWEEDIE)
    frames = rows.groupBy(*keys, "response").agg(
        F.array_sort(F.collect_set("months_since_start")).alias("ages"),
        family.otherwise(families.GAMMA).alias("family"),
        F.avg(F.when(_usable(), F.col("y"))).alias("y_mean"),
        F.count_if(_usable()).alias("n_used"),
        F.count_if(F.col("y").isNotNull() & ~_usable()).alias("n_left_out"),
    )
    frames = frames.withColumn("knots", spline.knots(F.col("ages"))).drop("ages")
    return frames.withColumn("curve", spline.curvature(F.col("knots")))


def design(rows: DataFrame, frames: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Usable observations with their design columns x1..x5.

    The four spline columns add up to 1 and so contain the intercept. The withdrawal share has an intercept and the
    rate gap only; its other columns are 0, and the pseudo-inverse leaves their coefficients at 0.
    """
    frame = frames.select(*keys, "response", "family", "y_mean", "knots", "curve")
    at = rows.filter(_usable()).join(frame, [*keys, "response"])
    line = F.col("response") == WITHDRAWAL
    gap, age = F.col("delta_to_best_buy"), F.col("months_since_start")
    at = spline.place(at, age, F.col("knots"))
    curved = [*spline.basis(age, F.col("curve")), gap]
    straight = [F.lit(1.0), gap, F.lit(0.0), F.lit(0.0), F.lit(0.0)]
    xs = [F.when(line, s).otherwise(c).alias(f"x{i + 1}") for i, (s, c) in enumerate(zip(straight, curved))]
    return at.select(*keys, "response", "family", "y_mean", "y", *xs)


def _matrix_udfs():
    """The per-model linear algebra, on Arrow batches of models.

    Nested, so that the functions travel to the workers by value and need no package installed there.
    """
    size, pairs = N_TERMS, list(_PAIRS)

    def symmetric(upper: np.ndarray) -> np.ndarray:
        full = np.zeros((len(upper), size, size))
        for at, (i, j) in enumerate(pairs):
            full[:, i, j] = full[:, j, i] = upper[:, at]
        return full

    def solve(xtwx: pd.Series, xtwz: pd.Series) -> pd.Series:
        """Least-norm solution of the normal equations; NaN where they are not finite."""
        upper, right = np.stack(xtwx.to_numpy()), np.stack(xtwz.to_numpy())
        solved = np.full(right.shape, np.nan)
        finite = np.isfinite(upper).all(axis=1) & np.isfinite(right).all(axis=1)
        if finite.any():
            inverse = np.linalg.pinv(symmetric(upper[finite]), hermitian=True)
            solved[finite] = np.einsum("gij,gj->gi", inverse, right[finite])
        return pd.Series(list(solved))

    def robust(bread: pd.Series, meat: pd.Series) -> pd.Series:
        """Square roots of the diagonal of bread^-1 meat bread^-1."""
        inverse = np.linalg.pinv(symmetric(np.stack(bread.to_numpy())), hermitian=True)
        covariance = inverse @ symmetric(np.stack(meat.to_numpy())) @ inverse
        return pd.Series(list(np.sqrt(np.maximum(np.einsum("gii->gi", covariance), 0.0))))

    doubles = T.ArrayType(T.DoubleType())
    return F.pandas_udf(solve, doubles), F.pandas_udf(robust, doubles)


_solve, _robust_errors = _matrix_udfs()


def _linear_predictor(beta: Column) -> Column:
    eta = F.lit(0.0)
    for i in range(N_TERMS):
        eta = eta + F.col(f"x{i + 1}") * beta[i]
    return eta


def _products(weight: Column) -> Column:
    return F.array(*[F.sum(weight * F.col(f"x{i + 1}") * F.col(f"x{j + 1}")) for i, j in _PAIRS])


def _normal_equations(obs: DataFrame, eta: Column, keys: Sequence[str], newton: bool = False) -> DataFrame:
    """One aggregated row per model: X'WX, X'Wz and the deviance at ``eta``.

    The weights are the expected curvature (Fisher scoring) or the observed one (Newton). Only sums are aggregated, so
    that they are hashed; an array carried through would have all observations sorted first.
    """
    family, y, mu = F.col("family"), F.col("y"), F.col("mu")
    weight = families.newton_weight(family, y, mu) if newton else families.working_weight(family, mu)
    worked = (
        obs.withColumn("eta", eta)
        .withColumn("mu", families.mean_of(family, F.col("eta")))
        .withColumn("w", weight)
        .withColumn("z", F.col("eta") + families.score(family, y, mu) / F.col("w"))
        .withColumn("d", families.deviance(family, y, mu))
    )
    return worked.groupBy(*keys).agg(
        _products(F.col("w")).alias("xtwx"),
        F.array(*[F.sum(F.col("w") * F.col(f"x{i + 1}") * F.col("z")) for i in range(N_TERMS)]).alias("xtwz"),
        F.sum("d").alias("deviance"),
    )


def fit(obs: DataFrame, keys: Sequence[str], max_iterations: int = 100, tolerance: float = 1e-7) -> DataFrame:
    """Coefficients of every model: ``beta``, ``deviance``, ``iterations``, ``status``.

    ``obs`` is read once per iteration, so pass a written or cached table. Runs one job per iteration. The first
    ``FISHER_STEPS`` iterations are Fisher scoring, which is safe from afar; then Newton, which squares the error in
    each step, so coefficients that moved by 1e-7 are good to some 1e-13. A model leaves the loop when its
    coefficients settle or its equations stop being finite. Coefficients along a flat direction may never settle: after
    ``PATIENCE`` iterations a settled deviance is enough. A model that has not settled at the end is ``STOPPED``; the
    ratio tables take settled ones only.
    """
    keys = list(keys)
    finite = ~F.exists("beta", lambda b: F.isnan(b) | b.isNull())

    def advance(equations: DataFrame, iteration: int, settled: Column) -> tuple[DataFrame, int]:
        status = (
            F.when(~finite, FAILED)
            .when(settled, CONVERGED)
            .otherwise(F.lit(ACTIVE if iteration < max_iterations else STOPPED))
        )
        state = equations.withColumn("beta", _solve("xtwx", "xtwz")).select(
            *keys, "beta", "deviance", F.lit(iteration).alias("iterations"), status.alias("status")
        )
        seen = Observation()
        written = materialize(state.observe(seen, F.count_if(F.col("status") == ACTIVE).alias("active")), "glm")
        return written, seen.get["active"]

    start = families.starting_eta(F.col("family"), F.col("y"), F.col("y_mean"))
    state, active = advance(_normal_equations(obs, start, keys), 1, F.lit(False))
    done = [state.filter(F.col("status") != ACTIVE)]
    iteration = 1
    while active:
        iteration += 1
        known = state.filter(F.col("status") == ACTIVE).select(
            *keys, F.col("beta").alias("_beta"), F.col("deviance").alias("_before")
        )
        at = obs.join(known.drop("_before"), keys)
        equations = _normal_equations(at, _linear_predictor(F.col("_beta")), keys, iteration > FISHER_STEPS)
        equations = equations.join(known, keys)  # one row per model on either side
        moved = F.array_max(F.zip_with("beta", "_beta", lambda b, a: F.abs(b - a) / (F.abs(a) + 0.1)))
        settled = moved <= tolerance
        if iteration > PATIENCE:
            settled |= F.abs(F.col("deviance") - F.col("_before")) <= 1e-10 * (F.abs("deviance") + 0.1)
        state, active = advance(equations, iteration, settled)
        done.append(state.filter(F.col("status") != ACTIVE))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def robust_errors(obs: DataFrame, models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """HC0 standard errors, an array beside ``beta``."""
    keys = list(keys)
    family, y, mu = F.col("family"), F.col("y"), F.col("mu")
    at = (
        obs.join(models.filter(F.col("status") != FAILED).select(*keys, "beta"), keys)
        .withColumn("mu", families.mean_of(family, _linear_predictor(F.col("beta"))))
        .withColumn("w", families.working_weight(family, mu))
        .withColumn("s", families.score(family, y, mu))
    )
    sums = at.groupBy(*keys).agg(
        _products(F.col("w")).alias("bread"), _products(F.col("s") * F.col("s")).alias("meat")
    )
    return models.join(sums.select(*keys, _robust_errors("bread", "meat").alias("se_hc0")), keys, "left")


def coefficient_table(models: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Long form: one row per model and term."""
    errors = F.col("se_hc0") if "se_hc0" in models.columns else F.lit(None).cast("array<double>")

    def terms(names: Sequence[str]) -> Column:
        return F.array(
            *[
                F.struct(F.lit(n).alias("term"), F.col("beta")[i].alias("coef"), errors[i].alias("se_hc0"))
                for i, n in enumerate(names)
            ]
        )

    chosen = F.when(F.col("response") == WITHDRAWAL, terms(LINE_TERMS)).otherwise(terms(SPLINE_TERMS))
    return models.select(*keys, "response", F.explode(chosen).alias("_t"), "status").select(
        *keys, "response", "_t.*", "status"
    )


def fit_responses(
    train: DataFrame,
    keys: Sequence[str] = WINDOW_KEYS,
    robust: bool = False,
    trimmed: bool = True,
    wanted: Sequence[str] = tuple(RESPONSE_COLUMN),
) -> DataFrame:
    """Fit the wanted models of every key: frames (family, knots) with coefficients beside them.

    ``train`` holds the training rows with their ``keep_`` flags; pass a written table, since it is read twice.
    """
    keys = list(keys)
    rows = model_rows(train, keys, trimmed, wanted)
    frames = materialize(model_frames(rows, keys), "model_frames")
    obs = materialize(design(rows, frames, keys), "design")
    models = fit(obs, [*keys, "response"])
    if robust:
        models = robust_errors(obs, models, [*keys, "response"])
    return materialize(frames.join(models, [*keys, "response"], "left"), "models")
