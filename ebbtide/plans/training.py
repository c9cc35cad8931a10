"""Matrix -> fits -> ratio tables -> projections -> metrics -> best configuration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import FOLD_OFFSETS, PARAM_GRID
from ebbtide.operators import glm, metrics, prep, project, ratio_tables
from ebbtide.operators.prep import MAIN_WINDOW
from ebbtide.session import materialize

TABLE_KEYS = ("product", "window_id", "grid_id")


@dataclass(frozen=True)
class Training:
    """Written tables of one training run."""

    models: DataFrame
    ratios: DataFrame
    projected: DataFrame
    trials: DataFrame
    best: DataFrame


def project_windows(features: DataFrame, ratios: DataFrame, cutoff: str, offsets: Sequence[int]) -> DataFrame:
    """Project every window's months from its own cut-off on, once per configuration."""
    starts = F.create_map(
        *[x for i, m in enumerate((0, *offsets)) for x in (F.lit(i), F.add_months(F.lit(cutoff).cast("date"), -m))]
    )
    rows = project.lookup_ratios(features, ratios, TABLE_KEYS)
    rows = rows.filter(F.col("reporting_period") >= starts[F.col("window_id")])
    return project.project(rows, ["product", "cohort", "window_id", "grid_id"])


def trial_table(projected: DataFrame, last_cohort: str) -> DataFrame:
    """One row per product and configuration: errors of the main window and the mean error over the folds."""
    flows = metrics.portfolio_flows(project.cohorts_until(projected, last_cohort), [*TABLE_KEYS, "reporting_period"])
    scored = metrics.error_metrics(flows, TABLE_KEYS)
    main = F.col("window_id") == MAIN_WINDOW
    named = {"val_mape": "mape_balance", "val_rmse": "rmse_balance"}
    return scored.groupBy("product", "grid_id").agg(
        *[F.max(F.when(main, F.col(c))).alias(name) for name, c in named.items()],
        F.avg(F.when(~main, F.col("mape_balance"))).alias("cv_mape"),
        F.count_if(~main & F.col("mape_balance").isNotNull()).alias("n_folds"),
    )


def train(
    features: DataFrame,
    cutoff: str,
    last_cohort: str,
    grid: Sequence[tuple[int, bool]] = PARAM_GRID,
    offsets: Sequence[int] = FOLD_OFFSETS,
    select_by: str = "val_mape",
    robust: bool = False,
) -> Training:
    """Fit, tabulate, project and score all products, windows and configurations together.

    ``features`` is the cohort matrix after exclusion; pass a written table, since several steps read it. A model that
    fails is left out of the ratio tables and so of the trials.
    """
    rows = materialize(prep.outlier_flags(prep.training_windows(features, cutoff, offsets), prep.WINDOW_KEYS), "train")
    models = glm.fit_responses(rows, robust=robust)
    ratios = materialize(ratio_tables.ratio_tables(models, rows, grid), "ratios")
    projected = materialize(project_windows(features, ratios, cutoff, offsets), "projected")
    trials = materialize(trial_table(projected, last_cohort), "trials")
    return Training(models, ratios, projected, trials, metrics.best_configuration(trials, select_by))


def served_ratios(ratios: DataFrame, best: DataFrame) -> DataFrame:
    """Ratio tables of each product's best configuration: what scoring looks up."""
    chosen = best.select("product", "grid_id")
    return ratios.filter(F.col("window_id") == MAIN_WINDOW).join(chosen, ["product", "grid_id"], "left_semi")
