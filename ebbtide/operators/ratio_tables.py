"""Fitted models -> ratio tables by age and rate bin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import FIRST_PROJECTED_AGE, PARAM_GRID, RATE_LABELS
from ebbtide.functions import families, spline
from ebbtide.functions.ratios import rate_label, rate_midpoints
from ebbtide.operators.glm import CONVERGED, N_TERMS, OUTFLOW, RECEIPTS, WITHDRAWAL
from ebbtide.operators.prep import WINDOW_KEYS, expand_grid

RATIOS = ("rec_pct", "outflow_pct", "transfer_pct")


def bin_medians(train: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Median rate gap of each bin seen in training, over the untrimmed rows (a bounded part of the cohort matrix)."""
    return (
        train.filter(F.col("bin_id").isNotNull())
        .groupBy(*keys, "bin_id")
        .agg(F.percentile("delta_to_best_buy", F.lit(0.5)).alias("median_delta"))
    )


def representative_deltas(train: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """One row per key with the rate gap that stands for each bin: the median, or the midpoint of an unseen bin.

    Medians are matched to bins by bin number, so a bin missing from training cannot shift the others.
    """
    seen = bin_medians(train, keys).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("bin_id", "median_delta"))).alias("_seen")  # at most one per bin
    )
    chosen = [F.coalesce(F.col("_seen")[F.lit(i)], F.lit(mid)) for i, mid in enumerate(rate_midpoints())]
    return seen.select(*keys, F.array(*chosen).alias("bin_deltas"))


def grid_rows(windows: DataFrame, first_age: int = FIRST_PROJECTED_AGE) -> DataFrame:
    """Ages first_age..month_end x bins for every row of ``windows`` (which carries month_end and bin_deltas)."""
    return (
        windows.withColumn("months_since_start", F.explode(F.sequence(F.lit(first_age), F.col("month_end"))))
        .select("*", F.posexplode("bin_deltas").alias("bin_id", "delta_to_best_buy"))
        .drop("bin_deltas")
    )


def models_by_window(models: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """The three models of a key side by side; a key that lacks a settled one is left out."""
    fitted = F.coalesce(F.col("status") == CONVERGED, F.lit(False))
    bend = spline.bends(F.col("beta"), F.col("curve"))
    usable = models.filter(fitted).withColumn("_model", F.struct("family", "knots", "beta", bend.alias("bend")))
    sides = [
        F.max_by("_model", F.when(F.col("response") == r, 1)).alias(r) for r in (OUTFLOW, WITHDRAWAL, RECEIPTS)
    ]
    return usable.groupBy(*keys).agg(*sides, F.count("*").alias("_fitted")).filter("_fitted = 3").drop("_fitted")


def predict_grid(grid: DataFrame, clip_age: bool = False) -> DataFrame:
    """``rec_pred``, ``outflow_pred`` and ``wd_pred`` on the grid.

    The spline is a straight line beyond its outer knots; ``clip_age`` holds ages inside the range both splines share.
    """
    age = F.col("months_since_start").cast("double")
    if clip_age:
        low = F.greatest(F.col(RECEIPTS)["knots"][0], F.col(OUTFLOW)["knots"][0])
        high = F.least(F.col(RECEIPTS)["knots"][3], F.col(OUTFLOW)["knots"][3])
        age = F.greatest(low, F.least(age, high))
    gap, at = F.col("delta_to_best_buy"), F.col("_age")
    placed = grid.withColumn("_age", age)
    for response in (RECEIPTS, OUTFLOW):
        model, prefix = F.col(response), f"_{response}_"
        placed = spline.place(placed, at, model["knots"], prefix)
        curved = spline.value(at, model["beta"], model["bend"], prefix) + model["beta"][N_TERMS - 1] * gap
        placed = placed.withColumn(f"_eta_{response}", curved).drop(*spline.placed_columns(prefix))
    line = F.col(WITHDRAWAL)["beta"]
    placed = placed.withColumn(f"_eta_{WITHDRAWAL}", line[0] + line[1] * gap)
    named = {RECEIPTS: "rec_pred", OUTFLOW: "outflow_pred", WITHDRAWAL: "wd_pred"}
    for response, name in named.items():
        family = F.col(response)["family"]
        placed = placed.withColumn("_mu", families.mean_of(family, F.col(f"_eta_{response}"))).withColumn(
            name, families.clamp(family, F.col("_mu"))
        )
    return placed.drop("_age", "_mu", *named, *[f"_eta_{r}" for r in named])


def composites(predictions: DataFrame) -> DataFrame:
    """The three ratios in percent: receipts of the lag, outflow of the lag, transfers of the outflow."""
    return (
        predictions.withColumn("rec_pct", F.col("rec_pred") * 100)
        .withColumn("outflow_pct", F.col("outflow_pred") * (1 + F.col("rec_pred")) * 100)
        .withColumn("transfer_pct", (1 - F.col("wd_pred")) * 100)
    )


def ratio_tables(
    models: DataFrame,
    train: DataFrame,
    grid: Sequence[tuple[int, bool]] = PARAM_GRID,
    clip_age: bool = False,
) -> DataFrame:
    """Long ratio table of every product, window and configuration."""
    windows = expand_grid(models_by_window(models).join(representative_deltas(train), list(WINDOW_KEYS)), grid)
    table = composites(predict_grid(grid_rows(windows), clip_age))
    return table.select(
        *WINDOW_KEYS, "grid_id", "month_end", "months_since_start", "bin_id",
        rate_label(F.col("bin_id")).alias("rate_bin"), *RATIOS,
    )


def pivot_ratio(table: DataFrame, ratio: str, keys: Sequence[str]) -> DataFrame:
    """Wide form: a row per key and age, a column per rate bin in bin order."""
    return (
        table.select(*keys, "months_since_start", "rate_bin", ratio)
        .groupBy(*keys, "months_since_start")
        .pivot("rate_bin", list(RATE_LABELS))
        .agg(F.first(ratio, ignorenulls=True))
    )
