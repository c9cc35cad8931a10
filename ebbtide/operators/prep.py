"""Training windows, train/test split, outlier flags, search grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import FOLD_OFFSETS, PARAM_GRID

RATIO_COLUMNS = ("rec_prop", "outflow_prop", "withdrawal_prop_of_outflow")
WINDOW_KEYS = ("product", "window_id", "drop_month2")
MAIN_WINDOW = 0


def split(matrix: DataFrame, cutoff: Column | str, drop_month2: Column | bool = False) -> DataFrame:
    """``is_train`` and ``is_test`` flags beside the rows; the age-2 rule touches training only."""
    at = F.lit(cutoff).cast("date") if isinstance(cutoff, str) else cutoff
    drop = F.lit(drop_month2) if isinstance(drop_month2, bool) else drop_month2
    before = F.col("reporting_period") < at
    return matrix.withColumn("is_train", before & ~(drop & (F.col("months_since_start") == 2))).withColumn(
        "is_test", ~before
    )


def training_windows(matrix: DataFrame, cutoff: str, offsets: Sequence[int] = FOLD_OFFSETS) -> DataFrame:
    """Training rows once per window and month-2 rule.

    Window 0 ends at the main cut-off, the others earlier by the given months. Configurations that differ only in
    their horizon share training rows, so the grid needs 2 x (1 + folds) sets and not one per configuration and fold.
    """
    variants = [
        F.struct(
            F.lit(i).alias("window_id"),
            F.add_months(F.lit(cutoff).cast("date"), -months).alias("window_cutoff"),
            F.lit(drop).alias("drop_month2"),
        )
        for i, months in enumerate((0, *offsets))
        for drop in (True, False)
    ]
    expanded = matrix.withColumn("_variant", F.explode(F.array(*variants))).select("*", "_variant.*").drop("_variant")
    flagged = split(expanded, F.col("window_cutoff"), F.col("drop_month2"))
    return flagged.filter("is_train").drop("is_train", "is_test")


def outlier_flags(
    train: DataFrame, keys: Sequence[str] = ("product",), columns: Sequence[str] = RATIO_COLUMNS
) -> DataFrame:
    """``keep_<column>`` flags by the 1.5 x interquartile-range rule; missing values are kept.

    The quantiles are exact and interpolated. A group is one product's part of the cohort matrix: at most one row per
    cohort month and age, so a calendar of M months bounds it by M(M+1)/2 rows whatever the number of accounts.
    """
    quartiles = train.groupBy(*keys).agg(
        *[F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).alias(f"_q_{c}") for c in columns]
    )
    flagged = train.join(quartiles, list(keys))
    for c in columns:
        q1, q3 = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        reach = (q3 - q1) * 1.5
        outside = (F.col(c) < q1 - reach) | (F.col(c) > q3 + reach)
        flagged = flagged.withColumn(f"keep_{c}", ~F.coalesce(outside, F.lit(False)))
    return flagged.drop(*[f"_q_{c}" for c in columns])


def grid_columns(grid: Sequence[tuple[int, bool]] = PARAM_GRID) -> Column:
    """The search grid as an array of (grid_id, month_end, drop_month2) to explode."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("grid_id"), F.lit(end).alias("month_end"), F.lit(drop).alias("grid_drop_month2"))
            for i, (end, drop) in enumerate(grid)
        ]
    )


def expand_grid(windows: DataFrame, grid: Sequence[tuple[int, bool]] = PARAM_GRID) -> DataFrame:
    """One row per (product, window) variant and the configurations that use its month-2 rule."""
    return (
        windows.withColumn("_grid", F.explode(grid_columns(grid)))
        .filter(F.col("_grid.grid_drop_month2") == F.col("drop_month2"))
        .select("*", "_grid.grid_id", "_grid.month_end")
        .drop("_grid")
    )
