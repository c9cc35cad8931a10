"""Data-quality checks: one pass over the data, one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import (
    GUARD_NULL_RATE,
    MATRIX_COLUMNS,
    SCORING_MAX_NULL_RATE,
    SCORING_MIN_ROWS,
    SCORING_NULL_CHECKED,
    SCORING_REQUIRED,
    TRAINING_MAX_NULL_RATE,
    TRAINING_MIN_PRODUCTS,
    TRAINING_MIN_ROWS,
    TRAINING_NULL_CHECKED,
)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _check(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), detail.alias("detail"))


def _number(x: float) -> str:
    return str(float(x))


def quality_checks(
    df: DataFrame,
    required: Sequence[str] = (),
    min_rows: int | None = None,
    null_checked: Sequence[str] = (),
    max_null_rate: float = 1.0,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    coverage: tuple[str, int] | None = None,
) -> DataFrame:
    """Check rows in the order schema, row count, null rates, ranges, coverage.

    Everything but the schema comes from a single aggregation. Checks on absent columns are left to the schema check.
    An empty frame has a null rate of 1; nulls are never out of range.
    """
    absent = missing_columns(df, required)
    ranges = {c: r for c, r in (ranges or {}).items() if c in df.columns}
    null_checked = [c for c in null_checked if c in df.columns]
    sums = [F.count("*").alias("n")]
    sums += [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(null_checked)]
    sums += [
        F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"outside_{i}")
        for i, (c, (lo, hi)) in enumerate(ranges.items())
    ]
    if coverage:
        sums.append(F.countDistinct(coverage[0]).alias("covered"))

    checks: list[Column] = []
    if required:
        text = f"missing columns: {absent}" if absent else "all required columns present"
        checks.append(_check("schema_columns", F.lit(not absent), F.lit(text)))
    if min_rows is not None:
        detail = F.concat(F.col("n").cast("string"), F.lit(f" rows (expected >= {min_rows})"))
        checks.append(_check("row_count", F.col("n") >= min_rows, detail))
    for i, c in enumerate(null_checked):
        rate = F.coalesce(F.try_divide(F.col(f"nulls_{i}").cast("double"), F.col("n")), F.lit(1.0))
        detail = F.concat(F.format_string("%.2f", rate * 100), F.lit(f"% null (threshold {max_null_rate:.0%})"))
        checks.append(_check(f"null_rate::{c}", rate <= max_null_rate, detail))
    for i, (c, (lo, hi)) in enumerate(ranges.items()):
        outside = F.col(f"outside_{i}")
        detail = F.concat(outside.cast("string"), F.lit(f" rows outside [{_number(lo)}, {_number(hi)}]"))
        checks.append(_check(f"value_range::{c}", outside == 0, detail))
    if coverage:
        column, least = coverage
        detail = F.concat(F.col("covered").cast("string"), F.lit(f" distinct {column}s (expected >= {least})"))
        checks.append(_check(f"{column}_coverage", F.col("covered") >= least, detail))
    return df.agg(*sums).select(F.posexplode(F.array(*checks)).alias("check_no", "_c")).select("check_no", "_c.*")


def training_checks(matrix: DataFrame, skip_first_age: bool = False) -> DataFrame:
    """The gate before training. ``skip_first_age`` leaves out the rows that cannot have a lag."""
    rows = matrix.filter(F.col("months_since_start") > 1) if skip_first_age else matrix
    return quality_checks(
        rows,
        required=MATRIX_COLUMNS,
        min_rows=TRAINING_MIN_ROWS,
        null_checked=TRAINING_NULL_CHECKED,
        max_null_rate=TRAINING_MAX_NULL_RATE,
        ranges={"outflow_prop": (0.0, 1.0), "rec_prop": (0.0, 5.0)},
        coverage=("product", TRAINING_MIN_PRODUCTS),
    )


def scoring_checks(features: DataFrame) -> DataFrame:
    return quality_checks(
        features,
        required=SCORING_REQUIRED,
        min_rows=SCORING_MIN_ROWS,
        null_checked=SCORING_NULL_CHECKED,
        max_null_rate=SCORING_MAX_NULL_RATE,
        ranges={"delta_to_best_buy": (-3.0, 3.0)},
    )


def quality_log(checks: DataFrame, validated_at: str, stage: str) -> DataFrame:
    """Check rows as they are appended to the log."""
    return checks.withColumns({"validated_at": F.lit(validated_at).cast("timestamp"), "stage": F.lit(stage)})


def all_passed(checks: DataFrame) -> DataFrame:
    """One row: did every check pass, and which did not, in check order."""
    failures = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.struct("check_no", "check_name"))))
    return checks.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
        F.transform(failures, lambda f: f["check_name"]).alias("failures"),
    )


def null_prediction_guard(monitoring: DataFrame, limit: float = GUARD_NULL_RATE) -> DataFrame:
    """One row: the worst share of missing predictions and whether it stays under the limit."""
    worst = F.coalesce(F.max("null_prediction_rate"), F.lit(0.0))
    return monitoring.agg(worst.alias("max_null_rate"), (worst < limit).alias("passed"))


def require(checks: DataFrame) -> None:
    """Raise with the list of failed checks. Runs one job; write the log first."""
    verdict = all_passed(checks).first()
    if not verdict["passed"]:
        raise ValueError(f"failed checks: {', '.join(verdict['failures'])}")
