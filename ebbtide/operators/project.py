"""Month-by-month balance projection without a row loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.constants import MEASURES, SERIES_KEYS
from ebbtide.functions.errors import ape

_RATIOS = ("rec_pct", "outflow_pct", "transfer_pct")


def lookup_ratios(features: DataFrame, ratios: DataFrame, keys: Sequence[str] = ("product",)) -> DataFrame:
    """Ratios of each row's bin at its age, the age held inside the table's range.

    ``keys`` identify one ratio table; features repeat once per table of their product. The tables are months x bins
    per key, and joins carry no hint: they are broadcast when their size says so.
    """
    keys = list(keys)
    ranges = ratios.groupBy(*keys).agg(
        F.min("months_since_start").alias("_first_age"), F.max("months_since_start").alias("_last_age")
    )
    table = ratios.select(
        *keys,
        F.col("months_since_start").alias("_age"),
        "bin_id",
        *[(F.col(c) / 100).alias(f"{c}_pred") for c in _RATIOS],
    )
    at = features.join(ranges, [k for k in keys if k in features.columns])
    held = F.greatest(F.col("_first_age"), F.least(F.col("months_since_start"), F.col("_last_age")))
    return (
        at.withColumn("_age", held)
        .join(table, [*keys, "_age", "bin_id"], "left")
        .drop("_age", "_first_age", "_last_age")
    )


def project(rows: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Balances and flows of every series, each predicted balance being the next row's lag.

    A month multiplies the lag by (1 + receipts - outflow): withdrawals and transfers only split the outflow. So the
    lag of a row is the run's first known lag times the running product of the earlier factors. A run starts at each
    age-1 row, which gives zero flows and echoes its lag; rows before the first known lag give nulls. A missing ratio
    gives nulls to the end of its run and sets ``missing_ratio``.

    All windows share the partitioning by series: one shuffle. A series has one row per calendar month.
    """
    order = F.col("reporting_period")
    series = Window.partitionBy(*keys).orderBy(order)
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = Window.partitionBy(*keys, "_run").orderBy(order)
    run_so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    opening = F.col("months_since_start") == 1
    known = rows.withColumn("_run", F.sum(opening.cast("int")).over(so_far)).withColumn(
        "_seed", F.first(F.when(~opening, F.col("balance_lag_1")), ignorenulls=True).over(run_so_far)
    )
    chained = ~opening & F.col("_seed").isNotNull()
    rec, out, transfer = (F.col(f"{c}_pred") for c in _RATIOS)
    missing = chained & (rec.isNull() | out.isNull() | transfer.isNull())
    stepped = (
        known.withColumn("_chained", chained)
        .withColumn("missing_ratio", missing)
        .withColumn("_factor", F.when(chained & ~missing, 1 + rec - out).otherwise(1.0))
        .withColumn("_growth", F.product("_factor").over(run_so_far))
        .withColumn("_broken", F.max("missing_ratio").over(run_so_far))
    )
    lag = F.col("_seed") * F.lag("_growth", 1, 1.0).over(run)
    flows = (
        stepped.withColumn("_lag", F.when(F.col("_chained") & ~F.col("_broken"), lag))
        .withColumn("receipts_pred", F.when(opening, 0.0).otherwise(F.col("_lag") * rec))
        .withColumn("_outflows", F.col("_lag") * out)
        .withColumn("transfers_pred", F.when(opening, 0.0).otherwise(F.col("_outflows") * transfer))
        .withColumn(
            "withdrawals_pred", F.when(opening, 0.0).otherwise(F.col("_outflows") - F.col("_outflows") * transfer)
        )
        .withColumn("_next", F.col("_lag") + F.col("_lag") * rec - F.col("_outflows"))
    )
    # An age-1 row after a projected one echoes the projected balance, as any row's lag would be replaced by it.
    echo = F.coalesce(F.lag("_next", 1).over(series), F.col("balance_lag_1"))
    used = {f"{c}_pred": F.when(F.col("_lag").isNotNull(), F.col(f"{c}_pred")) for c in _RATIOS}
    return (
        flows.withColumn("balance_pred", F.when(opening, echo).otherwise(F.col("_next")))
        .withColumn("balance_lag_1", F.when(opening, echo).otherwise(F.coalesce("_lag", "balance_lag_1")))
        .withColumns(used)
        .drop("_run", "_seed", "_chained", "_factor", "_growth", "_broken", "_lag", "_outflows", "_next")
    )


def end_state(projected: DataFrame, before: DataFrame | None = None, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Where each series stands after its projected rows: its last month, the balance that the next month starts from
    (``carry``; null where no lag is known), and whether a missing ratio has broken its run. ``before`` is the state that
    the rows were resumed from; series without new rows keep it. One row per series, from hash aggregates."""
    period, opening = F.col("reporting_period"), F.col("months_since_start") == 1
    found = projected.groupBy(*keys).agg(
        F.max(period).alias("reporting_period"),
        F.max_by("balance_pred", period).alias("carry"),
        F.max_by(opening, period).alias("_opening"),
        F.max(F.when(opening, period)).alias("_opened"),
        F.max(F.when(F.col("missing_ratio"), period)).alias("_missed"),
    )
    broken = F.col("_missed").isNotNull() & (F.col("_opened").isNull() | (F.col("_missed") > F.col("_opened")))
    now = found.select(
        *keys, "reporting_period", F.when(~F.col("_opening"), F.col("carry")).alias("carry"), broken.alias("broken"), "_opened"
    )
    if before is None:
        return now.drop("_opened")
    old = before.select(*keys, *[F.col(c).alias(f"_{c}") for c in ("reporting_period", "carry", "broken")])
    both = now.join(old, list(keys), "full")
    new = F.col("reporting_period").isNotNull()
    still = F.coalesce(F.col("_broken"), F.lit(False)) & F.col("_opened").isNull()
    return both.select(
        *keys,
        F.coalesce("reporting_period", "_reporting_period").alias("reporting_period"),
        F.when(new, F.col("carry")).otherwise(F.col("_carry")).alias("carry"),
        F.when(new, F.col("broken") | still).otherwise(F.col("_broken")).alias("broken"),
    )


def resume(rows: DataFrame, state: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """``project`` for months after those that ``state`` stands for, without reading those again: the same rows as if
    all months were projected together. Of the state, a series' row goes first, as a month that changes nothing."""
    held = F.col("carry").isNotNull() | F.col("broken")
    first = state.filter(held).join(rows.select(*keys).distinct(), list(keys), "left_semi").select(
        *keys,
        "reporting_period",
        F.lit(2).alias("months_since_start"),
        F.coalesce("carry", F.lit(0.0)).alias("balance_lag_1"),
        *[F.when(~F.col("broken"), 0.0).alias(f"{c}_pred") for c in _RATIOS],
        F.lit(True).alias("_state"),
    )
    together = rows.withColumn("_state", F.lit(False)).unionByName(first, allowMissingColumns=True)
    return project(together, keys).filter(~F.col("_state")).drop("_state")


def between_periods(features: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows of the projected months, both ends included."""
    period = F.col("reporting_period")
    if start is not None:
        features = features.filter(period >= F.lit(start).cast("date"))
    if end is not None:
        features = features.filter(period <= F.lit(end).cast("date"))
    return features


def cohorts_until(projected: DataFrame, last_cohort: str) -> DataFrame:
    return projected.filter(F.col("cohort") <= F.lit(last_cohort).cast("date"))


def add_row_errors(projected: DataFrame) -> DataFrame:
    """``ape_<measure>`` of the four measures."""
    return projected.withColumns({f"ape_{m}": ape(F.col(m), F.col(f"{m}_pred")) for m in MEASURES})


def add_audit(scored: DataFrame, scored_at: str | Column, model_name: str, model_version: str, alias: str) -> DataFrame:
    stamp = F.lit(scored_at).cast("timestamp") if isinstance(scored_at, str) else scored_at
    return scored.withColumns(
        {
            "scored_at": stamp,
            "model_name": F.lit(model_name),
            "model_version": F.lit(model_version),
            "model_alias": F.lit(alias),
        }
    )


def score(features: DataFrame, ratios: DataFrame) -> DataFrame:
    """The served model: features and its ratio table -> projected balances, flows and row errors."""
    return add_row_errors(project(lookup_ratios(features, ratios)))
