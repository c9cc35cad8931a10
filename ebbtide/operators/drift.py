"""Drift of a batch against a frozen baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.constants import (
    DRIFT_FEATURES,
    DRIFT_PREDICTIONS,
    EXTRAPOLATION_ALERT_RATE,
    EXTRAPOLATION_FEATURE,
    PSI_ALERT,
    PSI_BUCKETS,
    PSI_EMPTY_SHARE,
    PSI_WARN,
)
from ebbtide.operators.quantiles import exact_quantiles
from ebbtide.session import materialize


def long_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value) rows. Text that is no number becomes null, and nulls and NaN are left out."""
    numbers = df.select(*[F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c) for c in columns])
    return numbers.unpivot([], list(columns), "feature", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def bucket_edges(reference: DataFrame, columns: Sequence[str], buckets: int = PSI_BUCKETS) -> DataFrame:
    """Distinct quantile edges of each feature of the reference. One job; one row per feature."""
    step = 1.0 / buckets
    shares = [i * step for i in range(buckets)] + [1.0]
    quantiles = exact_quantiles(long_features(reference, columns), ["feature"], "value", shares)
    return quantiles.select("feature", F.array_distinct("quantiles").alias("edges"))


def _bucket(value: Column, edges: Column, n_edges: Column, buckets: int) -> Column:
    """Bucket number, left-closed, the last one closed on both sides; null outside the edges.

    ``edges`` has ``buckets + 1`` entries, infinite beyond the ``n_edges`` real ones. The comparisons are nested as a
    binary search: four per value for ten buckets.
    """

    def reached(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= edges[middle], reached(middle + 1, high)).otherwise(reached(low, middle))

    count = reached(0, buckets + 1)
    inside = F.when((count >= 1) & (count < n_edges), count)
    return F.when(value == F.col("last_edge"), n_edges - 1).otherwise(inside)


def _padded_edges(reference: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """feature, edges (``buckets + 1`` entries, infinite beyond the ``n_edges`` real ones), n_edges, last_edge; written, so
    that the planner knows how small it is."""
    padding = F.array_repeat(F.lit(float("inf")), buckets + 1 - F.size("edges"))
    return materialize(
        bucket_edges(reference, columns, buckets).select(
            "feature", F.concat("edges", padding).alias("edges"), F.size("edges").alias("n_edges"),
            F.element_at("edges", -1).alias("last_edge"),
        ),
        "edges",
    )


def _in_buckets(values: DataFrame, edges: DataFrame, buckets: int) -> DataFrame:
    own = _bucket(F.col("value"), F.col("edges"), F.col("n_edges"), buckets)
    return values.join(edges, "feature").withColumn("bucket", own)


def psi(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], buckets: int = PSI_BUCKETS
) -> DataFrame:
    """Population stability index of each column: one row per column.

    Fewer than three distinct edges give 0, an empty side gives null, an empty bucket counts as a share of 1e-4, and
    values outside the reference's range are ignored. All columns go through together; rows are reduced to counts per
    bucket before the shuffle. Runs one job for the edges, which are written so that the planner knows how small they
    are.
    """
    edges = _padded_edges(reference, columns, buckets)
    sides = long_features(reference, columns).withColumn("is_reference", F.lit(True)).unionByName(
        long_features(current, columns).withColumn("is_reference", F.lit(False))
    )
    counts = materialize(
        _in_buckets(sides, edges, buckets)
        .groupBy("feature", "n_edges", "bucket")
        .agg(F.count_if("is_reference").alias("r"), F.count_if(~F.col("is_reference")).alias("c")),
        "bucket_counts",
    )
    return _index(counts, columns, buckets)


def _index(counts: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """The index of each column from rows (feature, n_edges, bucket, r, c) of counts, which are added up."""
    within = range(1, buckets + 1)

    def per_bucket(side: str) -> list[Column]:
        return [F.coalesce(F.sum(F.when(F.col("bucket") == i, F.col(side))), F.lit(0)).alias(f"{side}{i}") for i in within]

    def total(side: str) -> Column:
        return F.sum(F.when(F.col("bucket").isNotNull(), F.col(side))).alias(f"{side}_total")

    def share(side: str, i: int) -> Column:
        return F.when(F.col(f"{side}{i}") == 0, PSI_EMPTY_SHARE).otherwise(F.col(f"{side}{i}") / F.col(f"{side}_total"))

    # One row per feature from here on.
    wide = counts.groupBy("feature", "n_edges").agg(
        *per_bucket("r"), *per_bucket("c"), total("r"), total("c"), F.sum("c").alias("c_rows")
    )
    index = F.lit(0.0)
    for i in within:
        gap = (share("c", i) - share("r", i)) * F.ln(share("c", i) / share("r", i))
        index = index + F.when(F.col("n_edges") > i, gap).otherwise(0.0)
    value = F.when(F.col("c_rows") > 0, F.when(F.col("n_edges") < 3, 0.0).otherwise(index))
    names = counts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    return names.join(wide.select("feature", value.alias("psi")), "feature", "left")


def freeze_histograms(
    reference: DataFrame, columns: Sequence[str], model_version: str, frozen_at: str, buckets: int = PSI_BUCKETS
) -> DataFrame:
    """What the index and the guard need of a reference, one row per feature that has values: edges, rows per bucket,
    extremes. A batch is compared with that alone; the reference is not read again."""
    edges = _padded_edges(reference, columns, buckets)
    within = _in_buckets(long_features(reference, columns), edges, buckets).groupBy("feature", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    found = within.groupBy("feature").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("bucket") == i, F.col("n"))), F.lit(0)) for i in range(1, buckets + 1)]).alias("counts"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("n").alias("n"),
    )
    real = F.slice("edges", F.lit(1), F.col("n_edges")).alias("edges")
    return found.join(edges, "feature").select(
        "feature", real, "counts", "low", "high", "n", F.lit(model_version).alias("model_version"),
        F.lit(frozen_at).cast("timestamp").alias("baseline_frozen_at"),
    )


def psi_frozen(histograms: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``psi`` against frozen histograms: the same rows. Reads the batch once."""
    buckets = F.size("counts")
    padding = F.array_repeat(F.lit(float("inf")), buckets + 1 - F.size("edges"))
    own = materialize(
        histograms.filter(F.col("feature").isin(*columns)).select(
            "feature", "counts", F.concat("edges", padding).alias("edges"), F.size("edges").alias("n_edges"),
            F.element_at("edges", -1).alias("last_edge"),
        ),
        "histograms",
    )
    widest = own.agg(F.max(buckets)).first()[0] or PSI_BUCKETS
    edges = own.drop("counts")
    now = _in_buckets(long_features(current, columns), edges, widest).groupBy("feature", "n_edges", "bucket").agg(F.count(F.lit(1)).alias("c"))
    then = own.select("feature", "n_edges", F.posexplode("counts").alias("at", "r"))
    counts = then.select("feature", "n_edges", (F.col("at") + 1).alias("bucket"), "r", F.lit(0).cast("long").alias("c")).unionByName(
        now.withColumn("r", F.lit(0).cast("long"))
    )
    return _index(counts, columns, widest)


def status_band(value: Column, warn: float = PSI_WARN, alert: float = PSI_ALERT) -> Column:
    """ALERT, WARN or OK; a missing value is NO_DATA."""
    return (
        F.when(value.isNull() | F.isnan(value), "NO_DATA").when(value >= alert, "ALERT").when(value >= warn, "WARN")
    ).otherwise("OK")


def drift_report(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], drift_type: str = "feature",
    warn: float = PSI_WARN, alert: float = PSI_ALERT,
) -> DataFrame:
    return _banded(psi(reference, current, columns), drift_type, warn, alert)


def _banded(found: DataFrame, drift_type: str, warn: float = PSI_WARN, alert: float = PSI_ALERT) -> DataFrame:
    return found.select(
        F.lit(drift_type).alias("drift_type"), "feature", "psi", status_band(F.col("psi"), warn, alert).alias("status")
    )


def extrapolation_report(
    reference: DataFrame, current: DataFrame, feature: str = EXTRAPOLATION_FEATURE,
    alert_rate: float = EXTRAPOLATION_ALERT_RATE,
) -> DataFrame:
    """One row: share of the batch outside the reference's range. The range is a scalar subquery."""
    span = long_features(reference, [feature]).agg(
        F.struct(F.min("value").alias("ref_min"), F.max("value").alias("ref_max"))
    ).scalar()
    return _outside(span, current, feature, alert_rate)


def _outside(span: Column, current: DataFrame, feature: str, alert_rate: float = EXTRAPOLATION_ALERT_RATE) -> DataFrame:
    ranged = long_features(current, [feature]).withColumn("_span", span)
    outside = (F.col("value") < F.col("_span.ref_min")) | (F.col("value") > F.col("_span.ref_max"))
    rate = F.col("out_of_range_rate")
    return ranged.agg(F.avg(outside.cast("double")).alias("out_of_range_rate")).withColumn("_span", span).select(
        F.lit("extrapolation").alias("drift_type"), F.lit(feature).alias("feature"), "_span.ref_min", "_span.ref_max", rate,
        F.when(rate.isNull(), "NO_DATA").when(rate > alert_rate, "ALERT").otherwise("OK").alias("status"),
    )


def full_report(
    features_ref: DataFrame, features_now: DataFrame, predictions_ref: DataFrame, predictions_now: DataFrame,
    feature_columns: Sequence[str] = DRIFT_FEATURES, prediction_columns: Sequence[str] = DRIFT_PREDICTIONS,
) -> DataFrame:
    """Feature drift, prediction drift and the extrapolation guard in one table."""
    parts = [
        drift_report(features_ref, features_now, feature_columns, "feature"),
        drift_report(predictions_ref, predictions_now, prediction_columns, "prediction"),
        extrapolation_report(features_ref, features_now),
    ]
    return _together(parts)


def _together(parts: Sequence[DataFrame]) -> DataFrame:
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part, allowMissingColumns=True)
    return combined


def full_report_frozen(
    features_ref: DataFrame, features_now: DataFrame, predictions_ref: DataFrame, predictions_now: DataFrame,
    feature_columns: Sequence[str] = DRIFT_FEATURES, prediction_columns: Sequence[str] = DRIFT_PREDICTIONS,
    guarded: str = EXTRAPOLATION_FEATURE,
) -> DataFrame:
    """``full_report`` against the frozen histograms of both sides: the same rows."""
    of_guarded = F.col("feature") == guarded
    span = features_ref.agg(
        F.struct(F.max(F.when(of_guarded, F.col("low"))).alias("ref_min"), F.max(F.when(of_guarded, F.col("high"))).alias("ref_max"))
    ).scalar()
    return _together(
        [
            _banded(psi_frozen(features_ref, features_now, feature_columns), "feature"),
            _banded(psi_frozen(predictions_ref, predictions_now, prediction_columns), "prediction"),
            _outside(span, features_now, guarded),
        ]
    )


def alert_summary(report: DataFrame) -> DataFrame:
    """One row: any alert, the alerted items with their value, the highest value among them."""
    alerted = F.col("status") == "ALERT"
    value = F.coalesce(F.col("psi"), F.col("out_of_range_rate")) if "out_of_range_rate" in report.columns else F.col("psi")
    item = F.struct(F.concat_ws("::", "drift_type", "feature"), F.round(value, 3))
    return report.agg(
        F.coalesce(F.bool_or(alerted), F.lit(False)).alias("drift_detected"),
        F.map_from_entries(F.collect_list(F.when(alerted, item))).alias("alerts"),  # one entry per reported feature
        F.max(F.when(alerted, F.round(value, 3))).alias("max_value"),
    )


def freeze_baseline(matrix: DataFrame, model_version: str, frozen_at: str, columns: Sequence[str] = DRIFT_FEATURES) -> DataFrame:
    """Rows to append to the baseline table when a version is promoted."""
    return matrix.select(
        *columns, F.lit(model_version).alias("model_version"), F.lit(frozen_at).cast("timestamp").alias("baseline_frozen_at")
    )


def baseline_for(baselines: DataFrame, served_version: Column | str | None) -> DataFrame:
    """Baseline rows of the served version; if it has none, of the version frozen last.

    Which one applies is decided by a one-row aggregate inside the plan. An unversioned table passes whole.
    """
    if "model_version" not in baselines.columns or served_version is None:
        return baselines
    served = F.lit(served_version) if isinstance(served_version, str) else served_version
    chosen = baselines.agg(
        F.coalesce(
            F.max(F.when(F.col("model_version") == served, F.col("model_version"))),
            F.max_by("model_version", "baseline_frozen_at"),
        )
    ).scalar()
    return baselines.filter(F.col("model_version") == chosen)


def baseline_or_seed(baselines: DataFrame | None, batch: DataFrame, served_version: str, now: str, columns: Sequence[str]) -> DataFrame:
    """The baseline to compare with; without a table, the batch itself becomes the first one."""
    if baselines is None:
        return freeze_baseline(batch, served_version, now, columns)
    return baseline_for(baselines, served_version)
