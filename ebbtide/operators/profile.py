"""Column profiles of a table, whole or by time window and slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.quantiles import exact_quantiles, null_safe_join, sort_key
from ebbtide.session import materialize

QUARTILES = (0.25, 0.5, 0.75)
WINDOWS = ("day", "week", "month")
#: Binary exponents that share one exact sum: a value is a whole number of units of the smallest of them, below 2**85.
SPAN = 32
_LOWEST = -1075  # a DOUBLE is a 53-bit whole number times 2**(exponent - 1075), by the exponent its bits hold


def _start(day: Column, granularity: str) -> Column:
    """Start of the day, week (Monday) or month as DATE."""
    return F.to_date(F.date_trunc(granularity, day))


def _exact(value: Column) -> tuple[Column, Column]:
    """(span, units): a finite value as a whole number of units of its span of exponents. Sums of units are exact, so a sum
    does not go by the order of rows. Infinities and NaN have the span -1."""
    size = F.when(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(None).cast("double")).otherwise(F.abs(value))
    bits = sort_key(size)
    exponent = F.greatest(F.shiftright(bits, 52), F.lit(1))
    mantissa = bits.bitwiseAND(F.lit((1 << 52) - 1)) + F.when(bits >= F.lit(1 << 52), F.lit(1 << 52)).otherwise(F.lit(0))
    scale = F.call_function("shiftleft", F.lit(1).cast("long"), (exponent % SPAN).cast("int"))
    units = (mantissa.cast("decimal(16,0)") * scale.cast("decimal(10,0)")).cast("decimal(28,0)")
    span = F.when(value.isNull(), F.lit(None).cast("int")).when(bits.isNull(), -1).otherwise(F.floor(exponent / SPAN).cast("int"))
    return span, F.when(value < 0, -units).otherwise(units)


def _mean(parts: Column, n: Column) -> Column:
    """The mean of ``n`` values from the exact sums of their spans, the largest first."""

    def scaled(part: Column) -> Column:
        power = part["span"] * SPAN + _LOWEST
        half = F.floor(power / 2)  # in two steps, since 2**power need not be a DOUBLE
        return part["units"].cast("double") / n * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)

    return F.aggregate(F.sort_array(parts, asc=False), F.lit(0.0), lambda total, part: total + scaled(part))


def _profiles(df: DataFrame, columns: Sequence[str], slices: Sequence[str], timestamp: str | None, windows: Sequence[str | None]) -> DataFrame:
    """One row per window of each kind, slice and column. Rows are read once for moments and once for distinct values,
    whatever the number of kinds: both are kept by day, and days are merged into the windows."""
    named, slices = list(slices), [f"_slice{i}" for i in range(len(slices))]  # no name of a slice may clash with those below
    df = df.select("*", *[F.col(c).alias(own) for c, own in zip(named, slices)])
    day = [] if timestamp is None else ["_day"]
    rows = df if timestamp is None else df.withColumn("_day", F.to_date(F.col(timestamp)))
    values = rows.select(*day, *slices, *[F.col(c).cast("double").alias(c) for c in columns])
    values = values.unpivot([*day, *slices], list(columns), "column_name", "value")
    keys = ["granularity", "window_start", *slices, "column_name"]

    def in_windows(by_day: DataFrame) -> DataFrame:
        kinds = [
            F.struct(F.lit(g or "total").alias("granularity"), (_start(F.col("_day"), g) if g else F.lit(None).cast("date")).alias("window_start"))
            for g in windows
        ]
        rest = [c for c in by_day.columns if c != "_day"]
        return by_day.withColumn("_window", F.explode(F.array(*kinds))).select("_window.*", *rest)

    span, units = _exact(F.col("value"))
    by_day = values.withColumn("span", span).groupBy(*day, *slices, "column_name", "span").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.sum(units).alias("units"), F.avg("value").alias("mean_here"), (F.var_pop("value") * F.count("value")).alias("spread"),
    )
    parts = in_windows(materialize(by_day, "profile-days"))
    spans = parts.groupBy(*keys, "span").agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("units").alias("units"), F.sum(F.col("mean_here") * F.col("n")).alias("rounded"),
    )
    found = spans.groupBy(*keys).agg(
        F.sum("rows").alias("n_rows"),
        F.sum("n").alias("n"),
        F.min("low").alias("minimum"),
        F.max("high").alias("maximum"),
        F.collect_list(F.when(F.col("span") >= 0, F.struct("span", "units"))).alias("parts"),  # 64 spans at most
        F.sum(F.when(F.col("span") < 0, F.col("rounded"))).alias("_other"),
    )
    exact = F.greatest(F.least(_mean(F.col("parts"), F.col("n")), F.col("maximum")), F.col("minimum"))
    mean = F.when(F.col("n") > 0, F.when(F.col("_other").isNull(), exact).otherwise(F.col("_other")))
    summary = found.withColumn("mean", mean)
    about = null_safe_join(parts, summary.select(*keys, "mean"), keys)
    gap = F.col("mean_here") - F.col("mean")
    moments = about.groupBy(*keys).agg(F.sum(F.col("spread") + F.col("n") * gap * gap).alias("_spread"))
    summary = null_safe_join(summary, moments, keys).select(
        *keys,
        "n_rows",
        (1 - F.col("n") / F.col("n_rows")).alias("null_rate"),
        "minimum",
        "maximum",
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("_spread") / (F.col("n") - 1))).alias("deviation"),
    )
    seen = in_windows(values.select(*day, *slices, "column_name", "value").distinct()).distinct()
    distinct = seen.groupBy(*keys).agg(F.count("value").alias("n_distinct"))
    quartiles = exact_quantiles(in_windows(values), keys, "value", QUARTILES).select(
        *keys, *[F.col("quantiles")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    )
    out = null_safe_join(null_safe_join(summary, distinct, keys), quartiles, keys, "left")
    return out.withColumnsRenamed(dict(zip(slices, named)))


def profile(
    df: DataFrame,
    columns: Sequence[str],
    slices: Sequence[str] = (),
    timestamp: str | None = None,
    granularity: str = "day",
) -> DataFrame:
    """Rows, nulls, extremes, mean, deviation, distinct values and quartiles per window, slice and column.

    A column is either a slice or profiled, not both. Columns are unpivoted, so all of them go through one
    aggregation. The mean is that of the values as they are, whatever their order: they are summed exactly. Distinct values
    are counted apart, since only they shuffle by value, and quartiles by ``exact_quantiles``: neither gathers a
    large slice in one task.
    """
    out = _profiles(df, columns, slices, timestamp, [granularity if timestamp is not None else None]).drop("granularity")
    return out if timestamp is not None else out.drop("window_start")


def profiles(
    df: DataFrame, columns: Sequence[str], slices: Sequence[str], timestamp: str, windows: Sequence[str] = WINDOWS
) -> DataFrame:
    """The profiles of all ``windows`` and of the whole table (granularity ``total``, no window_start) in one plan."""
    return _profiles(df, columns, slices, timestamp, [*windows, None])
