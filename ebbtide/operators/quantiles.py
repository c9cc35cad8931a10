"""Exact interpolated quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import materialize

#: Bits of a value's key that a pass tells apart: a task holds at most 2**DIGIT counts a slice.
DIGIT, KEY = 16, 64
#: Rows of a slice that one task may rank.
SLICE_ROWS = 200_000


def sort_key(value: Column) -> Column:
    """A DOUBLE (no NaN) as a LONG of the same order: the number's own bits, which arithmetic by powers of two finds
    exactly. Both zeros are one."""
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    scaled = size * F.pow(F.lit(2.0), -guess)  # off by a factor of two at most, where the logarithm was rounded
    exponent = guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    fraction = scaled * F.when(scaled >= 2, 0.5).when(scaled < 1, 2.0).otherwise(1.0) - 1
    bits = (
        F.when(size == float("inf"), F.lit(2047 << 52))
        .when(size < 2.0**-1022, (size * 2.0**537 * 2.0**537).cast("long"))
        .otherwise(F.shiftleft((exponent + 1023).cast("long"), 52) + (fraction * 2.0**52).cast("long"))
    )
    return F.when(value < 0, -bits).otherwise(bits)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One row per group: ``n`` and ``quantiles``, an array in the order of ``probabilities``.

    ``percentile`` keeps every distinct value of a group in one task; here no task does. Each target rank lies in a
    slice of the values, at first the whole group. Values have 64-bit keys of the same order. Rows of a slice are counted by
    the next DIGIT bits of their keys, map-side, and the counts tell with which digit the rank lies, which is the new
    slice. Only slices of more than ``slice_rows`` rows are cut again, and none more than four times: then all its
    values are equal. What is left is ranked by distinct values. Every step is exact. NaN and null values are left out.

    The slices, one row per group and target, are written between the passes.
    """
    named, keys = list(keys), [f"_key{i}" for i in range(len(keys))]  # so that no name of a group clashes with those below
    rows = df.select(*[F.col(k).alias(own) for k, own in zip(named, keys)], F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    rows = rows.withColumn("k", sort_key(F.col("v")))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])
    position = F.col("t.p") * (F.col("n") - 1)
    low = F.floor(position)
    ranks = F.explode(F.array_distinct(F.array("low", "high"))).alias("rank")
    targets = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("t", F.explode(wanted))
        .select(*keys, "n", F.col("t.i").alias("i"), (position - low).alias("part"), low.alias("low"))
        .withColumn("high", F.least(F.col("low") + 1, F.col("n") - 1))
        .select("*", ranks)
        .withColumns({"known": F.lit(0), "prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long"), "inside": F.col("n")})
    )
    state = materialize(targets, "slices")
    for _ in range(KEY // DIGIT):
        large = state.filter(F.col("inside") > slice_rows)
        if large.isEmpty():
            break
        state = materialize(state.filter(F.col("inside") <= slice_rows).unionByName(_narrow(rows, large, keys)), "slices")
    found = _quantiles(_ranked(rows, state, keys), keys)
    return found.select(*[F.col(own).alias(k) for k, own in zip(named, keys)], "n", "quantiles")


def _prefix(k: Column, known: Column) -> Column:
    """The first ``known`` digits of a key."""
    out = F.when(known == 0, F.lit(0).cast("long"))
    for digits in range(1, KEY // DIGIT):
        out = out.when(known == digits, F.shiftright(k, KEY - digits * DIGIT))
    return out.otherwise(k)


def _in_slices(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in the slices of ``state``, once for each slice (``s``: known, prefix). A group's slices come in one row."""
    slices = state.groupBy(*keys).agg(F.collect_set(F.struct("known", "prefix")).alias("slices"))
    at = null_safe_join(rows, slices, keys)
    own = F.filter("slices", lambda s: s["prefix"] == _prefix(F.col("k"), s["known"]))
    return at.select(*keys, "v", "k", F.explode(own).alias("s"))


def _narrow(rows: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each target's slice cut down to one value of the next digit."""
    slice_keys = [*keys, "known", "prefix"]
    counts = (
        _in_slices(rows, targets, keys)
        .select(*keys, "s.known", "s.prefix", _prefix(F.col("k"), F.col("s.known") + 1).alias("next"))
        .groupBy(*slice_keys, "next")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    end = F.sum("copies").over(Window.partitionBy(*slice_keys).orderBy("next"))
    placed = counts.withColumn("end", end)
    found = null_safe_join(targets, placed, slice_keys)
    found = found.withColumn("begin", F.col("below") + F.col("end") - F.col("copies"))
    here = (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("below") + F.col("end"))
    cut = {"known": F.col("known") + 1, "prefix": F.col("next"), "below": F.col("begin"), "inside": F.col("copies")}
    return found.filter(here).withColumns(cut).select(*targets.columns)


def _ranked(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The value ``v`` at each target rank, from the distinct values of its slice."""
    slice_keys = [*keys, "known", "prefix"]
    values = _in_slices(rows, state, keys).groupBy(*keys, "s", "k").agg(F.count(F.lit(1)).alias("copies"), F.min("v").alias("v"))
    end = F.sum("copies").over(Window.partitionBy(*slice_keys).orderBy("k"))
    placed = values.select(*keys, "s.known", "s.prefix", "k", "v", "copies").withColumn("end", end)
    found = null_safe_join(state, placed, slice_keys)
    begin = F.col("below") + F.col("end") - F.col("copies")
    return found.filter((F.col("rank") >= begin) & (F.col("rank") < F.col("below") + F.col("end")))


def _quantiles(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    at_low, at_high = (F.max(F.when(F.col("rank") == F.col(side), F.col("v"))) for side in ("low", "high"))
    per_target = ranked.groupBy(*keys, "n", "i", "part").agg(at_low.alias("a"), at_high.alias("z"))
    quantile = F.col("a") + (F.col("z") - F.col("a")) * F.col("part")
    return per_target.groupBy(*keys, "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", quantile.alias("q")))), lambda e: e["q"]).alias("quantiles")
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that matches a null key with a null key."""
    renamed = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_key_{k}" for k in keys])
