from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import quantiles
from ebbtide.operators.quantiles import exact_quantiles

SHARES = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("seed", range(4))
def test_agrees_with_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {g: rng.normal(size=int(n)).round(int(rng.integers(0, 6))) for g, n in enumerate((1, 2, 7, 3000))}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [(0, None), (0, float("nan"))]
    df = spark.createDataFrame(rows, "g int, v double")
    for row in exact_quantiles(df, ["g"], "v", SHARES).collect():
        assert row.n == len(groups[row.g])
        np.testing.assert_allclose(row.quantiles, np.quantile(groups[row.g], SHARES), atol=1e-12)


@pytest.mark.parametrize("slice_rows", [1, 50, 10**6])
def test_slices_are_narrowed(spark, slice_rows):
    """A third of all rows are equal; slices are narrowed until they are small, or consist of repeats."""
    n = 120_000
    df = spark.range(n).select(
        F.lit("hot").alias("g"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.abs(F.hash("id")) / 2.0**31).alias("v")
    )
    values = np.array([r.v for r in df.collect()])
    (row,) = exact_quantiles(df, ["g"], "v", SHARES, slice_rows).collect()
    np.testing.assert_allclose(row.quantiles, np.quantile(values, SHARES), atol=1e-12)


def test_a_missed_target_is_found_in_the_whole_group(spark, monkeypatch):
    def astray(targets):
        return targets.withColumns({"lo": F.lit(1e9), "hi": F.lit(2e9)}).drop("cuts")

    monkeypatch.setattr(quantiles, "_narrow", astray)
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    (row,) = exact_quantiles(df, ["g"], "v", SHARES).collect()
    np.testing.assert_allclose(row.quantiles, np.quantile(np.arange(1000), SHARES))


def test_no_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", [0.5]).count() == 0


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r.g: r.quantiles[0] for r in exact_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_keys_have_the_order_of_the_numbers(spark):
    import struct

    rng = np.random.default_rng(5)
    bits = np.concatenate([rng.integers(-(2**63), 2**63 - 1, 3000), [0, 1, 2, 2**52 - 1, 2**52, 2**52 + 1, 2047 * 2**52, 2047 * 2**52 - 1]])
    powers = [s * 2.0**e * f for e in range(-1074, 1024) for s in (1, -1) for f in (1.0, 1 - 2.0**-53, 1 + 2.0**-52)]
    values = [v for v in np.concatenate([bits.view(np.float64), powers]) if not np.isnan(v)]
    got = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", quantiles.sort_key(F.col("v")).alias("k")).collect()
    for row in got:
        own = struct.unpack("<q", struct.pack("<d", abs(row.v)))[0]
        assert row.k == (-own if row.v < 0 else own)


@pytest.mark.parametrize("scale", [1e-300, 1.0, 1e300])
def test_all_four_passes(spark, scale):
    """Slices of one row only, over values whose keys differ in their last bits."""
    base = np.nextafter(scale, np.inf) + np.spacing(scale) * np.arange(300)
    values = np.concatenate([base, -base, [0.0, -0.0, 5e-324, np.inf, np.inf]])
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("h", 2.5)] * 7, "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", [0.0, 0.3, 0.5, 0.9], 1).collect()}
    np.testing.assert_array_equal(got["g"].quantiles, np.quantile(values, [0.0, 0.3, 0.5, 0.9]))
    assert got["h"].quantiles == [2.5] * 4 and got["h"].n == 7
