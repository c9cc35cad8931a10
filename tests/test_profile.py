"""Profiles against numpy and exact fractions."""

from __future__ import annotations

from datetime import date, datetime
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators.profile import profile, profiles

VALUES = {
    "tiny": [1e-9, 3e-9, 2e-9],
    "huge": [1e22, 3e22, -2e22],
    "mixed": [1e22, 1.0, -1e22, 3.0],
    "least": [5e-324, 5e-324],
    "largest": [1.7e308, 1.7e308, 1.6e308],
    "cents": [0.1] * 1000,
    "one": [7.25],
    "zero": [0.0, -0.0],
}


def test_mean_is_of_the_values_as_they_are(spark):
    rows = [(k, v) for k, values in VALUES.items() for v in values] + [("none", None), ("inf", float("inf")), ("inf", 1.0), ("tiny", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in profile(df, ["v"], ["g"]).collect()}
    for name, values in VALUES.items():
        exact = sum(map(Fraction, values)) / len(values)
        assert got[name].mean == pytest.approx(float(exact), rel=1e-15, abs=0), name
        assert got[name].minimum <= got[name].mean <= got[name].maximum
        if len(values) > 1 and name not in ("largest", "mixed"):
            assert got[name].deviation == pytest.approx(np.std(values, ddof=1), rel=1e-9, abs=1e-12)
    assert got["tiny"].null_rate == 0.25 and got["tiny"].n_rows == 4
    assert got["none"].mean is None and got["none"].n_distinct == 0 and got["one"].deviation is None
    assert got["inf"].mean == float("inf")


def test_all_windows_in_one_go(spark):
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 9_000)
    value = F.when(F.col("id") % 11 == 0, None).otherwise(F.round(F.sin(F.col("id").cast("double")), 2))
    df = spark.range(800).select(stamp.alias("ts"), (F.col("id") % 2).alias("n"), value.alias("v"), (F.col("id") % 7).alias("w"))
    together = {(r.granularity, r.window_start, r.n, r.column_name): r.asDict() for r in profiles(df, ["v", "w"], ["n"], "ts").collect()}
    seen = 0
    for granularity in ("day", "week", "month", "total"):
        alone = profile(df, ["v", "w"], ["n"], "ts" if granularity != "total" else None, granularity)
        for r in alone.collect():
            other = together[(granularity, r.asDict().get("window_start"), r.n, r.column_name)]
            for name, x in r.asDict().items():
                assert other[name] == (pytest.approx(x, rel=1e-12) if isinstance(x, float) else x)
            seen += 1
    assert seen == len(together) > 100
    assert {k[1] for k in together if k[0] == "week"} >= {date(2023, 11, 13)} and datetime(2023, 11, 13).weekday() == 0
    assert profiles(df.limit(0), ["v"], ["n"], "ts").count() == 0
