"""The windowed projection against a plain month-by-month loop."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import project
from ebbtide.session import materialize

SCHEMA = (
    "cohort string, product string, reporting_period date, months_since_start int, balance_lag_1 double, "
    "rec_pct_pred double, outflow_pct_pred double, transfer_pct_pred double"
)


def month(i):
    return date(2020 + i // 12, i % 12 + 1, 1)


def loop(rows):
    """(lag, ratios) row after row; a projected balance replaces the next row's lag."""
    out, carried = [], None
    broken = False
    for _, _, _, age, lag, rec, outflow, transfer in rows:
        if carried is not None:
            lag, carried = carried, None
        if age == 1:
            broken = False
            out.append((lag, 0.0, 0.0, 0.0))
        elif broken or lag is None:
            out.append((None,) * 4)
        elif rec is None:
            broken = True
            out.append((None,) * 4)
        else:
            outflows = lag * outflow
            carried = lag + lag * rec - outflows
            out.append((carried, lag * rec, outflows - outflows * transfer, outflows * transfer))
    return out


def random_series(rng, name):
    n = int(rng.integers(1, 25))
    ages = np.cumsum(rng.integers(1, 3, n)) - int(rng.integers(0, 2))
    rows = []
    for i, age in enumerate(ages):
        lag = None if rng.random() < 0.25 else float(rng.uniform(0, 1000))
        ratios = [float(rng.uniform(0, 0.3)), float(rng.choice([0.0, 0.2, 1.0])), float(rng.uniform())]
        if rng.random() < 0.05:
            ratios = [None] * 3
        rows.append((name, "P", month(i), int(age), lag, *ratios))
    return rows


def test_against_a_loop(spark):
    rng = np.random.default_rng(11)
    series = {f"c{i:03d}": random_series(rng, f"c{i:03d}") for i in range(150)}
    df = spark.createDataFrame([r for rows in series.values() for r in rows], SCHEMA)
    got = {(r.cohort, r.reporting_period): r for r in project.project(df).collect()}
    checked = 0
    for name, rows in series.items():
        for row, expected in zip(rows, loop(rows)):
            mine = got[(name, row[2])]
            actual = (mine.balance_pred, mine.receipts_pred, mine.withdrawals_pred, mine.transfers_pred)
            for a, e in zip(actual, expected):
                assert (a is None) == (e is None), (name, row, actual, expected)
                if e is not None:
                    assert a == pytest.approx(e, rel=1e-10, abs=1e-9)
            checked += 1
    assert checked == len(got) > 1000


def test_opening_row_after_a_projected_row_echoes_it(spark):
    rows = [("c", "P", month(0), 5, 100.0, 0.1, 0.0, 0.0), ("c", "P", month(1), 1, 7.0, 0.1, 0.0, 0.0), ("c", "P", month(2), 2, 50.0, 0.0, 0.5, 0.0)]
    got = project.project(spark.createDataFrame(rows, SCHEMA)).orderBy("reporting_period").collect()
    assert [r.balance_pred for r in got] == pytest.approx([110.0, 110.0, 25.0])


def test_missing_ratio_is_flagged(spark):
    rows = [("c", "P", month(i), i + 2, 100.0, None if i == 1 else 0.1, 0.0, 0.0) for i in range(3)]
    got = project.project(spark.createDataFrame(rows, SCHEMA)).orderBy("reporting_period").collect()
    assert [r.missing_ratio for r in got] == [False, True, False]
    assert [r.balance_pred for r in got][1:] == [None, None]


def test_lookup_holds_ages_inside_the_table(spark):
    table = spark.createDataFrame(
        [("P", age, b, 10.0 * age + b, 1.0, 2.0) for age in (2, 3) for b in range(2)],
        "product string, months_since_start int, bin_id int, rec_pct double, outflow_pct double, transfer_pct double",
    )
    rows = spark.createDataFrame([("P", 1, 0), ("P", 9, 1), ("P", 3, None), ("Q", 2, 0)], "product string, months_since_start int, bin_id int")
    got = {(r.months_since_start, r.bin_id): r.rec_pct_pred for r in project.lookup_ratios(rows, table).collect()}
    assert got == {(1, 0): 0.2, (9, 1): 0.31, (3, None): None}


def test_row_errors_and_period_filter(spark):
    rows = spark.createDataFrame([(month(0), 10.0, 12.0), (month(1), 0.0, 1.0), (month(2), None, 1.0)], "reporting_period date, balance double, balance_pred double")
    for m in ("receipts", "withdrawals", "transfers"):
        rows = rows.withColumn(m, F.lit(None).cast("double")).withColumn(f"{m}_pred", F.lit(1.0))
    assert [r.ape_balance for r in project.add_row_errors(rows).orderBy("reporting_period").collect()] == [0.2, None, None]
    assert project.between_periods(rows, "2020-01-01", "2020-02-01").count() == 2


@pytest.mark.parametrize("cuts", [(6,), (1, 2, 3, 10, 20), (12, 15)])
def test_resumed_projection_equals_the_whole(spark, cuts):
    rng = np.random.default_rng(len(cuts))
    rows = [r for i in range(120) for r in random_series(rng, f"c{i:03d}")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.col("months_since_start") * 2)
    columns = ["cohort", "reporting_period", "balance_pred", "receipts_pred", "withdrawals_pred", "balance_lag_1", "rec_pct_pred", "missing_ratio", "extra"]
    whole = {(r.cohort, r.reporting_period): r for r in project.project(df).select(*columns).collect()}
    state, seen, start = None, 0, None
    for end in (*cuts, None):
        part = df if start is None else df.filter(F.col("reporting_period") > F.lit(month(start)))
        part = part if end is None else part.filter(F.col("reporting_period") <= F.lit(month(end)))
        done = materialize(project.project(part) if state is None else project.resume(part, state), "part")
        state = materialize(project.end_state(done, state), "state")
        start = end
        assert state.count() == state.select("cohort").distinct().count()
        for r in done.select(*columns).collect():
            want = whole[(r.cohort, r.reporting_period)]
            for c in columns:
                assert r[c] == (pytest.approx(want[c], rel=1e-9, abs=1e-9) if isinstance(want[c], float) else want[c]), (c, r, want)
            seen += 1
    assert seen == len(whole) > 800
