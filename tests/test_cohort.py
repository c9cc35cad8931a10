from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide.constants import MARKET_CATEGORY, RATE_EDGES, RATE_LABELS
from ebbtide.functions.dates import age_in_months
from ebbtide.functions.ratios import cap_at_one, ieee_divide, rate_bin, rate_label, rate_midpoints
from ebbtide.operators import cohort
from ebbtide.sources.readers import nan_to_null

ACCOUNTS = (
    "account_id string, product_code string, opening_date date, reporting_period date, period_balance double, "
    "withdrawal double, receipt double, internal_transfer double, interest_rate double, tenure_months int"
)


def account(i, month, balance, opened=date(2023, 1, 9), code="P", wd=0.0, rec=0.0, tr=0.0, rate=1.0):
    return (i, code, opened, month, balance, wd, rec, tr, rate, 1)


def rates(spark, rows):
    return spark.createDataFrame(rows, "period date, mapping_category string, best_buy double")


def months(n, year=2023):
    return [date(year + (m - 1) // 12, (m - 1) % 12 + 1, 1) for m in range(1, n + 1)]


def flat_rates(spark, n=12):
    return rates(spark, [(m, "P", 1.5) for m in months(n)])


def test_labels_are_one_more_than_edges():
    assert len(RATE_LABELS) == len(RATE_EDGES) + 1 == len(rate_midpoints())
    assert rate_midpoints()[0] == -1.5 and rate_midpoints()[-1] == pytest.approx(0.075)


@pytest.mark.parametrize(
    "gap, label",
    [
        (-1.0, "(-inf, -1)"), (-0.05, "[-0.1, -0.05)"), (0.0, "[-0.05, 0)"), (0.01, "[0, 0.05)"), (0.05, "[0, 0.05)"),
        (0.06, "[0.05, inf)"), (None, None), (float("nan"), None),
    ],
)
def test_bins_are_closed_on_the_right(spark, gap, label):
    row = spark.createDataFrame([(gap,)], "g double").select(rate_label(rate_bin(F.col("g"))).alias("l")).first()
    assert row.l == label


def test_division_by_zero(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    got = [r.q for r in rows.select(ieee_divide(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [float("inf"), float("-inf"), None, None, None, 0.25]


def test_cap_keeps_null_and_negative(spark):
    rows = spark.createDataFrame([(None,), (-2.0,), (float("inf"),), (0.5,)], "x double")
    assert [r.c for r in rows.select(cap_at_one(F.col("x")).alias("c")).collect()] == [None, -2.0, 1.0, 0.5]


def test_age_ignores_the_day(spark):
    row = spark.range(1).select(age_in_months(F.lit(date(2024, 3, 1)), F.lit(date(2023, 12, 31))).alias("a")).first()
    assert row.a == 4


def test_matrix_values(spark):
    m1, m2 = months(2)
    rows = [
        account("a", m1, 100.0), account("b", m1, 50.0, rate=2.0),
        account("a", m2, 90.0, wd=20.0, rec=15.0, tr=10.0), account("a", m2, 1.0), account(None, m2, 0.0),
    ]
    accounts = spark.createDataFrame(rows, ACCOUNTS)
    first, second = cohort.cohort_matrix(accounts, flat_rates(spark)).orderBy("months_since_start").collect()
    assert (first.balance, first.n_accounts, first.int_rate, first.balance_lag_1) == (150.0, 2, 1.5, None)
    assert (second.balance, second.n_accounts, second.balance_lag_1) == (91.0, 1, 150.0)
    assert second.rec_prop == 0.1 and second.outflow_prop == 30.0 / 165.0
    assert second.withdrawal_prop_of_outflow == 20.0 / 30.0
    assert first.withdrawal_prop_of_outflow is None
    assert second.delta_to_best_buy == -0.5 and second.dbb_range == "[-0.75, -0.5)"


def test_zero_lag_becomes_one_and_gaps_are_not_filled(spark):
    m = months(5)
    rows = [account("a", m[0], 0.0), account("a", m[1], 10.0, rec=10.0), account("a", m[4], 5.0)]
    got = cohort.cohort_matrix(spark.createDataFrame(rows, ACCOUNTS), flat_rates(spark)).orderBy("months_since_start").collect()
    assert [r.balance_lag_1 for r in got] == [None, 1.0, 10.0]
    assert [r.months_since_start for r in got] == [1, 2, 5]


def test_repeated_rates_do_not_multiply_accounts(spark):
    m = months(1)[0]
    twice = rates(spark, [(m, "P", 1.0), (m, "P", 2.0)])
    row = cohort.cohort_matrix(spark.createDataFrame([account("a", m, 7.0)], ACCOUNTS), twice).first()
    assert row.balance == 7.0 and row.best_buy == 1.5


def test_missing_sums_are_zero_and_null_keys_are_dropped(spark):
    m = months(1)[0]
    rows = [account("a", m, None), account("b", m, 1.0, opened=None)]
    got = cohort.cohort_matrix(spark.createDataFrame(rows, ACCOUNTS), flat_rates(spark)).collect()
    assert [(r.balance, r.n_accounts) for r in got] == [(0.0, 1)]


def test_months_beyond_the_rates_and_unassigned_products_are_left_out(spark):
    m = months(3)
    rows = [account("a", m[0], 1.0), account("a", m[2], 1.0), account("b", m[0], 1.0, code="X"), account("c", m[0], 1.0, code="U")]
    products = spark.createDataFrame([("P", "HL ISA"), ("U", "default unassigned")], "product_code string, category string")
    table = rates(spark, [(m[0], "EA ISA (Online)", 2.0), (m[1], "EA ISA (Online)", 2.0)])
    got = cohort.cohort_matrix(spark.createDataFrame(rows, ACCOUNTS), table, products, MARKET_CATEGORY).collect()
    assert [(r["product"], r.months_since_start, r.best_buy) for r in got] == [("HL ISA", 1, 2.0)]


def test_only_grown_series_with_excess_outflow_are_excluded(spark):
    def series(product, excess, counts):
        return [("2023-01-01", product, i + 1, n, 1.5 if excess and i == 1 else 0.2) for i, n in enumerate(counts)]

    rows = series("both", True, [1, 2, 1]) + series("excess", True, [3, 2, 2]) + series("growth", False, [1, 2, 3])
    matrix = spark.createDataFrame(rows, "cohort string, product string, months_since_start int, n_accounts long, outflow_prop double")
    kept = cohort.exclude_grown_series(matrix)
    assert {r["product"] for r in kept.collect()} == {"excess", "growth"}
    features = cohort.training_features(matrix.withColumn("withdrawal_prop_of_outflow", F.lit(None).cast("double")))
    assert features.agg(F.max("outflow_prop")).first()[0] == 1.0
    assert {r.withdrawal_prop_of_outflow for r in features.collect()} == {0.0}


def test_seed_modes(spark):
    m = months(6)
    schema = "cohort date, product string, reporting_period date, balance double"
    training = spark.createDataFrame([(m[0], "P", m[0], 10.0), (m[0], "P", m[1], 20.0), (m[0], "P", m[2], None)], schema)
    batch = spark.createDataFrame(
        [(m[0], "P", m[1], None), (m[0], "P", m[3], None), (m[0], "Q", m[3], None), (m[0], "P", m[4], 0.0)],
        "cohort date, product string, reporting_period date, balance_lag_1 double",
    )
    after = {(r["product"], r.reporting_period): r.balance_lag_1 for r in cohort.seed_lags(batch, training).collect()}
    assert after == {("P", m[1]): None, ("P", m[3]): 20.0, ("Q", m[3]): None, ("P", m[4]): 1.0}
    always = {(r["product"], r.reporting_period): r.balance_lag_1 for r in cohort.seed_lags(batch, training, "always").collect()}
    assert always[("P", m[1])] == 20.0
    with pytest.raises(ValueError):
        cohort.seed_lags(batch, training, "sometimes")


def test_first_row_of_a_key_stays(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b")], "k int, o int, v string")
    assert sorted(tuple(r) for r in cohort.keep_first_per_key(df, ["k"], ["o"]).collect()) == [(1, 1, "a"), (2, 2, "b")]


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), "x")], "a double, b string"))
    assert df.first().a is None


@pytest.mark.parametrize("kind", ["int", "date", "timestamp", "double"])
def test_first_rows_are_whole_and_picked_without_a_sort(spark, kind):
    rows = [(i % 3, None if i == 4 else i % 5, i, 10 * i) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, o int, a int, b int")
    if kind == "date":
        df = df.withColumn("o", F.date_add(F.lit("2000-01-01").cast("date"), F.col("o")))
    elif kind == "timestamp":
        df = df.withColumn("o", F.timestamp_seconds("o"))
    elif kind == "double":
        df = df.withColumn("o", F.when(F.col("o") == 4, float("nan")).otherwise(F.col("o") - 2.5))
    kept = cohort.keep_first_per_key(df, ["k"], ["o"])
    got = {r.k: r for r in kept.collect()}
    assert got[1].o is None and got[1].a == 4  # nulls first
    assert got[0].o == got[2].o == df.agg(F.min("o")).first()[0]
    assert all(r.b == 10 * r.a and rows[r.a][0] == k and (rows[r.a][1] or 0) == 0 for k, r in got.items())
    plan = kept._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
    wide = cohort.keep_first_per_key(df.withColumn("v", F.col("a").cast("string")), ["k"], ["o"])
    assert {r.k: (r.o, r.a) for r in wide.collect()}[1] == (None, 4) and all(r.v == str(r.a) for r in wide.collect())
    both = cohort.keep_first_per_key(df, ["k"], ["o", "b"])
    assert {(r.k, r.a) for r in both.collect()} == {(0, 0), (1, 4), (2, 5)}
