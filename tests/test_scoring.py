"""Accounts to stored predictions, end to end."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide.constants import MARKET_CATEGORY
from ebbtide.operators import cohort, metrics
from ebbtide.plans import scoring
from ebbtide.schemas import PREDICTIONS

ACCOUNTS = (
    "account_id string, product_code string, opening_date date, reporting_period date, period_balance double, "
    "withdrawal double, receipt double, internal_transfer double, interest_rate double, tenure_months int"
)


def test_score_accounts(spark):
    def row(i, balance):
        return ("a", "P", date(2024, 1, 5), date(2024, i, 1), balance, 1.0, 2.0, 0.0, 1.0, i)

    accounts = spark.createDataFrame([row(i, b) for i, b in enumerate((100.0, 110.0, 120.0, 130.0), 1)], ACCOUNTS)
    rates = spark.createDataFrame([(date(2024, i, 1), "EA ISA (Online)", 1.2) for i in range(1, 5)], "period date, mapping_category string, best_buy double")
    products = spark.createDataFrame([("P", "HL ISA")], "product_code string, category string")
    cut = F.lit("2024-03-01").cast("date")
    training = cohort.cohort_matrix(accounts.filter(F.col("reporting_period") < cut), rates, products, MARKET_CATEGORY)
    ratios = spark.createDataFrame(
        [("HL ISA", age, b, 10.0, 5.0, 40.0) for age in (2, 3) for b in range(11)],
        "product string, months_since_start int, bin_id int, rec_pct double, outflow_pct double, transfer_pct double",
    )
    scored = scoring.score_accounts(
        accounts.filter(F.col("reporting_period") >= cut), rates, training, ratios, "2024-05-01 00:00:00", "m", "7",
        products=products, mapping=MARKET_CATEGORY,
    )
    assert scored.schema.fieldNames() == PREDICTIONS.fieldNames()
    third, fourth = scored.orderBy("reporting_period").collect()
    assert third.balance_pred == pytest.approx(110 * 1.05) and fourth.balance_pred == pytest.approx(110 * 1.05**2)
    assert third.receipts_pred == pytest.approx(11.0) and third.transfers_pred == pytest.approx(110 * 0.05 * 0.4)
    assert third.ape_balance == pytest.approx(abs(120 - 115.5) / 120) and third.model_version == "7"
    assert scored.select(scoring.served_version(scored).alias("v")).first().v == "7"
    fed = metrics.with_later_actuals(scored.withColumn("balance", F.lit(None).cast("double")), cohort.cohort_matrix(accounts, rates, products, MARKET_CATEGORY))
    assert [r.balance for r in fed.orderBy("reporting_period").collect()] == [120.0, 130.0]
