from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ebbtide import session
from ebbtide.operators import cohort
from ebbtide.queries import cohorts
from ebbtide.sources import sample_views as views

LINES = (
    "l_orderkey long, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"
)
N_ORDERS, N_CUSTOMERS = 900, 120


@pytest.fixture
def tables(spark, folder):
    """Three lines an order; lines without order, orders without customer, null keys, nulls, one account with many."""
    line = [
        (o, 100.25 + o % 37 + i, 0.01 * (o % 11), 0.01 * (i + 1), "RAN"[(o + i) % 3], datetime(2000 + i, 1 + o % 12, 3))
        for o in range(N_ORDERS + 5)
        for i in range(3)
    ]
    line += [(None, 5.0, 0.1, 0.1, "R", datetime(2000, 1, 1)), (7, None, None, None, None, datetime(2000, 1, 1)), (8, 5.0, 0.1, 0.1, "R", None)]
    order = [(o, None if o % 50 == 49 else 3 if o % 4 == 0 else o % (N_CUSTOMERS + 4)) for o in range(N_ORDERS)]
    customer = [(c, f"SEGMENT {c % 5}") for c in range(N_CUSTOMERS)] + [(None, "NONE")]
    spark.createDataFrame(line, LINES).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(order, "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(customer, "c_custkey long, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    account, code = dict(order), dict(customer)
    months = defaultdict(list)
    for o, price, *_, shipped in line:
        if account.get(o) in code and account.get(o) is not None:
            months[account[o], shipped and shipped.date().replace(day=1)].append(price)
    sums = {k: sum(known) if (known := [p for p in v if p is not None]) else None for k, v in months.items()}
    return folder, {(code[a], a, m): total for (a, m), total in sums.items()}


def test_no_task_holds_more_keys_than_its_share(spark, tables, monkeypatch):
    folder, expected = tables
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = cohorts.dedupe_keys(spark, folder).withColumn("task", F.spark_partition_id()).collect()
    got = {(r.product_code, r.account_id, r.reporting_period): r.period_balance for r in rows}
    assert len(rows) == len(got) and got == pytest.approx(expected)
    assert {r.load_no for r in rows} == {1}
    held = defaultdict(int)
    for r in rows:
        held[r.task] += 1
    assert max(held.values()) <= 150  # of 821; adaptive execution would give all of them to one task


def test_partitions_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [session.row_partitions(spark, n) for n in (0, 1, session.TASK_ROWS)] == [1, 1, cores]
    assert session.row_partitions(spark, 100 * session.TASK_ROWS + 1) == 101


def _shuffles(df, capture):
    df.explain()
    return [line.partition("hashpartitioning(")[2] for line in capture.readouterr().out.splitlines() if "Exchange hashpartitioning(" in line]


def test_account_months_are_dealt_by_account_once(spark, tables, monkeypatch, capsys):
    folder, _ = tables
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = _shuffles(views.account_month(spark, folder), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(shuffles) == 4  # lines and orders by order; their join and the customers by account
    assert sum(s.startswith("account_id#") for s in shuffles) == 2


def test_distinct_accounts_are_sent_once_for_all_their_ages(spark, capsys):
    columns = "cohort date, product string, months_since_start int, account_id long, reporting_period date, tenure_months int"
    money = ["period_balance", "withdrawal", "receipt", "internal_transfer", "interest_rate"]
    jan, feb = date(2023, 1, 1), date(2023, 2, 1)
    some = [(jan, "P", 1, a, feb, 1) for a in (1, 1, 2, None)] + [(jan, "P", 2, 1, feb, 1), (jan, "Q", 1, 1, feb, 1), (feb, "P", 1, None, feb, 1)]
    some += [(None, "P", 1, 9, feb, 1), (jan, None, 1, 9, feb, 1), (jan, "P", None, 9, feb, 1)]
    rows = spark.createDataFrame(some, columns).withColumns({m: F.lit(1).cast("decimal(18,2)") for m in money})
    found = cohort.aggregate_cohorts(rows)
    got = {(r.cohort, r.product, r.months_since_start): (r.n_accounts, r.balance) for r in found.collect()}
    assert got == {(jan, "P", 1): (2, 4.0), (jan, "P", 2): (1, 1.0), (jan, "Q", 1): (1, 1.0), (feb, "P", 1): (0, 1.0)}
    assert not any("account_id" in s and "months_since_start" in s for s in _shuffles(found, capsys))
