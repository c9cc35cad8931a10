"""Shared pieces of the checking SQL. They state the semantics step by step, not the plan the operators use."""

from __future__ import annotations

from ebbtide.constants import RATE_EDGES, RATE_LABELS


def with_ctes(ctes: list[str], body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + body


def divide(a: str, b: str) -> str:
    """x/0 is signed infinity, 0/0 is null."""
    return (
        f"CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN 'Infinity'::DOUBLE "
        f"WHEN ({a}) < 0 THEN '-Infinity'::DOUBLE END ELSE ({a}) / ({b}) END"
    )


def bin_case(gap: str) -> str:
    arms = " ".join(f"WHEN {gap} <= {edge} THEN {i}" for i, edge in enumerate(RATE_EDGES))
    return f"CASE WHEN {gap} IS NULL THEN NULL {arms} ELSE {len(RATE_EDGES)} END"


def label_case(bin_id: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(RATE_LABELS))
    return f"CASE {bin_id} {arms} END"


ACCOUNT_CTES = [
    """lines AS (
  SELECT o_custkey, c_mktsegment, date_trunc('month', l_shipdate)::DATE AS rp, l_returnflag AS f,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS e, CAST(l_discount AS DECIMAL(6,2)) AS d,
         CAST(l_tax AS DECIMAL(6,2)) AS t
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)""",
    """monthly AS (
  SELECT o_custkey AS account_id, c_mktsegment AS product_code, rp AS reporting_period,
         sum(e) AS period_balance,
         sum(CASE WHEN f = 'R' THEN e*d*5 ELSE 0 END) AS withdrawal,
         sum(e*t*5) AS receipt,
         sum(CASE WHEN f = 'A' THEN e*d*5 ELSE 0 END) AS internal_transfer,
         CAST(CAST(sum(d) AS DOUBLE) / count(*) * 10 AS DECIMAL(18,10)) AS interest_rate
  FROM lines GROUP BY 1, 2, 3)""",
    "opened AS (SELECT *, min(reporting_period) OVER (PARTITION BY account_id) AS opening_date FROM monthly)",
    """account_month AS (
  SELECT *, (year(reporting_period) - year(opening_date)) * 12
            + (month(reporting_period) - month(opening_date)) + 1 AS tenure_months FROM opened)""",
]
RATE_CTES = [
    """best_buy AS (
  SELECT reporting_period AS period, product_code AS mapping_category, max(interest_rate) AS best_buy
  FROM account_month GROUP BY 1, 2)"""
]


def matrix_ctes(name: str = "matrix", accounts: str = "account_month") -> list[str]:
    """The cohort matrix, joined to the rates account by account and aggregated afterwards.

    All accounts of a row share one month, so the highest market rate is also their mean.
    """
    return [
        f"""{name}_rated AS (
  SELECT a.*, b.best_buy, opening_date AS cohort, product_code AS product
  FROM {accounts} a LEFT JOIN best_buy b ON b.period = a.reporting_period AND b.mapping_category = a.product_code
  WHERE a.reporting_period <= (SELECT max(period) FROM best_buy))""",
        f"""{name}_sums AS (
  SELECT cohort, product, CAST(tenure_months AS INTEGER) AS months_since_start,
         max(reporting_period) AS reporting_period,
         CAST(sum(period_balance) AS DOUBLE) AS balance, CAST(sum(withdrawal) AS DOUBLE) AS withdrawals,
         CAST(sum(receipt) AS DOUBLE) AS receipts, CAST(sum(internal_transfer) AS DOUBLE) AS transfers,
         CAST(sum(interest_rate) AS DOUBLE) / count(interest_rate) AS int_rate,
         CAST(max(best_buy) AS DOUBLE) AS best_buy,
         avg(tenure_months) AS tenure_months, count(DISTINCT account_id) AS n_accounts
  FROM {name}_rated GROUP BY 1, 2, 3)""",
        f"""{name}_lagged AS (
  SELECT *, CASE WHEN lag(balance) OVER s = 0 THEN 1 ELSE lag(balance) OVER s END AS balance_lag_1
  FROM {name}_sums WINDOW s AS (PARTITION BY cohort, product ORDER BY months_since_start))""",
        f"""{name}_ratios AS (
  SELECT *, {divide('receipts', 'balance_lag_1')} AS rec_prop,
         {divide('withdrawals + transfers', 'receipts + balance_lag_1')} AS outflow_prop,
         {divide('withdrawals', 'withdrawals + transfers')} AS withdrawal_prop_of_outflow,
         int_rate - best_buy AS delta_to_best_buy
  FROM {name}_lagged)""",
        f"{name}_binned AS (SELECT *, {bin_case('delta_to_best_buy')} AS bin_id FROM {name}_ratios)",
        f"{name} AS (SELECT *, {label_case('bin_id')} AS dbb_range FROM {name}_binned)",
    ]


MATRIX_CTES = ACCOUNT_CTES + RATE_CTES + matrix_ctes()

FEATURE_CTES = MATRIX_CTES + [
    """invalid AS (SELECT DISTINCT cohort, product FROM matrix WHERE outflow_prop > 1)""",
    """steps AS (
  SELECT m.cohort, m.product, n_accounts - lag(n_accounts) OVER (PARTITION BY m.cohort, m.product
         ORDER BY months_since_start) AS step
  FROM matrix m JOIN invalid i ON m.cohort = i.cohort AND m.product = i.product)""",
    "grown AS (SELECT cohort, product FROM steps GROUP BY 1, 2 HAVING coalesce(bool_or(step > 0), false))",
    """features AS (
  SELECT cohort, product, months_since_start, reporting_period, balance, withdrawals, receipts, transfers,
         int_rate, best_buy, tenure_months, n_accounts, balance_lag_1, rec_prop,
         CASE WHEN outflow_prop > 1 THEN 1 ELSE outflow_prop END AS outflow_prop,
         coalesce(withdrawal_prop_of_outflow, 0) AS withdrawal_prop_of_outflow, delta_to_best_buy, bin_id, dbb_range
  FROM matrix m WHERE NOT EXISTS (SELECT 1 FROM grown g WHERE g.cohort = m.cohort AND g.product = m.product))""",
]

MATRIX_OUTPUT = """strftime(cohort, '%Y-%m') AS cohort, product, months_since_start,
  strftime(reporting_period, '%Y-%m') AS reporting_period, balance, withdrawals, receipts, transfers,
  int_rate, best_buy, tenure_months, n_accounts, balance_lag_1, rec_prop, outflow_prop,
  withdrawal_prop_of_outflow, delta_to_best_buy, bin_id, dbb_range"""

# Ratio table that needs no fit.
GIVEN_RATIO_CTES = [
    """means AS (SELECT product, round(avg(rec_prop), 6) AS rec_mean, round(avg(outflow_prop), 6) AS out_mean,
  round(avg(withdrawal_prop_of_outflow), 6) AS wd_mean FROM features GROUP BY 1)""",
    """given_pred AS (SELECT product, CAST(a.range AS INTEGER) AS months_since_start, CAST(b.range AS INTEGER) AS bin_id,
  rec_mean * 0.5::DOUBLE * (b.range * 0.01::DOUBLE + 1) / (a.range * 0.002::DOUBLE + 1) AS rec_pred,
  out_mean * (1 - b.range * 0.01::DOUBLE) AS outflow_pred, wd_mean / (a.range * 0.002::DOUBLE + 1) AS wd_pred
  FROM means CROSS JOIN range(2, 61) a CROSS JOIN range(0, 11) b)""",
    f"""given AS (SELECT product, months_since_start, bin_id, {label_case('bin_id')} AS rate_bin,
  rec_pred * 100 AS rec_pct, outflow_pred * (1 + rec_pred) * 100 AS outflow_pct, (1 - wd_pred) * 100 AS transfer_pct
  FROM given_pred)""",
]


def projection_ctes(rows: str, table: str) -> list[str]:
    """The month-by-month recursion, row after row: the new balance replaces the next row's lag."""
    return [
        f"""numbered AS (SELECT r.*, row_number() OVER (PARTITION BY r.cohort, r.product ORDER BY reporting_period) AS rn,
  rec_pct / 100 AS rec, outflow_pct / 100 AS outf, transfer_pct / 100 AS tr
  FROM {rows} r LEFT JOIN {table} t ON t.product = r.product AND t.bin_id = r.bin_id AND t.months_since_start =
    greatest((SELECT min(months_since_start) FROM {table} x WHERE x.product = r.product),
             least(r.months_since_start, (SELECT max(months_since_start) FROM {table} x WHERE x.product = r.product))))""",
        """walk AS (
  SELECT cohort, product, rn, months_since_start, rec, outf, tr, balance_lag_1 AS used_lag FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.cohort, n.product, n.rn, n.months_since_start, n.rec, n.outf, n.tr,
         CASE WHEN w.months_since_start <> 1 AND w.used_lag IS NOT NULL
              THEN w.used_lag + w.used_lag * w.rec - w.used_lag * w.outf ELSE n.balance_lag_1 END
  FROM walk w JOIN numbered n ON n.cohort = w.cohort AND n.product = w.product AND n.rn = w.rn + 1)""",
        """projected AS (
  SELECT n.* EXCLUDE (balance_lag_1), w.used_lag AS balance_lag_1,
    CASE WHEN n.months_since_start = 1 THEN w.used_lag ELSE w.used_lag + w.used_lag*n.rec - w.used_lag*n.outf END AS balance_pred,
    CASE WHEN n.months_since_start = 1 THEN 0 ELSE w.used_lag * n.rec END AS receipts_pred,
    CASE WHEN n.months_since_start = 1 THEN 0 ELSE w.used_lag * n.outf * n.tr END AS transfers_pred,
    CASE WHEN n.months_since_start = 1 THEN 0 ELSE w.used_lag * n.outf * (1 - n.tr) END AS withdrawals_pred
  FROM numbered n JOIN walk w ON w.cohort = n.cohort AND w.product = n.product AND w.rn = n.rn)""",
    ]


def prediction_ctes(landed_until: str) -> list[str]:
    money = "CAST({0} AS DECIMAL(20,4))"
    landed = f"CASE WHEN reporting_period < DATE '{landed_until}' THEN {{0}} END"
    actuals = ", ".join(f"{landed.format(money.format(m))} AS {m}" for m in ("balance", "receipts", "withdrawals", "transfers"))
    return [
        f"""predictions AS (SELECT product, cohort, reporting_period, months_since_start, {actuals},
  CAST(balance_lag_1 * (batch * 0.01::DOUBLE + 0.95::DOUBLE) AS DECIMAL(20,4)) AS balance_pred,
  {money.format('receipts')} + batch * 10 AS receipts_pred, {money.format('withdrawals')} + batch * 5 AS withdrawals_pred,
  {money.format('transfers')} - batch AS transfers_pred,
  rec_prop * (batch * 0.05::DOUBLE + 0.9::DOUBLE) AS rec_pct_pred,
  outflow_prop * (batch * 0.05::DOUBLE + 0.9::DOUBLE) AS outflow_pct_pred,
  1 - withdrawal_prop_of_outflow AS transfer_pct_pred,
  TIMESTAMP '2024-01-01' + to_days(CAST(batch AS INTEGER)) AS scored_at, CAST(batch AS VARCHAR) AS model_version
  FROM features CROSS JOIN (VALUES (1), (2), (3)) v(batch))"""
    ]


VERSION_LOG_CTES = [
    """version_log AS (
  SELECT user_id AS model_name, event_id AS version, 'registered' AS event, ts AS event_ts, value AS metric FROM events
  UNION ALL
  SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 'promoted' ELSE 'rejected' END, ts + INTERVAL 1 MINUTE, value
  FROM events WHERE event_type IN ('purchase', 'error'))"""
]
