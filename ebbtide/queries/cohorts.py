"""Cohort matrix, exclusion, mapping, lag seeding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.constants import MARKET_CATEGORY
from ebbtide.functions.dates import age_in_months, month_start, month_text
from ebbtide.operators import cohort
from ebbtide.queries import base_sql as sql
from ebbtide.queries import inputs
from ebbtide.session import materialize
from ebbtide.sources import sample_views as views

# Product categories given to the five market segments in the mapping query.
SEGMENT_CATEGORY = {
    "AUTOMOBILE": "Variable ISA (Online)",
    "BUILDING": "HL ISA",
    "FURNITURE": "Restricted ISA",
    "HOUSEHOLD": "Travel Money",
    "MACHINERY": "default unassigned",
}
# Fixed value: first month that counts as the scoring batch.
BATCH_START = "2000-07-01"


def cohort_matrix(spark, sf_dir):
    return inputs.matrix_output(inputs.matrix(spark, sf_dir))


def cohort_features(spark, sf_dir):
    return inputs.matrix_output(inputs.features(spark, sf_dir))


def cohort_exclusion(spark, sf_dir):
    flagged = cohort.growth_flags(inputs.matrix(spark, sf_dir))
    return (
        flagged.groupBy(month_text(F.col("cohort")).alias("cohort"), "product")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("outflow_prop") > 1).alias("n_excess_rows"),
            F.bool_or("has_excess_outflow").alias("has_excess_outflow"),
            F.bool_or(F.col("has_excess_outflow") & F.col("has_growth")).alias("excluded"),
        )
    )


def month_ages(spark, sf_dir):
    rows = views.account_month(spark, sf_dir)
    return (
        rows.select(
            month_text(month_start(F.col("opening_date"))).alias("cohort"),
            month_text(month_start(F.col("reporting_period"))).alias("reporting_period"),
            age_in_months(F.col("reporting_period"), F.col("opening_date")).alias("months_since_start"),
        )
        .groupBy("cohort", "reporting_period", "months_since_start")
        .agg(F.count("*").alias("n_accounts"))
    )


def category_map(spark, sf_dir):
    # Written, so that the planner sees how small the map is and broadcasts it instead of shuffling by five keys.
    products = materialize(
        spark.createDataFrame(list(SEGMENT_CATEGORY.items()), "product_code string, category string"), "products"
    )
    accounts = inputs.accounts_table(spark, sf_dir)
    labelled = cohort.label_accounts(accounts, products, views.best_buy(accounts))
    return labelled.select(
        "account_id",
        "reporting_period",
        "product_code",
        "product",
        cohort.market_category(F.col("product"), MARKET_CATEGORY).alias("market_category"),
    )


def _short_rates(accounts):
    """Rates that lag two months behind the accounts."""
    return views.best_buy(accounts.filter(F.col("reporting_period") < F.add_months(F.lit(BATCH_START), 10)))


def coverage_filter(spark, sf_dir):
    accounts = inputs.accounts_table(spark, sf_dir)
    covered = cohort.label_accounts(accounts, None, _short_rates(accounts))
    return covered.groupBy("product", "reporting_period").agg(
        F.count("*").alias("n_rows"), F.sum("period_balance").cast("double").alias("balance")
    )


def dedupe_keys(spark, sf_dir):
    """Two loads of the same accounts, the later one corrected; the first row of each key stays."""
    rows = views.account_month(spark, sf_dir).select("account_id", "reporting_period", "product_code", "period_balance")
    loads = rows.withColumn("load_no", F.explode(F.array(F.lit(2), F.lit(1))))
    kept = cohort.keep_first_per_key(
        loads.withColumn("period_balance", F.col("period_balance") * F.col("load_no")),
        ["product_code", "account_id", "reporting_period"],
        ["load_no"],
    )
    return kept.withColumn("period_balance", F.col("period_balance").cast("double"))


def lag_seed(spark, sf_dir):
    m = inputs.matrix(spark, sf_dir)
    start = F.lit(BATCH_START).cast("date")
    training = m.filter(F.col("reporting_period") < start)
    batch = cohort.add_lag(m.filter(F.col("reporting_period") >= start))
    seeded = cohort.seed_lags(batch, training)
    return seeded.select(
        month_text(F.col("cohort")).alias("cohort"), "product", "months_since_start", "balance", "balance_lag_1"
    )


def scoring_features(spark, sf_dir):
    accounts = inputs.accounts_table(spark, sf_dir)
    rates = views.best_buy(accounts)
    start = F.lit(BATCH_START).cast("date")
    training = cohort.cohort_matrix(
        accounts.filter(F.col("reporting_period") < start), rates
    )
    batch = cohort.scoring_features(
        accounts.filter(F.col("reporting_period") >= start), rates, training
    )
    return inputs.matrix_output(batch)


QUERIES = {
    "cohort_matrix": cohort_matrix,
    "cohort_features": cohort_features,
    "cohort_exclusion": cohort_exclusion,
    "month_ages": month_ages,
    "category_map": category_map,
    "coverage_filter": coverage_filter,
    "dedupe_keys": dedupe_keys,
    "lag_seed": lag_seed,
    "scoring_features": scoring_features,
}


def _values(mapping: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in mapping.items())


_SEEDED = f"""
  SELECT b.*, (SELECT arg_max(t.balance, t.reporting_period) FROM {{train}} t
               WHERE t.cohort = b.cohort AND t.product = b.product AND t.balance IS NOT NULL) AS seed
  FROM batch_lagged b"""

SQL = {
    "cohort_matrix": sql.with_ctes(sql.MATRIX_CTES, f"SELECT {sql.MATRIX_OUTPUT} FROM matrix"),
    "cohort_features": sql.with_ctes(sql.FEATURE_CTES, f"SELECT {sql.MATRIX_OUTPUT} FROM features"),
    "cohort_exclusion": sql.with_ctes(
        sql.FEATURE_CTES,
        """SELECT strftime(m.cohort, '%Y-%m') AS cohort, m.product, count(*) AS n_rows,
  count(*) FILTER (m.outflow_prop > 1) AS n_excess_rows, bool_or(i.cohort IS NOT NULL) AS has_excess_outflow,
  bool_or(g.cohort IS NOT NULL) AS excluded
FROM matrix m LEFT JOIN invalid i ON i.cohort = m.cohort AND i.product = m.product
LEFT JOIN grown g ON g.cohort = m.cohort AND g.product = m.product GROUP BY 1, 2""",
    ),
    "month_ages": sql.with_ctes(
        sql.ACCOUNT_CTES,
        """SELECT strftime(opening_date, '%Y-%m') AS cohort, strftime(reporting_period, '%Y-%m') AS reporting_period,
  CAST(date_diff('month', opening_date, reporting_period) + 1 AS INTEGER) AS months_since_start,
  count(*) AS n_accounts FROM account_month GROUP BY 1, 2, 3""",
    ),
    "category_map": sql.with_ctes(
        sql.ACCOUNT_CTES
        + [
            f"products(product_code, product) AS (VALUES {_values(SEGMENT_CATEGORY)})",
            f"markets(product, market_category) AS (VALUES {_values(MARKET_CATEGORY)})",
        ],
        """SELECT account_id, reporting_period, a.product_code, p.product, market_category
FROM account_month a JOIN products p ON p.product_code = a.product_code LEFT JOIN markets m ON m.product = p.product
WHERE p.product <> 'default unassigned'""",
    ),
    "coverage_filter": sql.with_ctes(
        sql.ACCOUNT_CTES,
        f"""SELECT product_code AS product, reporting_period, count(*) AS n_rows,
  CAST(sum(period_balance) AS DOUBLE) AS balance
FROM account_month WHERE reporting_period <= (SELECT max(reporting_period) FROM account_month
  WHERE reporting_period < DATE '{BATCH_START}' + INTERVAL 10 MONTH) GROUP BY 1, 2""",
    ),
    "dedupe_keys": sql.with_ctes(
        sql.ACCOUNT_CTES
        + [
            """loads AS (SELECT account_id, reporting_period, product_code,
  CAST(period_balance * load_no AS DOUBLE) AS period_balance, load_no
  FROM account_month CROSS JOIN (VALUES (2), (1)) v(load_no))"""
        ],
        """SELECT * FROM loads QUALIFY row_number() OVER (
  PARTITION BY product_code, account_id, reporting_period ORDER BY load_no) = 1""",
    ),
    "lag_seed": sql.with_ctes(
        sql.MATRIX_CTES
        + [
            f"""batch_lagged AS (SELECT cohort, product, months_since_start, reporting_period, balance,
  lag(balance) OVER (PARTITION BY cohort, product ORDER BY months_since_start) AS own_lag
  FROM matrix WHERE reporting_period >= DATE '{BATCH_START}')""",
            f"train AS (SELECT * FROM matrix WHERE reporting_period < DATE '{BATCH_START}')",
            f"seeded AS ({_SEEDED.format(train='train')})",
        ],
        """SELECT strftime(cohort, '%Y-%m') AS cohort, product, months_since_start, balance,
  CASE coalesce(own_lag, seed) WHEN 0 THEN 1 ELSE coalesce(own_lag, seed) END AS balance_lag_1 FROM seeded""",
    ),
    "scoring_features": sql.with_ctes(
        sql.ACCOUNT_CTES
        + sql.RATE_CTES
        + [
            f"early AS (SELECT * FROM account_month WHERE reporting_period < DATE '{BATCH_START}')",
            f"late AS (SELECT * FROM account_month WHERE reporting_period >= DATE '{BATCH_START}')",
        ]
        + sql.matrix_ctes("training", "early")
        + sql.matrix_ctes("batch", "late")
        + [
            """seeded AS (SELECT b.* EXCLUDE (balance_lag_1), coalesce(balance_lag_1,
  (SELECT arg_max(t.balance, t.reporting_period) FROM training t
   WHERE t.cohort = b.cohort AND t.product = b.product)) AS lag FROM batch b)"""
        ],
        """SELECT strftime(cohort, '%Y-%m') AS cohort, product, months_since_start,
  strftime(reporting_period, '%Y-%m') AS reporting_period, balance, withdrawals, receipts, transfers,
  int_rate, best_buy, tenure_months, n_accounts, CASE lag WHEN 0 THEN 1 ELSE lag END AS balance_lag_1,
  delta_to_best_buy, bin_id, dbb_range FROM seeded""",
    ),
}
