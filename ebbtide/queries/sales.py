"""Sales features, enrichment, keyed upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.operators import sales as ops
from ebbtide.operators.upsert import keyed_upsert, repeated_keys
from ebbtide.queries import base_sql as sql
from ebbtide.session import materialize
from ebbtide.sources import sample_views as views

# The date of the features, and of the load before it.
AS_OF = "2000-06-30"
EARLIER = "1999-06-30"
KEY = "account_id"
_ROUNDED = ("sale_std",)


def _features(spark, sf_dir, as_of=AS_OF):
    return ops.sales_features(views.sales(spark, sf_dir), KEY, as_of)


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in _ROUNDED})


def sales_features(spark, sf_dir):
    return _rounded(_features(spark, sf_dir))


def sales_summary(spark, sf_dir):
    row = ops.portfolio_summary(_features(spark, sf_dir))
    return row.select(
        F.round("total_portfolio_sales", 2).alias("total_portfolio_sales"),
        F.round("portfolio_avg_transaction", 4).alias("portfolio_avg_transaction"),
        "total_transactions",
        F.round("avg_recency_days", 6).alias("avg_recency_days"),
    )


def feature_enrich(spark, sf_dir):
    accounts = views.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(KEY), F.col("c_mktsegment").alias("product_code"), "c_acctbal"
    )
    return _rounded(ops.with_sales(accounts, _features(spark, sf_dir, EARLIER), KEY))


def sales_features_from_parts(spark, sf_dir):
    """The stored parts of the earlier load and those of the sales since, which share a month."""
    sales = views.sales(spark, sf_dir)
    stored = materialize(ops.monthly_parts(ops.known_by(sales, EARLIER), KEY), "sales_parts")
    since = ops.monthly_parts(ops.known_by(sales, AS_OF, EARLIER), KEY)
    return _rounded(ops.features_of(ops.merge_parts(stored, since), KEY, AS_OF))


def feature_upsert(spark, sf_dir):
    """Features of the earlier load, overwritten by those of the accounts with a sale since."""
    incoming = _features(spark, sf_dir).filter(F.col("last_sale_date") > F.lit(EARLIER).cast("date"))
    merged = keyed_upsert(_features(spark, sf_dir, EARLIER), incoming.withColumn("is_new", F.lit(True)), [KEY])
    return _rounded(merged)


def key_violations(spark, sf_dir):
    """Order lines whose (order, line) pair is not unique."""
    lines = views.read_table(spark, sf_dir, "lineitem")
    return repeated_keys(lines, ["l_orderkey", "l_linenumber"])


QUERIES = {
    "sales_features": sales_features,
    "sales_features_from_parts": sales_features_from_parts,
    "sales_summary": sales_summary,
    "feature_enrich": feature_enrich,
    "feature_upsert": feature_upsert,
    "key_violations": key_violations,
}


def _cte(name: str, as_of: str) -> str:
    day = f"DATE '{as_of}'"
    return f"""{name}_sums AS (
  SELECT o_custkey AS account_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_of_sales,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_sale_amount, count(*) AS sale_count,
         coalesce(stddev_samp(o_totalprice), 0) AS sale_std, max(o_totalprice) AS max_single_sale,
         max(o_orderdate)::DATE AS last_sale_date, min(o_orderdate)::DATE AS first_sale_date
  FROM orders WHERE o_orderdate::DATE <= {day} GROUP BY 1),
{name} AS (
  SELECT *, CAST(coalesce({day} - last_sale_date, 9999) AS INTEGER) AS days_since_last_sale,
         CAST(last_sale_date - first_sale_date AS INTEGER) AS tenure_days,
         CASE WHEN last_sale_date > first_sale_date THEN sum_of_sales / ((last_sale_date - first_sale_date) / 30.0::DOUBLE)
              ELSE sum_of_sales END AS monthly_sale_avg, {day} AS feature_date
  FROM {name}_sums)"""


_OUT = """account_id, sum_of_sales, avg_sale_amount, sale_count,
  round(sale_std, 4) AS sale_std, max_single_sale, last_sale_date, first_sale_date, days_since_last_sale,
  tenure_days, monthly_sale_avg"""

SQL = {
    "sales_features": sql.with_ctes([_cte("f", AS_OF)], f"SELECT {_OUT}, feature_date FROM f"),
    "sales_features_from_parts": sql.with_ctes([_cte("f", AS_OF)], f"SELECT {_OUT}, feature_date FROM f"),
    "sales_summary": sql.with_ctes(
        [_cte("f", AS_OF)],
        """SELECT round(sum(sum_of_sales), 2) AS total_portfolio_sales,
  round(avg(avg_sale_amount), 4) AS portfolio_avg_transaction, CAST(sum(sale_count) AS BIGINT) AS total_transactions,
  round(avg(days_since_last_sale), 6) AS avg_recency_days FROM f""",
    ),
    "feature_enrich": sql.with_ctes(
        [_cte("f", EARLIER)],
        f"""SELECT c_custkey AS account_id, c_mktsegment AS product_code, c_acctbal, {_OUT.split(',', 1)[1]}
FROM customer LEFT JOIN f ON f.account_id = c_custkey""",
    ),
    "feature_upsert": sql.with_ctes(
        [_cte("f", AS_OF), _cte("g", EARLIER)],
        f"""SELECT {_OUT}, feature_date, true AS is_new FROM f WHERE last_sale_date > DATE '{EARLIER}'
UNION ALL SELECT {_OUT}, feature_date, NULL FROM g
WHERE account_id NOT IN (SELECT account_id FROM f WHERE last_sale_date > DATE '{EARLIER}')""",
    ),
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
}
