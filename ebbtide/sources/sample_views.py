"""The account, rate and log views over the sample tables.

Account = customer, product = market segment, reporting period = ship month, opening date = first ship month.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.functions.dates import age_in_months, month_start
from ebbtide.session import row_partitions


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def account_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per account and month.

    Lines are summed per account and month before the customer columns are joined, so the second join sees the
    aggregate. The lines have two decimals: they are added up as whole hundredths, which is exact, independent of the
    order of addition, and faster than wide decimals. Amounts come out as DECIMAL, so later sums are exact as well.

    The lines are dealt by account, a bounded number to a task: the sums, the customers and the first month all use
    that one partitioning. An account's lines meet in one task, which keeps no more of them than a sum for each month.
    """

    def hundredths(name: str) -> Column:
        return F.rint(F.col(name) * 100).cast("long")

    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        month_start(F.col("l_shipdate")).alias("reporting_period"),
        F.col("l_returnflag").alias("flag"),
        hundredths("l_extendedprice").alias("price"),
        hundredths("l_discount").alias("discount"),
        hundredths("l_tax").alias("tax"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("account_id"))
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("product_code")
    )

    def amount(units: Column, scale: int) -> Column:
        return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(18,{scale})")

    def flow(flag: str) -> Column:
        return amount(F.sum(F.when(F.col("flag") == flag, F.col("price") * F.col("discount") * 5).otherwise(0)), 4)

    n = row_partitions(spark, lines.count())  # the files' footers have the count
    monthly = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .repartition(n, "account_id")
        .groupBy("account_id", "reporting_period")
        .agg(
            amount(F.sum("price"), 2).alias("period_balance"),
            flow("R").alias("withdrawal"),
            amount(F.sum(F.col("price") * F.col("tax") * 5), 4).alias("receipt"),
            flow("A").alias("internal_transfer"),
            (F.sum("discount") / F.lit(100.0) / F.count("*") * 10).cast("decimal(18,10)").alias("interest_rate"),
        )
        .join(customers.repartition(n, "account_id"), "account_id")
    )
    first_month = F.min("reporting_period").over(Window.partitionBy("account_id"))
    return monthly.withColumn("opening_date", first_month).withColumn(
        "tenure_months", age_in_months(F.col("reporting_period"), F.col("opening_date"))
    )


def best_buy(accounts: DataFrame) -> DataFrame:
    """The market rate: the best rate any account of the product had in the month."""
    return accounts.groupBy(
        F.col("reporting_period").alias("period"), F.col("product_code").alias("mapping_category")
    ).agg(F.max("interest_rate").alias("best_buy"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.to_date("o_orderdate").alias("sale_date"),
    )
