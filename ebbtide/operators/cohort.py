"""Account months -> cohort x product x age matrix with flow ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.constants import MATRIX_KEYS, SERIES_KEYS, UNASSIGNED
from ebbtide.functions.dates import age_in_months, month_start
from ebbtide.functions.ratios import (
    cap_at_one,
    nonzero_lag,
    outflow_share,
    rate_bin,
    rate_label,
    receipt_share,
    withdrawal_share,
)
from ebbtide.operators.quantiles import null_safe_join, sort_key


def market_category(category: Column, mapping: Mapping[str, str] | None) -> Column:
    """Market-rate category of a product category; unmapped gives null. Without a mapping the two are the same."""
    if mapping is None:
        return category
    return F.create_map(*[F.lit(x) for x in chain(*mapping.items())])[category]


def label_accounts(accounts: DataFrame, products: DataFrame | None, rates: DataFrame) -> DataFrame:
    """Months, product category, age; only assigned categories and months the rate table covers.

    ``products`` (product_code, category) is a file or written table: the planner broadcasts it when its size allows.
    The covered range is a scalar subquery, so it filters the accounts before anything is shuffled.
    """
    labelled = accounts.withColumn("reporting_period", month_start(F.col("reporting_period"))).withColumn(
        "cohort", month_start(F.col("opening_date"))
    )
    if products is None:
        labelled = labelled.withColumn("product", F.col("product_code"))
    else:
        named = products.select("product_code", F.col("category").alias("product"))
        labelled = labelled.join(named, "product_code", "left")
    last_rate_month = rates.agg(F.max(month_start(F.col("period")))).scalar()
    return labelled.filter(
        (F.col("reporting_period") <= last_rate_month)
        & F.col("product").isNotNull()
        & (F.col("product") != UNASSIGNED)
    ).withColumn("months_since_start", age_in_months(F.col("reporting_period"), F.col("cohort")))


def aggregate_cohorts(labelled: DataFrame) -> DataFrame:
    """Sums, means and distinct accounts per cohort, product and age. Rows without a key are dropped.

    The sums combine map-side and shuffle no more than the matrix. Only the distinct count has to shuffle by account,
    so it does that alone, with one row for each account of a series that has the set of its ages, months of a calendar;
    the two results are hashed by the same key and join in place.
    """
    rows = labelled.dropna(subset=list(MATRIX_KEYS))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name).cast("double"), F.lit(0.0))

    def mean(name: str) -> Column:
        return F.sum(name).cast("double") / F.count(name)

    sums = rows.groupBy(*MATRIX_KEYS).agg(
        F.max("reporting_period").alias("reporting_period"),
        total("period_balance").alias("balance"),
        total("withdrawal").alias("withdrawals"),
        total("receipt").alias("receipts"),
        total("internal_transfer").alias("transfers"),
        mean("interest_rate").alias("int_rate"),
        mean("tenure_months").alias("tenure_months"),
    )
    members = (
        rows.groupBy(*SERIES_KEYS, "account_id")
        .agg(F.collect_set("months_since_start").alias("_ages"))
        .select(*SERIES_KEYS, "account_id", F.explode("_ages").alias("months_since_start"))
        .groupBy(*MATRIX_KEYS)
        .agg(F.count("account_id").alias("n_accounts"))
    )
    return sums.join(members, list(MATRIX_KEYS))


def attach_rates(
    matrix: DataFrame, rates: DataFrame, mapping: Mapping[str, str] | None
) -> DataFrame:
    """Market rate of the row's month and category.

    Cohort and age fix the month, so every account of a matrix row has the same market rate: joining it here, after
    the aggregation, gives the accounts' mean without joining the accounts. Repeated rate rows are averaged first, so
    they cannot multiply anything.
    """
    unique = rates.groupBy(
        month_start(F.col("period")).alias("_period"), F.col("mapping_category").alias("_category")
    ).agg(F.avg(F.col("best_buy").cast("double")).alias("best_buy"))
    on = (F.col("reporting_period") == F.col("_period")) & (F.col("_market") == F.col("_category"))
    return (
        matrix.withColumn("_market", market_category(F.col("product"), mapping))
        .join(unique, on, "left")
        .drop("_period", "_category", "_market")
    )


def add_lag(matrix: DataFrame) -> DataFrame:
    """Balance of the previous row of the series (by row, not by calendar month); a zero lag becomes 1."""
    series = Window.partitionBy(*SERIES_KEYS).orderBy("months_since_start")
    return matrix.withColumn("balance_lag_1", nonzero_lag(F.lag("balance", 1).over(series)))


def add_ratios(matrix: DataFrame) -> DataFrame:
    return (
        matrix.withColumn("rec_prop", receipt_share(F.col("receipts"), F.col("balance_lag_1")))
        .withColumn(
            "outflow_prop",
            outflow_share(F.col("withdrawals"), F.col("transfers"), F.col("receipts"), F.col("balance_lag_1")),
        )
        .withColumn("withdrawal_prop_of_outflow", withdrawal_share(F.col("withdrawals"), F.col("transfers")))
    )


def add_rate_gap(matrix: DataFrame) -> DataFrame:
    gapped = matrix.withColumn("delta_to_best_buy", F.col("int_rate") - F.col("best_buy"))
    return gapped.withColumn("bin_id", rate_bin(F.col("delta_to_best_buy"))).withColumn(
        "dbb_range", rate_label(F.col("bin_id"))
    )


def cohort_matrix(
    accounts: DataFrame,
    rates: DataFrame,
    products: DataFrame | None = None,
    mapping: Mapping[str, str] | None = None,
) -> DataFrame:
    """The matrix before the exclusion rules, with every ratio uncapped."""
    matrix = aggregate_cohorts(label_accounts(accounts, products, rates))
    matrix = attach_rates(matrix, rates, mapping)
    return add_rate_gap(add_ratios(add_lag(matrix)))


def growth_flags(matrix: DataFrame) -> DataFrame:
    """Per row: did its series ever exceed an outflow share of 1, and did its account count ever rise.

    Both are windows over the series the lag already partitioned and sorted, so no join and no new shuffle.
    """
    series = Window.partitionBy(*SERIES_KEYS)
    ordered = series.orderBy("months_since_start")
    over = F.coalesce(F.col("outflow_prop") > 1, F.lit(False))
    grew = F.coalesce(F.col("n_accounts") > F.lag("n_accounts", 1).over(ordered), F.lit(False))
    return (
        matrix.withColumn("_grew", grew)
        .withColumn("has_excess_outflow", F.max(over).over(series))
        .withColumn("has_growth", F.max("_grew").over(series))
        .drop("_grew")
    )


def exclude_grown_series(matrix: DataFrame) -> DataFrame:
    """Drop the series with an outflow share above 1 whose account count ever rose."""
    return (
        growth_flags(matrix)
        .filter(~(F.col("has_excess_outflow") & F.col("has_growth")))
        .drop("has_excess_outflow", "has_growth")
    )


def training_features(matrix: DataFrame, exclude: bool = True) -> DataFrame:
    """Exclusion, cap at 1, missing withdrawal share as 0, assigned products only."""
    kept = exclude_grown_series(matrix) if exclude else matrix
    return (
        kept.withColumn("outflow_prop", cap_at_one(F.col("outflow_prop")))
        .withColumn("withdrawal_prop_of_outflow", F.coalesce("withdrawal_prop_of_outflow", F.lit(0.0)))
        .filter(F.col("product") != UNASSIGNED)
    )


_WIDE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


def keep_first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``, nulls first; of equal ones any, but a whole one.

    An aggregate, not a window: repeats combine map-side, so a key with very many copies never meets in one sort. With one
    order column that a LONG can stand for it is a hash aggregate. Columns of fixed width are picked along with it;
    where others are, the keys are reduced first and the rows joined to what remains.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    code = order_code(df, order[0]) if len(order) == 1 else None
    if code is None:
        picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        return picked.select(*keys, "_row.*").select(*df.columns)
    coded = df.withColumn("_code", code)
    if not any(isinstance(df.schema[c].dataType, _WIDE) for c in rest):
        # all picks go by the same code over the same rows, so they are of one row also where codes are equal
        return coded.groupBy(*keys).agg(*[F.min_by(c, "_code").alias(c) for c in rest]).select(*df.columns)
    first = coded.groupBy(*keys).agg(F.min("_code").alias("_first"))
    return null_safe_join(coded, first, keys).filter(F.col("_code") == F.col("_first")).dropDuplicates(list(keys)).select(*df.columns)


def order_code(df: DataFrame, by: str | Column) -> Column | None:
    """A LONG of the same order as the column, nulls first and NaN last; none for types that it cannot stand for."""
    value = F.col(by) if isinstance(by, str) else by
    kind = df.select(value).schema[0].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        code = value.cast("long")
    elif isinstance(kind, T.DateType):
        code = F.unix_date(value).cast("long")
    elif isinstance(kind, T.TimestampType):
        code = F.unix_micros(value)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        code = F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(sort_key(value.cast("double")))
    else:
        return None
    return F.coalesce(code, F.lit(-(1 << 63)))


def last_balances(matrix: DataFrame) -> DataFrame:
    """Latest known balance and month of each series; rows without a balance do not count."""
    return (
        matrix.filter(F.col("balance").isNotNull())
        .groupBy(*SERIES_KEYS)
        .agg(
            F.max_by("balance", "reporting_period").alias("balance_lag_seed"),
            F.max("reporting_period").alias("last_training_period"),
        )
    )


def seed_lags(batch: DataFrame, training: DataFrame, seed_mode: str = "after_training") -> DataFrame:
    """Fill the missing lag of a series' first batch row from its last training balance.

    ``after_training`` seeds only rows later than the series' last training month; ``always`` seeds every missing lag.
    """
    if seed_mode not in ("after_training", "always"):
        raise ValueError(f"unknown seed_mode {seed_mode!r}")
    joined = batch.join(last_balances(training), list(SERIES_KEYS), "left")
    seed = F.col("balance_lag_seed")
    if seed_mode == "after_training":
        seed = F.when(F.col("reporting_period") > F.col("last_training_period"), seed)
    return joined.withColumn("balance_lag_1", nonzero_lag(F.coalesce("balance_lag_1", seed))).drop(
        "balance_lag_seed", "last_training_period"
    )


def scoring_features(
    accounts: DataFrame,
    rates: DataFrame,
    training: DataFrame | None = None,
    products: DataFrame | None = None,
    mapping: Mapping[str, str] | None = None,
    seed_mode: str = "after_training",
) -> DataFrame:
    """The batch the model scores: the matrix of the new months, without exclusion, with seeded lags."""
    matrix = aggregate_cohorts(label_accounts(accounts, products, rates))
    matrix = add_rate_gap(add_lag(attach_rates(matrix, rates, mapping)))
    if training is not None:
        matrix = seed_lags(matrix, training, seed_mode)
    return matrix.filter(F.col("product") != UNASSIGNED)
