"""Files, catalog tables and databases -> typed frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import materialize

# Column names of the raw extracts and the names used here.
RAW_ACCOUNT_NAMES = {
    "account id": "account_id",
    "opening date": "opening_date",
    "reporting period": "reporting_period",
    "product code": "product_code",
    "period balance": "period_balance",
    "£ withdrawal": "withdrawal",
    "£ receipt": "receipt",
    "£ internal transfer": "internal_transfer",
    "interest rate": "interest_rate",
    "account tenure (months)": "tenure_months",
}
RAW_PRODUCT_NAMES = {"Product Code": "product_code", "QRM Category": "category"}
RAW_RATES = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("mapping_category", T.StringType()),
        T.StructField("best_buy", T.DoubleType()),
    ]
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN becomes null: a missing value is null everywhere after ingest."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return nan_to_null(reader.parquet(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a given schema: one pass, no inference."""
    return nan_to_null(spark.read.schema(schema).csv(path, header=True))


#: Holds a line that does not fit the schema, while it is read.
BAD_LINE = "_bad_line"
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "line", "parsed", "reason")])


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, needed: Mapping[str, Column] | None = None, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV that fit the schema, and the lines that do not: source, line, what could be parsed of it, reason.

    A cell of the wrong type, a cell too few or too many make a line bad. ``needed`` gives columns that are computed
    from the row, named as they are to be: where one is null and its source of the same name is not, the row is
    rejected too. Every line is in one of the two frames. The file is read once and written parsed; the frames read that.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.read.schema(with_bad).options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE)
    # of a line, only the cells that a query asks for would be parsed, and judged: so all are, once
    row = F.struct(*[F.col(f"`{c}`") for c in schema.names])
    lines = reader.csv(path).select(F.col(BAD_LINE).alias("line"), row.alias("row"))
    computed = {c: F.when(F.col(f"row.{c}").isNotNull(), made).alias(c) for c, made in (needed or {}).items()}
    lines = materialize(lines.select("*", F.struct(F.lit(True).alias("_any"), *computed.values()).alias("made")), "lines")
    unmade = F.array_compact(F.array(*[F.when(F.col(f"row.{c}").isNotNull() & F.col(f"made.{c}").isNull(), F.lit(c)) for c in computed], F.lit(None).cast("string")))
    bad = F.col("line").isNotNull()
    odd = ~bad & (F.size(unmade) > 0)
    good = lines.filter(~bad & ~odd).select(*[F.col(f"made.{c}" if c in computed else f"row.`{c}`").alias(c) for c in schema.names])
    parsed = F.to_json("row")
    rejects = lines.filter(bad | odd).select(
        F.lit(path).alias("source"),
        F.coalesce("line", parsed).alias("line"),
        parsed.alias("parsed"),
        F.when(bad, "does not fit the schema").otherwise(F.concat(F.lit("no value for "), F.array_join(unmade, ", "))).alias("reason"),
    )
    return nan_to_null(good), rejects


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Account extract in its raw column names -> ours, months as DATE."""
    raw = read_parquet(spark, path).withColumnsRenamed(RAW_ACCOUNT_NAMES)
    return raw.withColumns(
        {
            "reporting_period": F.trunc(F.to_date(F.col("reporting_period").cast("string")), "MM"),
            "opening_date": F.to_date("opening_date"),
        }
    )


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Market rates CSV; its months are ``yyyy-MM`` text."""
    return read_csv(spark, path, RAW_RATES).withColumn("period", F.to_date("period", "yyyy-MM"))


def read_rates_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Market rates, and the lines that are none: a month that is no ``yyyy-MM`` is one too."""
    month = F.to_date(F.try_to_timestamp(F.col("row.period"), F.lit("yyyy-MM")))
    return read_csv_checked(spark, path, RAW_RATES, {"period": month})


def read_products_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_PRODUCT_NAMES])
    good, rejects = read_csv_checked(spark, path, schema)
    return good.withColumnsRenamed(RAW_PRODUCT_NAMES), rejects


def read_products(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_PRODUCT_NAMES])
    return read_csv(spark, path, schema).withColumnsRenamed(RAW_PRODUCT_NAMES)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int = 8,
    properties: Mapping[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Parallel database scan. Filters and column selection on the result are pushed to the database.

    The bounds only place the splits; rows outside them still arrive, in the first and last split.
    """
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties={"fetchsize": str(fetch_size), **(properties or {})},
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when there are no rows. Looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
