"""Error measures, as plain and as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ape(actual: Column, predicted: Column) -> Column:
    """Absolute relative error of one row; null when the actual is 0 or either side is missing."""
    return F.try_divide(F.abs(actual - predicted), F.abs(actual))


def mape(actual: Column, predicted: Column) -> Column:
    """Percent, over complete pairs with a non-zero actual."""
    return F.avg(ape(actual, predicted)) * 100


def rmse(actual: Column, predicted: Column) -> Column:
    gap = actual - predicted
    return F.sqrt(F.avg(gap * gap))


def zero_actuals(actual: Column, predicted: Column) -> Column:
    """Complete pairs that MAPE leaves out because the actual is 0."""
    return F.count_if((actual == 0) & predicted.isNotNull())
