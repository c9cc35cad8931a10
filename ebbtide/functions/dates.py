"""Months and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(day, "MM")


def month_text(day: Column) -> Column:
    """``yyyy-MM``, the form months take in exported tables."""
    return F.date_format(day, "yyyy-MM")


def age_in_months(period: Column, cohort: Column) -> Column:
    """Whole months from cohort to period; the opening month is 1. Day of month plays no part."""
    return (F.year(period) - F.year(cohort)) * 12 + (F.month(period) - F.month(cohort)) + 1
