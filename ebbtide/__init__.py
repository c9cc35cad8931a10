"""Cohort cash-flow analytics as Spark DataFrame operators."""
