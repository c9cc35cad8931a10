"""Flow ratios and rate-gap bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.constants import RATE_EDGES, RATE_LABELS


def ieee_divide(a: Column, b: Column) -> Column:
    """``a / b`` that never raises: x/0 is signed infinity, 0/0 and any null give null."""
    at_zero = F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
    return F.when(b == 0, at_zero).otherwise(F.try_divide(a, b))


def nonzero_lag(lag: Column) -> Column:
    return F.when(lag == 0, F.lit(1.0)).otherwise(lag)


def receipt_share(receipts: Column, lag: Column) -> Column:
    return ieee_divide(receipts, lag)


def outflow_share(withdrawals: Column, transfers: Column, receipts: Column, lag: Column) -> Column:
    return ieee_divide(withdrawals + transfers, receipts + lag)


def withdrawal_share(withdrawals: Column, transfers: Column) -> Column:
    return ieee_divide(withdrawals, withdrawals + transfers)


def cap_at_one(x: Column) -> Column:
    """Upper cap only; null stays null (``least`` alone would turn it into 1)."""
    return F.when(x > 1, F.lit(1.0)).otherwise(x)


def rate_bin(gap: Column, edges: tuple[float, ...] = RATE_EDGES) -> Column:
    """Bin number, right-closed: the first edge the gap does not exceed; beyond the last edge, the last bin."""
    bin_id = F.when(gap.isNull() | F.isnan(gap), F.lit(None).cast("int"))
    for i, edge in enumerate(edges):
        bin_id = bin_id.when(gap <= edge, F.lit(i))
    return bin_id.otherwise(F.lit(len(edges)))


def rate_label(bin_id: Column, labels: tuple[str, ...] = RATE_LABELS) -> Column:
    named = F.element_at(F.array(*[F.lit(x) for x in labels]), bin_id + 1)
    return F.when(bin_id.isNotNull(), named)


def rate_midpoints(edges: tuple[float, ...] = RATE_EDGES) -> list[float]:
    """Stand-in gap of each bin when training saw none there; open ends sit half a point below and 0.025 above."""
    inner = [(lo + hi) / 2 for lo, hi in zip(edges[:-1], edges[1:])]
    return [edges[0] - 0.5, *inner, edges[-1] + 0.025]
