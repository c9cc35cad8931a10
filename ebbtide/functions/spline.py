"""Natural cubic regression spline with four knots, as column expressions.

The basis is the cardinal one: column m is 1 at knot m and 0 at the others; the four columns add up to 1, and outside
the knots every column is linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_AGES = 4


def knots(ages: Column) -> Column:
    """Least age, the points a third and two thirds along the distinct ages, greatest age.

    ``ages`` is a sorted array of distinct ages. Fewer than four ages give null.
    """
    last = F.size(ages) - 1

    def along(numerator: int) -> Column:
        # Position numerator/3 of the way; integer arithmetic keeps whole positions exact.
        low = F.floor((last * numerator) / 3).cast("int")
        part = ((last * numerator) % 3) / F.lit(3.0)
        a, z = ages[low], ages[F.least(low + 1, last)]
        return a + (z - a) * part

    points = F.array(ages[0].cast("double"), along(1), along(2), ages[last].cast("double"))
    return F.when(F.size(ages) >= MIN_AGES, points)


def curvature(k: Column) -> Column:
    """Second derivatives of the four basis columns at the four knots: sixteen numbers, first knot first.

    The inner ones solve the 2 x 2 tridiagonal system of the natural spline; at the outer knots they are 0.
    """
    h0, h1, h2 = k[1] - k[0], k[2] - k[1], k[3] - k[2]
    zero = F.lit(0.0)
    slope_change = [
        [1 / h0, -1 / h0 - 1 / h1, 1 / h1, zero],
        [zero, 1 / h1, -1 / h1 - 1 / h2, 1 / h2],
    ]
    b00, b01, b11 = (h0 + h1) / 3, h1 / 6, (h1 + h2) / 3
    det = b00 * b11 - b01 * b01
    first = [(b11 * p - b01 * q) / det for p, q in zip(*slope_change)]
    second = [(b00 * q - b01 * p) / det for p, q in zip(*slope_change)]
    return F.when(k.isNotNull(), F.array(*[zero] * 4, *first, *second, *[zero] * 4))


def place(df: DataFrame, x: Column, k: Column, prefix: str = "_") -> DataFrame:
    """Where ``x`` lies among the knots: interval ``j`` and the weights of its two ends, as columns.

    A spline is ``wl * value[j] + wr * value[j+1] + bl * curve[j] + br * curve[j+1]``. The steps are separate columns,
    so the planner computes each once; without knots all are null. Beyond the outer knots the cubic part is dropped,
    which leaves a straight line.
    """

    def name(part: str) -> str:
        return f"{prefix}{part}"

    j, h, right, left = (F.col(name(c)) for c in ("j", "h", "right", "left"))
    cubic_right = F.when(x > k[3], 0.0).otherwise(right * right * right / h)
    cubic_left = F.when(x < k[0], 0.0).otherwise(left * left * left / h)
    return (
        df.withColumn(name("j"), F.when(k.isNull(), None).when(x < k[1], 0).when(x < k[2], 1).otherwise(2))
        .withColumns({name("h"): k[j + 1] - k[j], name("right"): k[j + 1] - x, name("left"): x - k[j]})
        .withColumns(
            {
                name("wl"): right / h,
                name("wr"): left / h,
                name("bl"): (cubic_right - h * right) / 6,
                name("br"): (cubic_left - h * left) / 6,
            }
        )
        .drop(name("h"), name("right"), name("left"))
    )


def placed_columns(prefix: str = "_") -> list[str]:
    return [f"{prefix}{part}" for part in ("j", "wl", "wr", "bl", "br")]


def basis(x: Column, curve: Column, prefix: str = "_") -> list[Column]:
    """The four basis columns of a placed row. Without knots they are 1, x, 0, 0: a straight line."""
    j, wl, wr, bl, br = (F.col(c) for c in placed_columns(prefix))
    straight = (F.lit(1.0), x.cast("double"), F.lit(0.0), F.lit(0.0))
    columns = []
    for m in range(4):
        line = F.when(j == m, wl).when(j + 1 == m, wr).otherwise(0.0)
        bent = line + bl * curve[j * 4 + m] + br * curve[(j + 1) * 4 + m]
        columns.append(F.when(j.isNull(), straight[m]).otherwise(bent))
    return columns


def bends(beta: Column, curve: Column) -> Column:
    """Second derivatives at the knots of the spline with coefficients ``beta``."""
    return F.array(*[sum((beta[m] * curve[4 * i + m] for m in range(1, 4)), beta[0] * curve[4 * i]) for i in range(4)])


def value(x: Column, beta: Column, bend: Column, prefix: str = "_") -> Column:
    """The spline with coefficients ``beta`` at a placed row."""
    j, wl, wr, bl, br = (F.col(c) for c in placed_columns(prefix))
    curved = wl * beta[j] + wr * beta[j + 1] + bl * bend[j] + br * bend[j + 1]
    return F.when(j.isNull(), beta[0] + beta[1] * x).otherwise(curved)
