"""Response families of the three models: binomial/logit, Tweedie(1.5)/log, gamma/log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BINOMIAL = "binomial"
TWEEDIE = "tweedie"
GAMMA = "gamma"
_EDGE = 1e-12  # fitted shares stay this far from 0 and 1
_MAX_ETA = 500.0  # exp() stays finite


def is_binomial(family: Column) -> Column:
    return family == BINOMIAL


def starting_eta(family: Column, y: Column, y_mean: Column) -> Column:
    """Link of the starting mean: halfway to 0.5 for shares, halfway to the mean otherwise."""
    share = (y + 0.5) / 2
    return F.when(is_binomial(family), F.ln(share / (1 - share))).otherwise(F.ln((y + y_mean) / 2))


def mean_of(family: Column, eta: Column) -> Column:
    """Inverse link."""
    share = 1 / (1 + F.exp(-F.greatest(F.lit(-_MAX_ETA), F.least(eta, F.lit(_MAX_ETA)))))
    return F.when(is_binomial(family), F.least(F.greatest(share, F.lit(_EDGE)), F.lit(1 - _EDGE))).otherwise(
        F.exp(F.greatest(F.lit(-_MAX_ETA), F.least(eta, F.lit(_MAX_ETA))))
    )


def working_weight(family: Column, mu: Column) -> Column:
    """Squared slope of the inverse link over the variance."""
    return F.when(is_binomial(family), mu * (1 - mu)).when(family == TWEEDIE, F.sqrt(mu)).otherwise(F.lit(1.0))


def newton_weight(family: Column, y: Column, mu: Column) -> Column:
    """Second derivative of half the deviance along the linear predictor; positive in all three families."""
    tweedie = (F.sqrt(mu) + y / F.sqrt(mu)) / 2
    return F.when(is_binomial(family), mu * (1 - mu)).when(family == TWEEDIE, tweedie).otherwise(y / mu)


def score(family: Column, y: Column, mu: Column) -> Column:
    """(y - mu) times the slope of the inverse link over the variance."""
    return F.when(is_binomial(family), y - mu).when(family == TWEEDIE, (y - mu) / F.sqrt(mu)).otherwise((y - mu) / mu)


def deviance(family: Column, y: Column, mu: Column) -> Column:
    def y_log(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.ln(a / b)).otherwise(0.0)

    share = 2 * (y_log(y, mu) + y_log(1 - y, 1 - mu))
    tweedie = 4 * (F.sqrt(mu) - 2 * F.sqrt(y) + y / F.sqrt(mu))
    gamma = 2 * ((y - mu) / mu - F.ln(y / mu))
    return F.when(is_binomial(family), share).when(family == TWEEDIE, tweedie).otherwise(gamma)


def clamp(family: Column, mu: Column) -> Column:
    """Predictions: shares within [0, 1], the rest not below 0."""
    floor = F.greatest(mu, F.lit(0.0))
    return F.when(mu.isNull(), F.lit(None)).when(is_binomial(family), F.least(floor, F.lit(1.0))).otherwise(floor)
