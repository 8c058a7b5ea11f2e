"""Return arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def simple_return(price: Column, previous: Column) -> Column:
    return F.try_divide(price, previous) - F.lit(1.0)


def log_growth(daily_return: Column) -> Column:
    """ln(1 + r); NULL, and so skipped by sums, for a loss of 100 % or more."""
    return F.log(daily_return + F.lit(1.0))


def compounded(log_sum: Column) -> Column:
    return F.exp(log_sum) - F.lit(1.0)


def to_aud(price: Column, currency: Column, aud_usd_rate: Column) -> Column:
    """AUD as it is, USDT divided by the USD-per-AUD rate, anything else NULL."""
    return F.when(currency == "AUD", price).when(
        currency == "USDT", F.try_divide(price, aud_usd_rate)
    )


def geometric_annual_return(total_return: Column, observations: Column, days: int) -> Column:
    return F.pow(total_return + F.lit(1.0), F.lit(float(days)) / observations) - F.lit(1.0)


def sharpe_ratio(annual_return: Column, volatility: Column, risk_free_rate: Column) -> Column:
    return F.when(volatility > 0, (annual_return - risk_free_rate) / volatility)
