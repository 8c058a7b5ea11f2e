"""Portfolio returns and running risk metrics, keyed by portfolio name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marketloom import config, schemas
from marketloom.functions.returns import (
    compounded,
    geometric_annual_return,
    log_growth,
    sharpe_ratio,
)
from marketloom.operators.assets import fact_asset_daily
from marketloom.operators.joins import BROADCAST_ROWS, has_at_most, sliced_join
from marketloom.operators.scan import Measure, blocked_scan, deviation
from marketloom.sources.tables import stored


def join_weights(
    fact: DataFrame,
    weights: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    slice_rows: int = 10_000,
) -> DataFrame:
    """Asset rows joined to the portfolios that hold the asset.

    A weight table of up to ``broadcast_rows`` rows is broadcast. Beyond that
    both sides are shuffled, and a symbol that more than ``slice_rows``
    portfolios hold is worked on in slices of its portfolios, so that no task
    has to build all of its output.
    """
    if has_at_most(weights, broadcast_rows):
        return fact.join(F.broadcast(weights), "symbol")
    return sliced_join(weights, fact, "symbol", "portfolio_name", slice_rows)


def _weighted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("weighted_return", F.col("daily_return") * F.col("target_weight"))


def weighted_returns(fact: DataFrame, weights: DataFrame) -> DataFrame:
    """Each holding's weighted daily return; rows without a return are left out."""
    returns = fact.filter("daily_return is not null").select(
        "symbol",
        "date_key",
        "daily_return",
        "is_price_observed",
        "is_price_forward_filled",
        "is_fx_forward_filled",
    )
    held = weights.select("portfolio_name", "symbol", "target_weight")
    return _weighted(join_weights(returns, held))


def daily_totals(weighted: DataFrame) -> DataFrame:
    """Sum over the holdings of each portfolio and day, complete days only."""
    return (
        weighted.groupBy("portfolio_name", "date_key")
        .agg(
            F.sum("weighted_return").alias("daily_return"),
            F.sum("target_weight").alias("available_weight"),
            F.count_if("is_price_observed").alias("observed_asset_count"),
            F.count_if("is_price_forward_filled").alias("forward_filled_price_count"),
            F.count_if("is_fx_forward_filled").alias("forward_filled_fx_count"),
        )
        .filter(F.col("available_weight") >= config.COMPLETE_WEIGHT)
    )


def cumulative_return(daily: DataFrame) -> DataFrame:
    """Add the compounded return since the portfolio's first day.

    A portfolio has one row per day, so a window holds at most the calendar.
    """
    running = (
        Window.partitionBy("portfolio_name")
        .orderBy("date_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    growth = F.sum(log_growth(F.col("daily_return"))).over(running)
    return daily.withColumn("cumulative_return", compounded(growth))


def fact_portfolio_daily(fact: DataFrame, weights: DataFrame) -> DataFrame:
    return _portfolio_daily(weighted_returns(fact, weights))


def portfolio_daily_of_prices(
    prices: DataFrame, rates: DataFrame, dates: DataFrame, weights: DataFrame
) -> DataFrame:
    """``fact_portfolio_daily`` of the asset fact of keyed prices and rates, which is not built.

    The weights are joined to the prices before these are expanded, so days are shuffled as
    sums by portfolio and day only.
    """
    held = weights.select("portfolio_name", "symbol", "target_weight")
    returns = fact_asset_daily(
        prices,
        rates,
        dates,
        keyed=True,
        joined=lambda intervals: join_weights(intervals, held),
        kept=["portfolio_name", "target_weight"],
    )
    return _portfolio_daily(_weighted(returns.filter("daily_return is not null")))


def _portfolio_daily(weighted: DataFrame) -> DataFrame:
    totals = daily_totals(weighted).withColumns(
        {
            "has_forward_filled_price": F.col("forward_filled_price_count") > 0,
            "has_forward_filled_fx": F.col("forward_filled_fx_count") > 0,
        }
    )
    return schemas.conform(cumulative_return(totals), schemas.FACT_PORTFOLIO_DAILY)


def _with_year(portfolio_daily: DataFrame) -> DataFrame:
    """Add the calendar year, once, so that all yearly windows share one sort."""
    if "summary_year" in portfolio_daily.columns:
        return portfolio_daily
    return portfolio_daily.withColumn("summary_year", F.year("date_key"))


def _this_year() -> WindowSpec:
    return (
        Window.partitionBy("portfolio_name", "summary_year")
        .orderBy("date_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def drawdowns(portfolio_daily: DataFrame) -> DataFrame:
    """Wealth index, its peak so far this year, the fall from it and the worst fall."""
    this_year = _this_year()
    value = F.col("portfolio_value")
    return (
        _with_year(portfolio_daily)
        .withColumn("portfolio_value", F.col("cumulative_return") + F.lit(1.0))
        .withColumn("running_peak_value", F.max(value).over(this_year))
        .withColumn("drawdown", F.try_divide(value, F.col("running_peak_value")) - F.lit(1.0))
        .withColumn("max_drawdown", F.min("drawdown").over(this_year))
    )


def year_to_date(portfolio_daily: DataFrame) -> DataFrame:
    """Running count, mean, volatility and compounded return within the year."""
    this_year = _this_year()
    daily = F.col("daily_return")
    return _with_year(portfolio_daily).withColumns(
        {
            "observation_count": F.count(daily).over(this_year),
            "average_daily_return": F.avg(daily).over(this_year),
            "daily_volatility": F.stddev_samp(daily).over(this_year),
            "ytd_return": compounded(F.sum(log_growth(daily)).over(this_year)),
        }
    )


def fact_portfolio_summary_daily(
    portfolio_daily: DataFrame,
    risk_free_rate: float = config.RISK_FREE_RATE,
    annualization_days: int = config.CALENDAR_DAYS_PER_YEAR,
    min_observations: int = config.MIN_ANNUALIZATION_OBSERVATIONS,
) -> DataFrame:
    """Running year-to-date metrics; annualized ones from ``min_observations`` days on."""
    metrics = year_to_date(drawdowns(portfolio_daily))
    return _annualized(metrics, risk_free_rate, annualization_days, min_observations)


def blocked_summary(
    portfolio_daily: DataFrame,
    risk_free_rate: float = config.RISK_FREE_RATE,
    annualization_days: int = config.CALENDAR_DAYS_PER_YEAR,
    min_observations: int = config.MIN_ANNUALIZATION_OBSERVATIONS,
    block: Column | None = None,
) -> DataFrame:
    """``fact_portfolio_summary_daily`` from daily returns alone, scanned in blocks.

    ``block`` cuts the days, each block within one year; a month unless given. The tables
    between are written.
    """
    block = F.trunc("date_key", "month") if block is None else block
    daily = F.col("daily_return")

    def scanned(rows: DataFrame, scope: list[str], **measures: Measure) -> DataFrame:
        return stored(blocked_scan(rows, scope, ["date_key"], block, measures), "blocks")

    returns = stored(portfolio_daily.select("portfolio_name", "date_key", "daily_return"), "blocks")
    grown = scanned(returns, ["portfolio_name"], growth=("sum", log_growth(daily)))
    valued = _with_year(grown).withColumn("value", compounded(F.col("growth")) + F.lit(1.0))
    yearly = ["portfolio_name", "summary_year"]
    peaks = scanned(
        valued,
        yearly,
        peak=("max", F.col("value")),
        moments=("moments", daily),
        year_growth=("sum", log_growth(daily)),
    )
    fallen = peaks.withColumn("drawdown", F.try_divide("value", "peak") - F.lit(1.0))
    metrics = scanned(fallen, yearly, max_drawdown=("min", F.col("drawdown"))).withColumns(
        {
            "observation_count": F.col("moments.n"),
            "daily_volatility": deviation(F.col("moments")),
            "ytd_return": compounded(F.col("year_growth")),
        }
    )
    return _annualized(metrics, risk_free_rate, annualization_days, min_observations)


def _annualized(
    metrics: DataFrame, risk_free_rate: float, annualization_days: int, min_observations: int
) -> DataFrame:
    observations = F.col("observation_count")
    enough = observations >= min_observations
    annual_return = geometric_annual_return(F.col("ytd_return"), observations, annualization_days)
    annual_volatility = F.col("daily_volatility") * F.sqrt(F.lit(annualization_days))
    yearly = metrics.withColumns(
        {
            "annual_return": F.when(enough, annual_return),
            "annual_volatility": F.when(enough, annual_volatility),
            "risk_free_rate": F.lit(float(risk_free_rate)),
        }
    )
    summary = yearly.withColumn(
        "sharpe_ratio",
        sharpe_ratio(F.col("annual_return"), F.col("annual_volatility"), F.col("risk_free_rate")),
    )
    return schemas.conform(summary, schemas.FACT_PORTFOLIO_SUMMARY_DAILY)


def latest_summary(summary: DataFrame, rows: int = 10) -> DataFrame:
    """The newest summary rows."""
    return summary.orderBy(F.desc("date_key"), "portfolio_name").limit(rows)
