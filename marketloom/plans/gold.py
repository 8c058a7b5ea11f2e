"""Silver tables to the Gold star schema and the optimizer report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import config, schemas
from marketloom.operators import assets as asset_ops
from marketloom.operators import allocate, calendar, moments, portfolio, weights
from marketloom.sources.tables import (
    portfolios_table,
    read_table,
    stored,
    weights_table,
    write_by_year,
    write_table,
)


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    mode: str = "overwrite",
    portfolio_weights: DataFrame | None = None,
    portfolios: DataFrame | None = None,
    risk_free_rate: float = config.RISK_FREE_RATE,
) -> dict[str, int]:
    """Write the dimensions and the three daily facts, by year; returns their row counts.

    Every table is written once and read back by the next, so that no fact is
    computed again for the tables that follow from it.
    """
    held = weights_table(spark) if portfolio_weights is None else portfolio_weights
    prices = read_table(spark, silver_root, "asset_prices")
    rates = read_table(spark, silver_root, "fx_rates")
    rows: dict[str, int] = {}

    def save(name: str, table: DataFrame) -> DataFrame:
        write = write_by_year if name.startswith("fact_") else write_table
        rows[name] = write(table, gold_root, name, mode=mode)
        return read_table(spark, gold_root, name)

    dates = save("dim_date", calendar.dim_date(prices))
    save("dim_asset", calendar.dim_asset(read_table(spark, silver_root, "assets")))
    save("dim_portfolio", portfolios_table(spark) if portfolios is None else portfolios)
    fact = save("fact_asset_daily", asset_ops.fact_asset_daily(prices, rates, dates))
    daily = save("fact_portfolio_daily", portfolio.fact_portfolio_daily(fact, held))
    save(
        "fact_portfolio_summary_daily",
        portfolio.fact_portfolio_summary_daily(daily, risk_free_rate),
    )
    check_gold_keys(spark, gold_root, list(rows))
    return rows


def check_gold_keys(spark: SparkSession, gold_root: str, names: Sequence[str]) -> None:
    """Raise if a written table holds one of its keys twice."""
    for name in names:
        repeated = schemas.duplicate_keys(
            read_table(spark, gold_root, name), schemas.GOLD_KEYS[name]
        ).first()
        if repeated is not None:
            raise ValueError(f"{name} holds a key more than once: {repeated.asDict()}")


def optimize_returns(
    spark: SparkSession,
    returns: DataFrame,
    symbols: Sequence[str],
    current: Mapping[str, float] = config.FIXED_PORTFOLIO_WEIGHTS,
    portfolio_name: str = config.OPTIMIZED_PORTFOLIO_NAME,
    risk_free_rate: float = config.RISK_FREE_RATE,
    crypto: Sequence[str] | None = None,
    **limits: float,
) -> tuple[DataFrame, DataFrame]:
    """The summary row and the weight rows of the best allocation of a return matrix."""
    # One row, as long as the symbol list squared; later steps read it instead of the returns.
    known = stored(moments.moments(returns, symbols), "moments")
    if known.first()["observation_count"] < 2:
        raise ValueError("Optimization needs two or more days on which every symbol has a return.")
    total = {k: v for k, v in limits.items() if k == "max_crypto_total"}
    asked = weights.problem(known, symbols, current, crypto, **limits)
    lookback = ["lookback_start_date", "lookback_end_date", "observation_count"]
    solved = allocate.optimize(asked, [*asked.columns], risk_free_rate, **total)
    proven = allocate.certificates(solved, risk_free_rate, **total)
    named = proven.withColumn("candidate_id", F.lit(portfolio_name))
    winner = stored(weights.score(named, known, risk_free_rate), "best-weights")
    as_of = known.select(*lookback)
    chosen = weights.clean_weights(weights.weights_long(winner, symbols))
    held = spark.createDataFrame(
        [(s, float(w)) for s, w in current.items()], "symbol string, target_weight double"
    )
    return (
        weights.optimizer_summary(winner, as_of, portfolio_name, risk_free_rate),
        weights.weight_difference(chosen, held, as_of, portfolio_name),
    )


def optimize_gold(
    spark: SparkSession,
    gold_root: str,
    mode: str = "overwrite",
    symbols: Sequence[str] | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    portfolio_name: str = config.OPTIMIZED_PORTFOLIO_NAME,
    risk_free_rate: float = config.RISK_FREE_RATE,
    current: Mapping[str, float] = config.FIXED_PORTFOLIO_WEIGHTS,
    crypto: Sequence[str] | None = None,
) -> dict[str, int]:
    """Find the best weights from the asset fact and write the two report tables."""
    symbols = list(current) if symbols is None else list(symbols)
    fact = read_table(spark, gold_root, "fact_asset_daily", (start_date, end_date))
    returns = moments.complete_returns(fact, symbols, start_date, end_date)
    summary, chosen = optimize_returns(
        spark, returns, symbols, current, portfolio_name, risk_free_rate, crypto
    )
    return {
        "fact_optimizer_summary": write_table(summary, gold_root, "fact_optimizer_summary", mode),
        "fact_optimizer_weights": write_table(chosen, gold_root, "fact_optimizer_weights", mode),
    }
