"""Weight limits, feasibility, scoring, and the report of the best weights.

The search itself is in ``allocate``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom import config, schemas
from marketloom.operators.allocate import GRADIENT_TOLERANCE

UNDEFINED_SHARPE_OBJECTIVE = 1e9


def is_crypto_symbol(symbol: Column) -> Column:
    return symbol.endswith("USDT")


def asset_limits(
    assets: DataFrame,
    max_single: float = config.MAX_SINGLE_ASSET_WEIGHT,
    max_crypto: float = config.MAX_CRYPTO_ASSET_WEIGHT,
) -> DataFrame:
    """Add the weight bounds of each asset.

    The asset class decides; a table without one is classed by symbol.
    """
    crypto = (
        F.col("asset_class") == "crypto"
        if "asset_class" in assets.columns
        else is_crypto_symbol(F.col("symbol"))
    )
    return assets.withColumns(
        {
            "is_crypto": crypto,
            "lower_bound": F.lit(0.0),
            "upper_bound": F.when(crypto, F.lit(max_crypto)).otherwise(F.lit(max_single)),
        }
    )


def universe_feasibility(
    limits: DataFrame,
    by: Sequence[str] = (),
    max_crypto_total: float = config.MAX_CRYPTO_TOTAL_WEIGHT,
    tolerance: float = config.WEIGHT_TOLERANCE,
) -> DataFrame:
    """Whether full weight can be placed within the bounds, per ``by`` group."""
    upper = F.col("upper_bound")
    zero = F.lit(0.0)
    total = F.coalesce(F.sum(F.when(~F.col("is_crypto"), upper)), zero)
    crypto = F.coalesce(F.sum(F.when(F.col("is_crypto"), upper)), zero)
    capacity = total + F.least(crypto, F.lit(max_crypto_total))
    return (
        limits.groupBy(*by)
        .agg(capacity.alias("capacity"))
        .withColumn("is_feasible", F.col("capacity") + tolerance >= 1.0)
    )


def feasible_candidates(
    candidates: DataFrame,
    limits: DataFrame,
    max_crypto_total: float = config.MAX_CRYPTO_TOTAL_WEIGHT,
    tolerance: float = config.WEIGHT_TOLERANCE,
) -> DataFrame:
    """Per candidate: total and crypto weight, and whether every limit holds.

    ``candidates`` has one row per candidate and symbol; ``limits`` one row per
    symbol of the searched universe.
    """
    bounds = limits.select("symbol", "is_crypto", "lower_bound", "upper_bound")
    weight = F.col("weight")
    outside = (weight < F.col("lower_bound") - tolerance) | (
        weight > F.col("upper_bound") + tolerance
    )
    totals = (
        candidates.join(bounds, "symbol")
        .groupBy("candidate_id")
        .agg(
            F.sum("weight").alias("total_weight"),
            F.coalesce(F.sum(F.when(F.col("is_crypto"), weight)), F.lit(0.0)).alias(
                "crypto_weight"
            ),
            F.count_if(outside).alias("out_of_bounds"),
        )
    )
    feasible = (
        (F.abs(F.col("total_weight") - 1.0) <= tolerance)
        & (F.col("out_of_bounds") == 0)
        & (F.col("crypto_weight") <= max_crypto_total + tolerance)
    )
    return totals.withColumn("is_feasible", feasible)


def candidate_vectors(candidates: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """One row per candidate: its weights as an array in symbol order, absent ones 0."""
    weights = [
        F.coalesce(F.sum(F.when(F.col("symbol") == s, F.col("weight"))), F.lit(0.0))
        for s in symbols
    ]
    return candidates.groupBy("candidate_id").agg(F.array(*weights).alias("weights"))


def score(
    vectors: DataFrame, moments: DataFrame, risk_free_rate: float = config.RISK_FREE_RATE
) -> DataFrame:
    """Add annual return, volatility, Sharpe ratio and the value to minimise.

    The moments are one row and reach the candidates as a scalar subquery.
    """
    moment = moments.select(F.struct("annual_returns", "annual_covariances").alias("_m")).scalar()
    dot = "aggregate(zip_with({}, {}, (x, y) -> x * y), 0D, (total, x) -> total + x)"
    row_products = f"transform(_m.annual_covariances, r -> {dot.format('r', 'weights')})"
    return (
        vectors.withColumn("_m", moment)
        .selectExpr(
            "*",
            f"{dot.format('weights', '_m.annual_returns')} AS annual_return",
            f"{dot.format('weights', row_products)} AS _variance",
        )
        # A variance just below 0 is 0; one further below has no root.
        .selectExpr(
            "* EXCEPT (_m, _variance)",
            "CASE WHEN _variance > -1e-12 THEN sqrt(greatest(_variance, 0D)) END "
            "AS annual_volatility",
        )
        .selectExpr(
            "*",
            f"CASE WHEN annual_volatility > 0 THEN (annual_return - {float(risk_free_rate)!r}D) "
            "/ annual_volatility END AS sharpe_ratio",
        )
        .selectExpr(
            "*",
            "CASE WHEN sharpe_ratio IS NULL OR isnan(sharpe_ratio) "
            f"THEN {UNDEFINED_SHARPE_OBJECTIVE!r}D ELSE -sharpe_ratio END AS objective",
        )
    )


def best(scored: DataFrame, tie_break: str = "candidate_id") -> DataFrame:
    """The candidate with the greatest Sharpe ratio; undefined ones come last."""
    return scored.orderBy("objective", tie_break).limit(1)


def starting_weights(candidates: DataFrame, limits: DataFrame) -> DataFrame:
    """Where a search begins, per candidate and symbol of ``limits``.

    The candidate's own weights, scaled to sum 1, if they keep the limits; else equal
    weights if those do; else NULL: there is no such start.
    """
    bounds = limits.select("symbol", "is_crypto", "lower_bound", "upper_bound")
    symbols = bounds.agg(F.collect_list("symbol").alias("symbols")).scalar()
    given = candidates.groupBy("candidate_id").agg(
        F.map_from_entries(F.collect_list(F.struct("symbol", "weight"))).alias("held"),
        F.sum("weight").alias("total"),
    )
    each = given.withColumn("symbols", symbols).select(
        "candidate_id", "held", "total", F.size("symbols").alias("n"), F.explode("symbols").alias("symbol")
    )
    own = F.coalesce(F.try_element_at("held", F.col("symbol")), F.lit(0.0)) / F.col("total")
    tries = each.select(
        "candidate_id",
        "symbol",
        F.when(F.col("total") > 0, own).alias("own"),
        (F.lit(1.0) / F.col("n")).alias("equal"),
    )

    def fitting(column: str) -> DataFrame:
        tried = tries.filter(F.col(column).isNotNull())
        checked = feasible_candidates(
            tried.select("candidate_id", "symbol", F.col(column).alias("weight")), limits
        )
        return checked.select("candidate_id", F.col("is_feasible").alias(f"{column}_fits"))

    chosen = F.when(F.col("own_fits"), F.col("own")).when(F.col("equal_fits"), F.col("equal"))
    return (
        tries.join(fitting("own"), "candidate_id", "left")
        .join(fitting("equal"), "candidate_id", "left")
        .select("candidate_id", "symbol", chosen.alias("weight"))
    )


def problem(
    moments: DataFrame,
    symbols: Sequence[str],
    current: Mapping[str, float],
    crypto: Sequence[str] | None = None,
    max_single: float = config.MAX_SINGLE_ASSET_WEIGHT,
    max_crypto: float = config.MAX_CRYPTO_ASSET_WEIGHT,
    max_crypto_total: float = config.MAX_CRYPTO_TOTAL_WEIGHT,
) -> DataFrame:
    """Moments of a symbol list with the limits and the start of a search.

    ``crypto`` names the crypto symbols; without it they are classed by name. Limits that
    leave no room for full weight are an error.
    """
    spark = moments.sparkSession
    is_crypto = [s.endswith("USDT") if crypto is None else s in set(crypto) for s in symbols]
    rows = [(s, "crypto" if c else "equity") for s, c in zip(symbols, is_crypto, strict=True)]
    universe = spark.createDataFrame(rows, "symbol string, asset_class string")
    limits = asset_limits(universe, max_single, max_crypto)
    if not universe_feasibility(limits, (), max_crypto_total).first()["is_feasible"]:
        raise ValueError("The weight limits are infeasible: these symbols cannot take full weight.")
    held = [float(current.get(s, 0.0)) for s in symbols]
    total = sum(held)
    bounds = [max_crypto if c else max_single for c in is_crypto]
    start = F.array(*[F.lit(h / total) for h in held]) if total > 0 else F.lit(None)
    return moments.withColumns(
        {
            "upper_bounds": F.array(*map(F.lit, bounds)),
            "is_crypto": F.array(*map(F.lit, is_crypto)),
            "start_weights": start.cast("array<double>"),
        }
    )


def clean_weights(candidates: DataFrame, smallest: float = 1e-10) -> DataFrame:
    """Set negligible weights to 0 and scale each candidate's weights to sum 1.

    A candidate has one row per symbol of its universe.
    """
    weight = F.when(F.abs("weight") < smallest, F.lit(0.0)).otherwise(F.col("weight"))
    total = F.sum("weight").over(Window.partitionBy("candidate_id"))
    return (
        candidates.withColumn("weight", weight)
        .withColumn("_total", total)
        .withColumn(
            "weight",
            F.when(F.col("_total") > 0, F.col("weight") / F.col("_total")).otherwise(
                F.col("weight")
            ),
        )
        .drop("_total")
    )


def weights_long(vectors: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """One row per candidate and symbol."""
    names = F.array(*[F.lit(s) for s in symbols])
    pairs = F.arrays_zip(names.alias("symbol"), F.col("weights").alias("weight"))
    return vectors.select("candidate_id", F.explode(pairs).alias("p")).select(
        "candidate_id", "p.symbol", "p.weight"
    )


def weight_difference(
    optimized: DataFrame, current: DataFrame, as_of: DataFrame, portfolio_name: str
) -> DataFrame:
    """Current weight, optimized weight and their difference per symbol.

    ``optimized`` has (symbol, weight), ``current`` (symbol, target_weight);
    a symbol that is not held counts as 0. ``as_of`` is the one-row lookback.
    """
    held = F.coalesce("target_weight", F.lit(0.0))
    report = optimized.join(current.select("symbol", "target_weight"), "symbol", "left").select(
        F.lit(portfolio_name).alias("portfolio_name"),
        as_of.select("lookback_end_date").scalar().alias("as_of_date"),
        "symbol",
        held.alias("current_weight"),
        F.col("weight").alias("optimized_weight"),
        (F.col("weight") - held).alias("weight_difference"),
    )
    return schemas.conform(report, schemas.FACT_OPTIMIZER_WEIGHTS)


def optimizer_summary(
    winner: DataFrame,
    as_of: DataFrame,
    portfolio_name: str = config.OPTIMIZED_PORTFOLIO_NAME,
    risk_free_rate: float = config.RISK_FREE_RATE,
) -> DataFrame:
    """The report row of the winning weights.

    ``winner`` has the score and the certificate of the weights. The search succeeded if the
    weights keep the limits and no move between two symbols has a gain above the tolerance.
    """
    window = as_of.select(
        F.struct("lookback_start_date", "lookback_end_date", "observation_count")
    ).scalar()
    proven = (
        F.col("sharpe_ratio").isNotNull()
        & F.col("within_limits")
        & (F.col("best_gain") <= GRADIENT_TOLERANCE)
    )
    message = (
        F.when(F.col("sharpe_ratio").isNull(), "The Sharpe ratio is undefined for all weights.")
        .when(~F.col("within_limits"), "The weights exceed a limit.")
        .when(proven, "No move between two symbols improves the weights.")
        .otherwise("A move between two symbols still improves the weights.")
    )
    report = winner.withColumn("_w", window).select(
        F.lit(portfolio_name).alias("portfolio_name"),
        F.col("_w.lookback_end_date").alias("as_of_date"),
        "_w.lookback_start_date",
        "_w.lookback_end_date",
        "_w.observation_count",
        F.lit(float(risk_free_rate)).alias("risk_free_rate"),
        "annual_return",
        "annual_volatility",
        "sharpe_ratio",
        F.lit(config.OPTIMIZER_METHOD).alias("optimizer_method"),
        F.lit(config.CONSTRAINT_SET_NAME).alias("constraint_set_name"),
        F.coalesce(proven, F.lit(False)).alias("optimization_success"),
        message.alias("optimization_message"),
    )
    return schemas.conform(report, schemas.FACT_OPTIMIZER_SUMMARY)


def top_weight_changes(weights: DataFrame, rows: int = 10) -> DataFrame:
    return weights.orderBy(F.desc("weight_difference"), "portfolio_name", "symbol").limit(rows)
