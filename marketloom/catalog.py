"""Every operator as a query over the sample tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from marketloom import config, schemas
from marketloom.operators import (
    allocate,
    assets,
    calendar,
    moments,
    portfolio,
    publish,
    scan,
    silver,
    validate,
    weights,
)
from marketloom.plans import gold
from marketloom.sources import ledger, raw, sample
from marketloom.sources.tables import (
    portfolios_table,
    read_table,
    shared_folder,
    weights_table,
    write_by_year,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANGE = ("1996-03-01", "1998-06-30")
RAW_ROOT, REJECTED_ROOT = "raw", "rejected"


def query(build: Query) -> Query:
    """Register a query; its doubles are rounded so that summation order does not show."""

    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        doubles = [f.name for f in df.schema if isinstance(f.dataType, DoubleType)]
        # Adding 0 turns a rounded -0.0 into 0.0.
        return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) + F.lit(0.0) for c in doubles})

    QUERIES[build.__name__] = rounded
    return build


def _coarse(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Fewer digits, for results that two searches reach to within their steps."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.dim_date(sample.price_days(spark, sf_dir))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices, rates = sample.priority_prices(spark, sf_dir), sample.shipment_rates(spark, sf_dir)
    return assets.fact_asset_daily(prices, rates, _dates(spark, sf_dir), keyed=True)


def _wide_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices, rates = sample.customer_prices(spark, sf_dir), sample.shipment_rates(spark, sf_dir)
    return assets.fact_asset_daily(prices, rates, _dates(spark, sf_dir), keyed=True)


def _weights(spark: SparkSession) -> DataFrame:
    return weights_table(spark, weights=sample.PRIORITY_WEIGHTS)


def _portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.fact_portfolio_daily(_fact(spark, sf_dir), _weights(spark))


def _wide_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices, rates = sample.customer_prices(spark, sf_dir), sample.shipment_rates(spark, sf_dir)
    held = sample.nation_weights(spark, sf_dir)
    return portfolio.portfolio_daily_of_prices(prices, rates, _dates(spark, sf_dir), held)


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moments.complete_returns(_fact(spark, sf_dir), sample.SYMBOLS)


_without_path = ["bronze_file_path"]


# Raw documents and Silver


@query
def raw_struct_records(spark, sf_dir):
    documents = sample.price_documents(sample.customer_prices(spark, sf_dir))
    return silver.struct_records_to_prices(documents, sample.RUN_DATE).drop(*_without_path)


@query
def raw_array_records(spark, sf_dir):
    documents = sample.kline_documents(sample.user_klines(spark, sf_dir))
    return silver.array_records_to_prices(documents, sample.RUN_DATE).drop(*_without_path)


@query
def fx_rates(spark, sf_dir):
    documents = sample.rate_documents(sample.shipment_rates(spark, sf_dir, every_day=True))
    return silver.struct_records_to_rates(documents, sample.RUN_DATE).drop(*_without_path)


def _land(spark: SparkSession, sf_dir: str) -> str:
    """All derived documents, landed: equities, crypto pairs and FX."""
    root = shared_folder(spark, "raw")
    prices = sample.customer_prices(spark, sf_dir)
    is_crypto = F.col("source") == "binance"
    documents = {
        "equity": sample.price_documents(prices.filter(~is_crypto)),
        "crypto": sample.price_klines(prices.filter(is_crypto)),
        "fx": sample.rate_documents(sample.shipment_rates(spark, sf_dir)),
    }
    for kind, table in documents.items():
        raw.write_documents(table, root, kind, sample.RUN_DATE, "1990-01-01")
    return root


@query
def land_raw(spark, sf_dir):
    root = _land(spark, sf_dir)
    equities = raw.read_equity_documents(spark, root, sample.RUN_DATE, multi_line=False)
    pairs = raw.read_crypto_documents(spark, root, sample.RUN_DATE, multi_line=False)
    prices = silver.union_prices(
        silver.struct_records_to_prices(equities, sample.RUN_DATE),
        silver.array_records_to_prices(pairs, sample.RUN_DATE),
    )
    return prices.select("symbol", "source", "price_date", "close_price", "volume")


@query
def land_fx(spark, sf_dir):
    # One document in one file, which the reader of indented documents takes as well.
    root = _land(spark, sf_dir)
    documents = raw.read_fx_documents(spark, root, sample.RUN_DATE, multi_line=True)
    return silver.struct_records_to_rates(documents, sample.RUN_DATE).drop(*_without_path)


@query
def land_unread(spark, sf_dir):
    """Two landings; the second run reads the files that the first has not."""
    root, book, found = (shared_folder(spark, name) for name in ("raw", "ledger", "unread"))
    documents = sample.price_documents(sample.customer_prices(spark, sf_dir))
    is_late = F.substr("symbol", F.lit(2)).cast("bigint") % 3 == 0
    raw.write_documents(documents.filter(~is_late), root, "equity", sample.RUN_DATE)
    ledger.record(ledger.listed(spark, [root]), book)
    raw.write_documents(documents.filter(is_late), root, "equity", sample.RUN_DATE, mode="append")
    ledger.unread(ledger.listed(spark, [root]), ledger.read_ledger(spark, book)).write.parquet(found)
    lines = ledger.lines_of(spark, [root], spark.read.parquet(found))
    records = F.from_json("value", "records array<struct<Date: string>>")["records"]
    return lines.select(
        F.get_json_object("value", "$.symbol").alias("symbol"),
        F.size(records).cast("bigint").alias("record_count"),
    )


@query
def land_validate(spark, sf_dir):
    root = _land(spark, sf_dir)
    key = ["symbol", "asset_class"]
    assets = sample.customer_assets(spark, sf_dir).select(*key).unionByName(
        spark.createDataFrame([("AUDUSD=X", "fx")], "symbol string, asset_class string")
    )
    manifest = validate.expected_files(assets, root, sample.RUN_DATE)
    folders = [
        raw.partition_folder(root, folder, source, sample.RUN_DATE)
        for folder, source in raw.RAW_FOLDERS.values()
    ]
    results = validate.validate_lines(spark, manifest, folders)
    return results.select(
        "symbol",
        "asset_class",
        "status",
        F.size("errors").cast("bigint").alias("error_count"),
        F.get("errors", F.lit(0)).alias("first_error"),
    )


@query
def raw_lineage(spark, sf_dir):
    root = _land(spark, sf_dir)
    found = [
        reader(spark, root, sample.RUN_DATE, multi_line=False).select(
            "symbol",
            F.size("records").cast("bigint").alias("record_count"),
            F.contains("bronze_file_path", F.lit(f"/{folder}/date={sample.RUN_DATE}/")).alias(
                "is_in_run_folder"
            ),
        )
        for reader, folder in (
            (raw.read_equity_documents, "equities/source=yahoo"),
            (raw.read_crypto_documents, "crypto/source=binance"),
        )
    ]
    return found[0].unionByName(found[1])


@query
def assets_silver(spark, sf_dir):
    return schemas.conform(sample.customer_assets(spark, sf_dir), schemas.ASSETS)


QUERIES["assets"] = QUERIES.pop("assets_silver")


@query
def conform_schema(spark, sf_dir):
    texts = sample.customer_prices(spark, sf_dir).select(
        F.lit("dropped").alias("extra"),
        *[
            F.col(c).cast("string").alias(c)
            for c in [
                "volume", "close_price", "low_price", "high_price", "open_price", "price_date",
                "ingestion_run_date", "currency", "source", "asset_class", "symbol",
            ]
        ],
        F.lit(1).alias("bronze_file_path"),
    )
    return schemas.conform(texts, schemas.ASSET_PRICES)


def _dirty_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.dayofmonth("price_date")
    return sample.customer_prices(spark, sf_dir).withColumns(
        {
            "volume": F.when(day == 13, -F.col("volume")).otherwise(F.col("volume")),
            "close_price": F.when(day != 29, F.col("close_price")),
            "high_price": F.when(day == 31, F.lit(float("nan"))).otherwise(F.col("high_price")),
            "low_price": F.when(day == 7, F.lit(0.0)).otherwise(F.col("low_price")),
            "currency": F.when(day != 3, F.col("currency")),
        }
    )


@query
def clean_prices(spark, sf_dir):
    return silver.clean_prices(_dirty_prices(spark, sf_dir))


@query
def clean_fx(spark, sf_dir):
    day = F.dayofmonth("rate_date")
    rate = F.when(day == 13, 0.0).when(day != 29, F.col("rate"))
    rates = sample.shipment_rates(spark, sf_dir, every_day=True)
    return silver.clean_rates(rates.withColumn("rate", rate))


@query
def union_prices(spark, sf_dir):
    narrow = sample.priority_prices(spark, sf_dir)
    wide = sample.customer_prices(spark, sf_dir)
    return silver.union_prices(narrow, wide.select(sorted(wide.columns)))


@query
def latest_run_prices(spark, sf_dir):
    prices = sample.customer_prices(spark, sf_dir).select(
        "symbol", "price_date", "close_price", "ingestion_run_date", "low_price"
    )
    later = prices.withColumns(
        {
            "close_price": F.col("low_price"),
            "ingestion_run_date": F.date_add("ingestion_run_date", 1),
        }
    ).filter(F.dayofmonth("price_date") > 15)
    both = prices.unionByName(later).drop("low_price")
    return silver.one_per_day(both, "symbol", "price_date", "close_price")


# Calendar and FX


@query
def date_bounds(spark, sf_dir):
    return calendar.date_bounds(sample.price_days(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return _dates(spark, sf_dir)


@query
def dim_asset(spark, sf_dir):
    twice = sample.customer_assets(spark, sf_dir)
    return calendar.dim_asset(twice.unionByName(twice))


@query
def asset_calendar(spark, sf_dir):
    prices = sample.priority_prices(spark, sf_dir)
    return calendar.asset_calendar(prices, _dates(spark, sf_dir))


@query
def asset_calendar_fill(spark, sf_dir):
    prices = sample.priority_prices(spark, sf_dir)
    return calendar.fill_prices(prices, _dates(spark, sf_dir))


@query
def asset_calendar_fill_wide(spark, sf_dir):
    filled = calendar.fill_prices(sample.customer_prices(spark, sf_dir), _dates(spark, sf_dir))
    return filled.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if("is_price_forward_filled").alias("filled_days"),
        F.max("date_key").alias("last_day"),
        F.avg("close_price_native").alias("average_price"),
    )


@query
def fx_calendar_fill(spark, sf_dir):
    return calendar.fx_calendar(sample.shipment_rates(spark, sf_dir), _dates(spark, sf_dir))


@query
def fx_pairs_fill(spark, sf_dir):
    return calendar.fill_pairs(sample.mode_rates(spark, sf_dir), _dates(spark, sf_dir)).drop(
        "previous_rate"
    )


@query
def asof_fx(spark, sf_dir):
    rates = calendar.fill_rates(sample.shipment_rates(spark, sf_dir), _dates(spark, sf_dir))
    orders = sample.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date")
    )
    return assets.rates_as_of(orders, "order_date", rates).select(
        "o_orderkey", "order_date", "aud_usd_rate", "source_fx_date"
    )


# Asset facts


@query
def currency_conversion(spark, sf_dir):
    rates = calendar.fill_rates(sample.shipment_rates(spark, sf_dir), _dates(spark, sf_dir))
    # A currency with no conversion rule stays NULL.
    currency = F.when(F.dayofmonth("price_date") == 13, "EUR").otherwise(F.col("currency"))
    prices = sample.customer_prices(spark, sf_dir).select(
        "symbol",
        "price_date",
        currency.alias("currency"),
        F.col("close_price").alias("close_price_native"),
    )
    return assets.convert_to_aud(assets.rates_as_of(prices, "price_date", rates)).select(
        "symbol", "price_date", "currency", "close_price_native", "close_price_aud"
    )


@query
def fact_asset_daily(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def fact_asset_pairs(spark, sf_dir):
    prices, rates = sample.priority_prices(spark, sf_dir), sample.mode_rates(spark, sf_dir)
    return assets.fact_asset_daily(prices, rates, _dates(spark, sf_dir))


@query
def fact_asset_hard(spark, sf_dir):
    late = F.col("rate_date") >= "1996-05-01"
    rates = sample.mode_rates(spark, sf_dir).filter(late)
    prices = sample.hard_prices(spark, sf_dir)
    return assets.fact_asset_daily(prices, rates, _dates(spark, sf_dir))


@query
def fact_asset_daily_wide(spark, sf_dir):
    return _wide_fact(spark, sf_dir).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("days"),
        F.count("daily_return").alias("returns"),
        F.sum("daily_return").alias("total_return"),
        F.avg("close_price_aud").alias("average_price_aud"),
        F.count_if("is_price_forward_filled").alias("filled_days"),
        F.count_if("is_fx_forward_filled").alias("filled_fx_days"),
    )


@query
def daily_returns(spark, sf_dir):
    return _fact(spark, sf_dir).select("symbol", "date_key", "daily_return")


@query
def fill_flags(spark, sf_dir):
    return _fact(spark, sf_dir).select(
        "symbol", "date_key", "is_price_observed", "is_price_forward_filled", "is_fx_observed",
        "is_fx_forward_filled", "source_price_date", "source_fx_date",
    )


# Portfolios


@query
def portfolio_weights(spark, sf_dir):
    return schemas.conform(sample.nation_weights(spark, sf_dir), schemas.PORTFOLIO_WEIGHTS)


@query
def dim_portfolio(spark, sf_dir):
    names = sample.nation_weights(spark, sf_dir).select("portfolio_name").distinct()
    fixed = names.select(
        "portfolio_name",
        F.lit("fixed_weight").alias("portfolio_type"),
        F.lit("Customers of one nation at equal weight.").alias("description"),
        F.lit(True).alias("is_active"),
    )
    configured = portfolios_table(spark)
    return schemas.conform(fixed.unionByName(configured), schemas.DIM_PORTFOLIO)


@query
def portfolio_weighted(spark, sf_dir):
    weighted = portfolio.weighted_returns(_fact(spark, sf_dir), _weights(spark))
    return weighted.select("portfolio_name", "symbol", "date_key", "weighted_return")


@query
def portfolio_daily(spark, sf_dir):
    return _portfolio(spark, sf_dir)


@query
def portfolio_daily_wide(spark, sf_dir):
    return _wide_portfolio(spark, sf_dir)


@query
def cumulative_return(spark, sf_dir):
    return _portfolio(spark, sf_dir).select("portfolio_name", "date_key", "cumulative_return")


@query
def drawdown(spark, sf_dir):
    return portfolio.drawdowns(_portfolio(spark, sf_dir)).select(
        "portfolio_name", "date_key", "portfolio_value", "running_peak_value", "drawdown",
        "max_drawdown",
    )


@query
def ytd_return(spark, sf_dir):
    return portfolio.year_to_date(_portfolio(spark, sf_dir)).select(
        "portfolio_name", "date_key", "observation_count", "average_daily_return",
        "daily_volatility", "ytd_return",
    )


@query
def portfolio_summary(spark, sf_dir):
    return portfolio.fact_portfolio_summary_daily(_portfolio(spark, sf_dir))


@query
def portfolio_summary_wide(spark, sf_dir):
    return portfolio.fact_portfolio_summary_daily(_wide_portfolio(spark, sf_dir))


@query
def latest_summary(spark, sf_dir):
    summary = portfolio.fact_portfolio_summary_daily(_wide_portfolio(spark, sf_dir))
    return portfolio.latest_summary(summary, 30)


@query
def portfolio_summary_blocked(spark, sf_dir):
    return portfolio.blocked_summary(_wide_portfolio(spark, sf_dir))


@query
def events_running(spark, sf_dir):
    value = F.col("value")
    measures = {
        "value_count": ("count", value),
        "value_sum": ("sum", value),
        "value_max": ("max", value),
        "value_min": ("min", value),
        "last_marked": ("last", F.when(F.col("user_id") % 3 == 0, F.col("event_id"))),
        "moments": ("moments", value),
    }
    events = sample.table(spark, sf_dir, "events")
    running = scan.blocked_scan(
        events, ["event_type"], ["ts", "event_id"], F.to_date("ts"), measures
    )
    return running.select(
        "event_id", "value_count", "value_sum", "value_max", "value_min",
        F.coalesce("last_marked", F.lit(-1)).alias("last_marked"),
        scan.deviation(F.col("moments")).alias("value_deviation"),
    )


@query
def events_as_of(spark, sf_dir):
    # Two keys, each with half of the rows.
    events = sample.table(spark, sf_dir, "events").withColumn("market", F.col("user_id") % 2)
    rates = events.filter("event_type = 'purchase'").select(
        "market", "ts", F.col("value").alias("rate"), F.col("event_id").alias("rate_id")
    )
    held = scan.as_of(events, rates, ["market"], "ts", ["rate", "rate_id"], F.to_date)
    rate_id = F.coalesce("rate_id", F.lit(-1)).alias("rate_id")
    return held.select("event_id", "market", "rate", rate_id)


@query
def fact_year_rewrite(spark, sf_dir):
    root = shared_folder(spark, "by-year")
    write_by_year(_fact(spark, sf_dir), root, "fact")
    doubled = read_table(spark, root, "fact", ("1996-01-01", "1996-12-31")).withColumn(
        "close_price_aud", F.col("close_price_aud") * 2
    )
    # A table is not overwritten while it is read.
    write_table(doubled, root, "year")
    write_by_year(read_table(spark, root, "year"), root, "fact", only_held=True)
    return read_table(spark, root, "fact", ("1995-06-01", "1997-06-30"))


# Return matrix, moments and weights


@query
def return_matrix(spark, sf_dir):
    return moments.return_matrix(_fact(spark, sf_dir), sample.SYMBOLS)


@query
def return_matrix_range(spark, sf_dir):
    return moments.return_matrix(_fact(spark, sf_dir), sample.SYMBOLS, *RANGE)


@query
def return_matrix_head(spark, sf_dir):
    return moments.return_matrix(_fact(spark, sf_dir), sample.SYMBOLS).limit(10)


@query
def lookback_stats(spark, sf_dir):
    return moments.lookback(_returns(spark, sf_dir))


@query
def annual_mean_returns(spark, sf_dir):
    return moments.annual_means(_returns(spark, sf_dir), sample.SYMBOLS)


@query
def annual_covariance(spark, sf_dir):
    return moments.annual_covariances(_returns(spark, sf_dir), sample.SYMBOLS)


@query
def rolling_covariance(spark, sf_dir):
    returns = _fact(spark, sf_dir).withColumn("list_name", F.lit("priorities"))
    return moments.rolling_covariances(returns, ["list_name"], 90)


def _symbol_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = F.col("o_orderpriority")
    classes = sample.table(spark, sf_dir, "orders").select(
        symbol.alias("symbol"),
        F.when(symbol.isin(*sample.PRIORITY_CRYPTO), "crypto").otherwise("equity").alias(
            "asset_class"
        ),
    )
    return weights.asset_limits(classes.distinct())


@query
def asset_limits(spark, sf_dir):
    limits = weights.asset_limits(sample.customer_assets(spark, sf_dir))
    return limits.select("symbol", "is_crypto", "lower_bound", "upper_bound")


@query
def feasible_universe(spark, sf_dir):
    customers = sample.table(spark, sf_dir, "customer").select(
        sample.customer_symbol(F.col("c_custkey")).alias("symbol"),
        F.floor(F.col("c_custkey") / 3).alias("universe"),
    )
    limits = weights.asset_limits(sample.customer_assets(spark, sf_dir))
    return weights.universe_feasibility(limits.join(customers, "symbol"), ["universe"])


@query
def feasible_candidates(spark, sf_dir):
    candidates = sample.order_mix_candidates(spark, sf_dir)
    return weights.feasible_candidates(candidates, _symbol_limits(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = weights.candidate_vectors(
        sample.order_mix_candidates(spark, sf_dir), sample.SYMBOLS
    )
    return weights.score(vectors, moments.moments(_returns(spark, sf_dir), sample.SYMBOLS))


@query
def score_candidates(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "candidate_id", "annual_return", "annual_volatility", "sharpe_ratio"
    )


@query
def best_portfolio(spark, sf_dir):
    candidates = sample.order_mix_candidates(spark, sf_dir)
    feasible = weights.feasible_candidates(candidates, _symbol_limits(spark, sf_dir))
    scored = _scored(spark, sf_dir).join(
        feasible.filter("is_feasible").select("candidate_id"), "candidate_id", "left_semi"
    )
    return weights.best(scored).select(
        "candidate_id", "annual_return", "annual_volatility", "sharpe_ratio"
    )


@query
def clean_weights(spark, sf_dir):
    rare = F.when(F.col("weight") < 0.15, F.lit(1e-11)).otherwise(F.col("weight") * 3)
    candidates = sample.order_mix_candidates(spark, sf_dir).withColumn("weight", rare)
    return weights.clean_weights(candidates).select("candidate_id", "symbol", "weight")


def _optimized(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return gold.optimize_returns(
        spark,
        _returns(spark, sf_dir),
        sample.SYMBOLS,
        sample.PRIORITY_WEIGHTS,
        crypto=sample.PRIORITY_CRYPTO,
    )


@query
def optimizer_summary(spark, sf_dir):
    summary = _optimized(spark, sf_dir)[0].drop("optimizer_method", "optimization_message")
    return _coarse(summary, 4, "annual_return", "annual_volatility", "sharpe_ratio")


@query
def weight_difference(spark, sf_dir):
    return _coarse(_optimized(spark, sf_dir)[1], 4, "optimized_weight", "weight_difference")


@query
def top_weight_changes(spark, sf_dir):
    top = weights.top_weight_changes(_optimized(spark, sf_dir)[1], 3)
    return _coarse(top, 4, "optimized_weight", "weight_difference")


def _certified(spark: SparkSession, sf_dir: str, members: int) -> DataFrame:
    """Best weights of lists of customers, judged by their moments alone."""
    key = F.substring("symbol", 2, 20).cast("long")
    prices = sample.customer_prices(spark, sf_dir).withColumn("universe", F.floor(key / members))
    rates = sample.shipment_rates(spark, sf_dir)
    returns = assets.return_runs(prices, rates, _dates(spark, sf_dir), ["universe"])
    known = moments.grouped(returns, ["universe"])
    asked = known.withColumn(
        "is_crypto", F.transform("symbols", lambda s: F.right(s, F.lit(1)).isin("8", "9"))
    ).withColumns(
        {
            "upper_bounds": F.transform(
                "is_crypto",
                lambda c: F.when(c, config.MAX_CRYPTO_ASSET_WEIGHT).otherwise(
                    config.MAX_SINGLE_ASSET_WEIGHT
                ),
            ),
            "start_weights": F.lit(None).cast("array<double>"),
        }
    )
    judged = allocate.certificates(allocate.optimize(asked, asked.columns))
    solved = F.col("weights").isNotNull()
    optimal = F.col("best_gain") <= allocate.GRADIENT_TOLERANCE
    return judged.select(
        "universe",
        F.size("symbols").cast("bigint").alias("symbols"),
        "observation_count",
        (solved & F.col("within_limits")).alias("within_limits"),
        (solved & optimal).alias("is_optimal"),
    )


@query
def optimizer_certificate_5(spark, sf_dir):
    return _certified(spark, sf_dir, 5)


@query
def optimizer_certificate_12(spark, sf_dir):
    return _certified(spark, sf_dir, 12)


@query
def optimizer_certificate_60(spark, sf_dir):
    return _certified(spark, sf_dir, 60)


@query
def starting_weights(spark, sf_dir):
    candidates = sample.order_mix_candidates(spark, sf_dir)
    return weights.starting_weights(candidates, _symbol_limits(spark, sf_dir))


# Validation


@query
def expected_files(spark, sf_dir):
    customers = sample.customer_assets(spark, sf_dir)
    return validate.expected_files(customers, RAW_ROOT, sample.RUN_DATE)


def _struct_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = sample.faulty_documents(sample.customer_prices(spark, sf_dir))
    return validate.validate_documents(documents)


def _struct_errors(spark: SparkSession, sf_dir: str, pattern: str) -> DataFrame:
    errors = validate.error_rows(_struct_results(spark, sf_dir), "symbol")
    return errors.filter(F.col("error").rlike(pattern)).select("symbol", "error")


@query
def validate_payload(spark, sf_dir):
    documents = sample.faulty_documents(sample.customer_prices(spark, sf_dir))
    results = validate.validate_documents(documents, record_rules=False)
    return validate.error_rows(results, "symbol").select("symbol", "error")


@query
def validate_struct_records(spark, sf_dir):
    return _struct_errors(spark, sf_dir, "^record ")


@query
def validate_numeric(spark, sf_dir):
    return _struct_errors(spark, sf_dir, " is (not numeric|negative)$")


@query
def validate_duplicates(spark, sf_dir):
    return _struct_errors(spark, sf_dir, " has duplicate ")


@query
def validate_date_range(spark, sf_dir):
    return _struct_errors(spark, sf_dir, " date is (before|after) ")


@query
def validate_array_records(spark, sf_dir):
    documents = sample.faulty_klines(sample.user_klines(spark, sf_dir))
    results = validate.validate_documents(documents)
    return validate.error_rows(results, "symbol").select("symbol", "error_no", "error")


def _file_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = sample.customer_assets(spark, sf_dir).withColumn("asset_class", F.lit("equity"))
    expected = validate.expected_files(customers, RAW_ROOT, sample.RUN_DATE)
    results = _struct_results(spark, sf_dir).select(
        F.col("symbol").alias("_key"),
        F.lit(None).cast("bigint").alias("file_size_bytes"),
        F.col("errors").alias("payload_errors"),
    )
    hidden = spark.createDataFrame([], "_key string, is_folder boolean")
    keyed = expected.withColumn("_key", F.col("symbol"))
    return validate.file_results(keyed, results, hidden).drop("_key")


@query
def validate_files(spark, sf_dir):
    return _file_results(spark, sf_dir).select(
        "symbol", "path", "status", F.size("errors").cast("bigint").alias("error_count"),
        F.get("errors", F.lit(0)).alias("first_error"),
    )


@query
def validate_landed_files(spark, sf_dir):
    """One file per symbol under its manifest's name, two thirds of them with a fault."""
    root = shared_folder(spark, "files")
    customers = sample.customer_assets(spark, sf_dir).withColumn("asset_class", F.lit("equity"))
    fault = F.substr("symbol", F.lit(2)).cast("bigint") % 12
    manifest = validate.expected_files(customers, root, sample.RUN_DATE).withColumn(
        "path", F.when(fault == 9, F.replace("path", F.lit(".json"), F.lit(".txt"))).otherwise(
            F.col("path")
        ),
    )
    prices = sample.customer_prices(spark, sf_dir).filter(F.dayofmonth("price_date") != 13)
    documents = raw.complete(
        sample.price_documents(prices.withColumn("source", F.lit("yahoo"))),
        "1990-01-01", None, "1d",
    )
    text = F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"})
    head = F.substring_index(text, '"records":', 1)
    content = (
        F.when(fault == 2, F.lit(b""))
        .when(fault == 3, F.lit(None))
        .when(fault == 4, F.lit(b"\xff\xfe{}"))
        .when(fault == 5, F.lit(b"null"))
        .when(fault == 6, F.encode(F.left(text, F.length(text) - 2), "UTF-8"))
        .when(fault == 7, F.encode(F.concat(head, F.lit('"records":{}}')), "UTF-8"))
        .when(fault == 8, F.encode(F.concat(head, F.lit('"records":[]}')), "UTF-8"))
        .otherwise(F.encode(text, "UTF-8"))
    )
    files = documents.select("symbol", content.alias("content")).join(manifest, "symbol")
    raw.write_files(files.filter(fault != 1).select("path", "content"))
    folder, source = raw.RAW_FOLDERS["equity"]
    folders = [raw.partition_folder(root, folder, source, sample.RUN_DATE)]
    return validate.validate_files(spark, manifest, folders).select(
        "symbol", "status", F.size("errors").cast("bigint").alias("error_count"),
        F.get("errors", F.lit(0)).alias("first_error"),
        F.coalesce(F.col("file_size_bytes") > 0, F.lit(False)).alias("has_bytes"),
    )


@query
def validation_summary(spark, sf_dir):
    return validate.summarize(_file_results(spark, sf_dir))


@query
def validation_report(spark, sf_dir):
    lines = validate.report_lines(_file_results(spark, sf_dir), ["file_no"])
    return lines.fillna(0, subset=["file_no"])


@query
def quarantine_split(spark, sf_dir):
    results = _file_results(spark, sf_dir)
    valid = validate.valid_files(results).withColumn("rejected_path", F.lit(None).cast("string"))
    rejected = validate.rejected_files(results, RAW_ROOT, REJECTED_ROOT)
    return valid.unionByName(rejected).select("symbol", "status", "rejected_path")


@query
def run_summary(spark, sf_dir):
    failed = F.col("event_type") == "error"
    log = sample.table(spark, sf_dir, "events").select(
        "user_id", F.when(failed, "failed").otherwise("success").alias("status")
    )
    return validate.run_summary(log, ["user_id"])


# Publishing


@query
def null_out_nan(spark, sf_dir):
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    events = sample.table(spark, sf_dir, "events")
    return publish.null_out_nan(events.select("event_id", value.alias("value")))


def _built_gold(spark: SparkSession, sf_dir: str) -> str:
    """Silver and Gold tables of the sample, written to the shared folder."""
    silver_root, gold_root = shared_folder(spark, "silver"), shared_folder(spark, "gold")
    no_path = F.lit(None).cast("string").alias("bronze_file_path")
    prices = sample.priority_prices(spark, sf_dir).select("*", no_path)
    rates = sample.shipment_rates(spark, sf_dir).select("*", no_path)
    write_table(sample.customer_assets(spark, sf_dir), silver_root, "assets")
    write_table(schemas.conform(prices, schemas.ASSET_PRICES), silver_root, "asset_prices")
    write_table(schemas.conform(rates, schemas.FX_RATES), silver_root, "fx_rates")
    gold.build_gold(spark, silver_root, gold_root, portfolio_weights=_weights(spark))
    gold.optimize_gold(spark, gold_root, current=sample.PRIORITY_WEIGHTS, crypto=sample.PRIORITY_CRYPTO)
    return gold_root


@query
def publish_preview(spark, sf_dir):
    return publish.preview_folder(spark, _built_gold(spark, sf_dir))


@query
def publish_all(spark, sf_dir):
    target = shared_folder(spark, "published")
    publish.publish_all(spark, _built_gold(spark, sf_dir), target)
    return publish.load_logs(spark, target).select("table_name", "status", "row_count")


