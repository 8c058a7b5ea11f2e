"""Asset prices in AUD and their daily returns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions.returns import simple_return, to_aud
from marketloom.operators.calendar import expand_days, fill_rates, of_pair, valid_until
from marketloom.operators.silver import one_per_day


def rates_as_of(rows: DataFrame, day: str, rates: DataFrame) -> DataFrame:
    """Add the last known rate on each row's day.

    ``rates`` comes from ``fill_rates``: one row per calendar day at most, so
    it is broadcast. The key is the day number, because an integral key gets
    the faster hash table.
    """
    known = rates.withColumn("_day", F.unix_date("date_key")).drop("date_key")
    matched = F.unix_date(rows[day]) == known["_day"]
    return rows.join(F.broadcast(known), matched, "left").drop("_day")


def convert_to_aud(prices: DataFrame) -> DataFrame:
    """Add ``close_price_aud`` from native price, currency and rate."""
    aud = to_aud(F.col("close_price_native"), F.col("currency"), F.col("aud_usd_rate"))
    return prices.withColumn("close_price_aud", aud)


def price_intervals(
    prices: DataFrame, dates: DataFrame, together: Sequence[str] = ()
) -> DataFrame:
    """Each positive AUD or USDT price with the days it holds and the price before it.

    ``previous_price`` held until ``previous_to``. A price that is not positive
    ends the one before it and then has no days of its own. Histories are told apart by the
    columns ``together`` and the symbol; rows of equal ``together`` lie in one task, in its order.
    """
    key = [*together, "symbol"]
    by_symbol = Window.partitionBy(*key).orderBy("price_date")
    observed = prices.select(
        *key, "currency", "price_date", F.col("close_price").alias("close_price_native")
    ).filter(F.col("currency").isin("AUD", "USDT"))
    held = valid_until(observed, key, "price_date", dates, together)
    held = held.filter("close_price_native > 0")
    return held.withColumns(
        {
            "previous_price": F.lag("close_price_native").over(by_symbol),
            "previous_to": F.lag("valid_to").over(by_symbol),
        }
    )


def _newest_rows(prices: DataFrame, rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    def run(table: DataFrame) -> list[str]:
        return [c for c in table.columns if c == "ingestion_run_date"]

    price_rows = prices.select("symbol", "price_date", "close_price", "currency", *run(prices))
    # Only AUD/USD converts prices; rates of other pairs are not mixed in.
    rate_rows = of_pair(rates).select(
        "base_currency", "quote_currency", "rate_date", "rate", *run(rates)
    )
    return (
        one_per_day(price_rows, "symbol", "price_date", "close_price"),
        one_per_day(rate_rows, ["base_currency", "quote_currency"], "rate_date", "rate"),
    )


def fact_asset_daily(
    prices: DataFrame,
    rates: DataFrame,
    dates: DataFrame,
    keyed: bool = False,
    joined: Callable[[DataFrame], DataFrame] | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Forward-filled AUD prices, simple daily returns and fill provenance.

    ``keyed`` promises one price row per symbol and day and one rate row per
    day; otherwise the latest ingestion run's row is taken first. Rates must be
    positive, as ``clean_rates`` leaves them.

    The day before a row is either inside the same price interval or the end of
    the previous one, so returns need no window over the filled rows: a symbol
    is shuffled once, as observed prices, and expanded afterwards.

    ``joined`` is a join on symbol that is made with the few prices instead of their many days;
    the columns ``kept`` of it come first in the result.
    """
    if not keyed:
        prices, rates = _newest_rows(prices, rates)
    fx = fill_rates(rates, dates)
    rate_then = fx.select("date_key", F.col("aud_usd_rate").alias("rate_then"))
    native, currency = F.col("close_price_native"), F.col("currency")

    intervals = price_intervals(prices, dates)
    intervals = rates_as_of(joined(intervals) if joined else intervals, "previous_to", rate_then)
    previous_aud = to_aud(F.col("previous_price"), currency, F.col("rate_then"))
    days = expand_days(
        intervals.withColumn("previous_aud", previous_aud).drop(
            "previous_price", "previous_to", "rate_then"
        ),
        "price_date",
    )
    days = rates_as_of(days, "date_key", fx)

    is_observed = F.col("date_key") == F.col("price_date")
    is_usdt = currency == "USDT"
    day_before = F.when(is_observed, F.col("previous_aud")).otherwise(
        to_aud(native, currency, F.col("previous_rate"))
    )
    fact = (
        convert_to_aud(days)
        .filter("close_price_aud > 0")
        .select(
            *kept,
            "symbol",
            "date_key",
            "close_price_native",
            "close_price_aud",
            simple_return(F.col("close_price_aud"), day_before).alias("daily_return"),
            is_observed.alias("is_price_observed"),
            (~is_observed).alias("is_price_forward_filled"),
            (is_usdt & F.coalesce("is_fx_observed", F.lit(False))).alias("is_fx_observed"),
            (is_usdt & F.coalesce("is_fx_forward_filled", F.lit(False))).alias(
                "is_fx_forward_filled"
            ),
            F.col("price_date").alias("source_price_date"),
            F.when(is_usdt, F.col("source_fx_date")).alias("source_fx_date"),
        )
    )
    return schemas.conform(fact, schemas.FACT_ASSET_DAILY, kept)


def return_runs(
    prices: DataFrame, rates: DataFrame, dates: DataFrame, together: Sequence[str] = ()
) -> DataFrame:
    """The returns of ``fact_asset_daily``, in one row per price instead of one per day.

    ``daily_returns`` are those of the days that the price holds, from ``date_key`` on, NULL where
    the fact has no row or no return. Prices and rates are as with ``keyed``, prices finite and
    within ``dates``. A carried price changes by the rate alone, and a day's rates, one row per
    calendar day, reach the prices as arrays. Rows of equal ``together`` lie in one task.
    """
    fx = fill_rates(rates, dates).select(
        "date_key",
        F.col("aud_usd_rate").alias("rate"),
        simple_return(F.col("previous_rate"), F.col("aud_usd_rate")).alias("carried"),
    )
    # Both sides have one row per calendar day at most.
    daily = dates.select("date_key").join(F.broadcast(fx), "date_key", "left")
    series = daily.agg(
        F.array_sort(F.collect_list(F.struct("date_key", "rate", "carried"))).alias("s")
    ).select(
        F.struct(
            F.col("s.rate").alias("rate"),
            F.col("s.carried").alias("carried"),
            F.get("s", F.lit(0))["date_key"].alias("first"),
        ).alias("series")
    ).scalar()

    def aud(price: str, day: str) -> Column:
        rate = F.get(series["rate"], F.datediff(day, series["first"]))
        return to_aud(F.col(price), F.col("currency"), rate)

    first = simple_return(aud("close_price_native", "price_date"), aud("previous_price", "previous_to"))
    after = F.datediff("valid_to", "price_date")
    place = F.datediff("price_date", series["first"])
    carried = F.when(
        F.col("currency") == "USDT", F.slice(series["carried"], place + 2, after)
    ).otherwise(F.array_repeat(F.lit(0.0), after))
    return price_intervals(prices, dates, together).select(
        *together,
        "symbol",
        F.col("price_date").alias("date_key"),
        F.concat(F.array(first), carried).alias("daily_returns"),
    )
