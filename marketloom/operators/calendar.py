"""The date dimension and forward fill over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom import schemas


def date_bounds(prices: DataFrame) -> DataFrame:
    """First and last price date, one row."""
    return prices.agg(
        F.min("price_date").alias("start_date"), F.max("price_date").alias("end_date")
    )


def calendar_days(prices: DataFrame) -> DataFrame:
    """Every day from the first to the last price date."""
    days = F.sequence("start_date", "end_date", F.expr("interval 1 day"))
    # Without prices the bounds are NULL, and explode yields no days.
    return date_bounds(prices).select(F.explode(days).alias("date_key"))


def dim_date(prices: DataFrame) -> DataFrame:
    day = F.col("date_key")
    table = calendar_days(prices).select(
        "date_key",
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("calendar_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
    return schemas.conform(table, schemas.DIM_DATE)


def dim_asset(assets: DataFrame) -> DataFrame:
    return schemas.conform(assets, schemas.DIM_ASSET).distinct()


def spine(dates: DataFrame) -> Column:
    """First and last day of a date dimension, as a scalar subquery."""
    bounds = F.struct(
        F.min("date_key").alias("start_date"), F.max("date_key").alias("end_date")
    )
    return dates.agg(bounds.alias("bounds")).scalar()


def asset_calendar(prices: DataFrame, dates: DataFrame) -> DataFrame:
    """Every asset on every calendar day.

    The bounds reach the rows as a scalar subquery, so that each asset expands
    its own days and no join is needed.
    """
    assets = prices.select("symbol", "asset_class", "source", "currency").distinct()
    days = F.sequence("_spine.start_date", "_spine.end_date", F.expr("interval 1 day"))
    return assets.withColumn("_spine", spine(dates)).select(
        "symbol", "asset_class", "source", "currency", F.explode(days).alias("price_date")
    )


def valid_until(
    observed: DataFrame,
    key: str | Sequence[str],
    day: str,
    dates: DataFrame,
    dealt_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``valid_to``: the day before the key's next observation, or the last calendar day.

    Expects one row per key and day, which bounds a key's rows by the length of
    the calendar. The rows are going to be expanded, so the shuffle's partition
    count is set here; left open, it would be coalesced to the size of the few
    rows before the expansion. Rows are dealt by the key, or by those of its columns that
    ``dealt_by`` names.
    """
    keys = [key] if isinstance(key, str) else list(key)
    partitions = int(observed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    observed = observed.repartition(partitions, *(dealt_by or keys))
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    last_day = spine(dates)["end_date"]
    return observed.withColumn("valid_to", F.coalesce(F.date_sub(following, 1), last_day))


def expand_days(intervals: DataFrame, day: str) -> DataFrame:
    """One row with a ``date_key`` for every day from ``day`` to ``valid_to``.

    This equals joining the calendar and carrying the last value forward, but
    needs neither the join nor a window over the expanded rows.
    """
    days = F.sequence(day, "valid_to", F.expr("interval 1 day"))
    return intervals.select("*", F.explode(days).alias("date_key")).drop("valid_to")


def fill_prices(prices: DataFrame, dates: DataFrame) -> DataFrame:
    """Forward-filled close prices with their source date and fill flags.

    Expects one row per symbol and day (``silver.one_per_day``). Days before a
    symbol's first price have no row.
    """
    observed = prices.select(
        "symbol", "currency", "price_date", F.col("close_price").alias("close_price_native")
    )
    filled = expand_days(valid_until(observed, "symbol", "price_date", dates), "price_date")
    is_observed = F.col("date_key") == F.col("price_date")
    return filled.select(
        "symbol",
        "currency",
        "date_key",
        "close_price_native",
        F.col("price_date").alias("source_price_date"),
        is_observed.alias("is_price_observed"),
        (~is_observed).alias("is_price_forward_filled"),
    )


def fill_prices_windowed(prices: DataFrame, dates: DataFrame) -> DataFrame:
    """The same rows as ``fill_prices``, by join and window over the whole calendar."""
    running = (
        Window.partitionBy("symbol")
        .orderBy("price_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    observed = prices.select(
        "symbol",
        "price_date",
        F.col("price_date").alias("observed_date"),
        F.col("close_price").alias("observed_close"),
    )
    joined = asset_calendar(prices, dates).join(observed, ["symbol", "price_date"], "left")
    return (
        joined.withColumns(
            {
                "source_price_date": F.last("observed_date", True).over(running),
                "close_price_native": F.last("observed_close", True).over(running),
            }
        )
        .filter("source_price_date is not null")
        .select(
            "symbol",
            "currency",
            F.col("price_date").alias("date_key"),
            "close_price_native",
            "source_price_date",
            F.col("observed_date").isNotNull().alias("is_price_observed"),
            F.col("observed_date").isNull().alias("is_price_forward_filled"),
        )
    )


PAIR = ["base_currency", "quote_currency"]


def fill_pairs(rates: DataFrame, dates: DataFrame) -> DataFrame:
    """Forward-filled rates of each currency pair, from its first rate inside the calendar on.

    Expects one positive rate per pair and day. A rate dated before the first calendar
    day is not carried in. A pair has at most one row per calendar day.
    ``previous_rate`` is the filled rate of the day before.
    """
    bounds = spine(dates)
    inside = F.col("source_fx_date").between(bounds["start_date"], bounds["end_date"])
    observed = rates.select(*PAIR, F.col("rate_date").alias("source_fx_date"), "rate").filter(inside)
    by_day = Window.partitionBy(*PAIR).orderBy("source_fx_date")
    intervals = observed.withColumns(
        {
            "valid_to": F.coalesce(
                F.date_sub(F.lead("source_fx_date").over(by_day), 1), bounds["end_date"]
            ),
            "rate_before": F.lag("rate").over(by_day),
        }
    )
    filled = expand_days(intervals, "source_fx_date")
    is_observed = F.col("date_key") == F.col("source_fx_date")
    previous = F.when(is_observed, F.col("rate_before")).otherwise(F.col("rate"))
    return filled.select(
        *PAIR,
        "date_key",
        "rate",
        previous.alias("previous_rate"),
        "source_fx_date",
        is_observed.alias("is_fx_observed"),
        (~is_observed).alias("is_fx_forward_filled"),
    )


def of_pair(rates: DataFrame, base: str = "AUD", quote: str = "USD") -> DataFrame:
    """The rates of one pair; a table that names no currencies holds that pair alone."""
    if not set(PAIR) <= set(rates.columns):
        return rates.withColumns(dict(zip(PAIR, (F.lit(base), F.lit(quote)))))
    return rates.filter((F.col("base_currency") == base) & (F.col("quote_currency") == quote))


def fill_rates(rates: DataFrame, dates: DataFrame) -> DataFrame:
    """``fill_pairs`` of AUD/USD alone: at most one row per calendar day."""
    filled = fill_pairs(of_pair(rates), dates).drop(*PAIR)
    return filled.withColumnRenamed("rate", "aud_usd_rate")


def fx_calendar(rates: DataFrame, dates: DataFrame) -> DataFrame:
    """``fill_rates`` on every calendar day, with NULL rates before the first one."""
    # Both sides have one row per calendar day at most.
    filled = F.broadcast(fill_rates(rates, dates))
    return (
        dates.select("date_key")
        .join(filled, "date_key", "left")
        .select(
            "date_key",
            "aud_usd_rate",
            "source_fx_date",
            F.coalesce("is_fx_observed", F.lit(False)).alias("is_fx_observed"),
            F.coalesce("is_fx_forward_filled", F.lit(False)).alias("is_fx_forward_filled"),
        )
    )
