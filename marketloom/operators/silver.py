"""Raw documents to clean typed price and rate rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions.parsing import epoch_ms_date, market_date


def _records(documents: DataFrame) -> DataFrame:
    """One row per record, with its document's symbol, source and file."""
    path = (
        F.col("bronze_file_path")
        if "bronze_file_path" in documents.columns
        else F.lit(None).cast("string")
    )
    return documents.select(
        "symbol", "source", path.alias("bronze_file_path"), F.explode("records").alias("record")
    )


def struct_records_to_prices(
    documents: DataFrame, run_date: str, asset_class: str = "equity", currency: str = "AUD"
) -> DataFrame:
    """Price rows of documents whose records are Date/Open/High/Low/Close/Volume structs."""
    prices = _records(documents).select(
        "symbol",
        F.lit(asset_class).alias("asset_class"),
        "source",
        market_date(F.col("record.Date")).alias("price_date"),
        F.col("record.Open").alias("open_price"),
        F.col("record.High").alias("high_price"),
        F.col("record.Low").alias("low_price"),
        F.col("record.Close").alias("close_price"),
        F.col("record.Volume").alias("volume"),
        F.lit(currency).alias("currency"),
        F.lit(run_date).cast("date").alias("ingestion_run_date"),
        "bronze_file_path",
    )
    return clean_prices(schemas.conform(prices, schemas.ASSET_PRICES))


def array_records_to_prices(
    documents: DataFrame, run_date: str, asset_class: str = "crypto", currency: str = "USDT"
) -> DataFrame:
    """Price rows of documents whose records are positional arrays of texts."""

    def number(slot: int) -> Column:
        return F.get("record", F.lit(slot)).try_cast("double")

    prices = _records(documents).select(
        "symbol",
        F.lit(asset_class).alias("asset_class"),
        "source",
        epoch_ms_date(number(0)).alias("price_date"),
        number(1).alias("open_price"),
        number(2).alias("high_price"),
        number(3).alias("low_price"),
        number(4).alias("close_price"),
        number(5).alias("volume"),
        F.lit(currency).alias("currency"),
        F.lit(run_date).cast("date").alias("ingestion_run_date"),
        "bronze_file_path",
    )
    return clean_prices(schemas.conform(prices, schemas.ASSET_PRICES))


def struct_records_to_rates(
    documents: DataFrame, run_date: str, base: str = "AUD", quote: str = "USD"
) -> DataFrame:
    """FX rate rows; the record's Close is the rate."""
    rates = _records(documents).select(
        "symbol",
        "source",
        market_date(F.col("record.Date")).alias("rate_date"),
        F.lit(base).alias("base_currency"),
        F.lit(quote).alias("quote_currency"),
        F.col("record.Close").alias("rate"),
        F.lit(run_date).cast("date").alias("ingestion_run_date"),
        "bronze_file_path",
    )
    return clean_rates(schemas.conform(rates, schemas.FX_RATES))


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def clean_prices(prices: DataFrame) -> DataFrame:
    """Rows with every required column present and no negative or NaN number."""
    numbers = ["open_price", "high_price", "low_price", "close_price", "volume"]
    required = ["symbol", "asset_class", "source", "price_date", "currency", "ingestion_run_date"]
    present = [F.col(c).isNotNull() for c in required + numbers]
    valid = [(F.col(c) >= 0) & ~F.isnan(c) for c in numbers]
    return prices.filter(_all(present + valid))


def clean_rates(rates: DataFrame) -> DataFrame:
    """Rows with every required column present and a positive rate."""
    required = [
        "symbol", "source", "rate_date", "base_currency", "quote_currency", "rate",
        "ingestion_run_date",
    ]
    present = [F.col(c).isNotNull() for c in required]
    return rates.filter(_all(present + [F.col("rate") > 0, ~F.isnan("rate")]))


def union_prices(*tables: DataFrame) -> DataFrame:
    """All rows of the price tables, matched by column name, without removing duplicates."""
    return reduce(DataFrame.unionByName, tables)


def one_per_day(table: DataFrame, key: str | list[str], day: str, value: str) -> DataFrame:
    """One value per key and day: the latest ingestion run's, then the greatest value.

    Overlapping runs may hold a key's day more than once, and one key may hold
    much of the table, so the rows are reduced before the shuffle.
    """
    order = [c for c in ("ingestion_run_date",) if c in table.columns]
    keys = [key] if isinstance(key, str) else list(key)
    known = {*keys, day, value, *order, "bronze_file_path"}
    others = [c for c in table.columns if c not in known]
    newest = F.max(F.struct(*order, value, *others)).alias("_newest")
    kept = table.groupBy(*keys, day).agg(newest)
    return kept.select(
        *keys, day, *[F.col(f"_newest.{c}").alias(c) for c in (*others, *order, value)]
    )
