"""Typed Parquet tables and tables built from configured values."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom import config, schemas


# The partition column of tables written by year; readers do not see it.
YEAR = "table_year"


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    between: tuple[str | None, str | None] = (None, None),
    date: str = "date_key",
) -> DataFrame:
    """A Parquet table below ``root``; a missing folder is a FileNotFoundError.

    ``between`` are the first and last day wanted, None for any; of a table written by year only
    those years' folders are read.
    """
    path = f"{root}/{name}"
    try:
        table = spark.read.parquet(path)
        for bound, compare in zip(between, ("__ge__", "__le__"), strict=True):
            if bound is not None:
                day = F.lit(str(bound)).cast("date")
                table = table.filter(getattr(F.col(date), compare)(day))
                if YEAR in table.columns:
                    table = table.filter(getattr(F.col(YEAR), compare)(F.year(day)))
        return table.drop(YEAR)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"Parquet folder does not exist: {path}") from error


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_held: bool = False,
) -> int:
    """Write a Parquet table and return the row count observed during the write.

    With ``only_held`` an overwrite replaces just the partitions that ``df`` has rows of.
    """
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_held:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(f"{root}/{name}")
    return int(rows.get["rows"])


def write_by_year(
    df: DataFrame,
    root: str,
    name: str,
    date: str = "date_key",
    mode: str = "overwrite",
    only_held: bool = False,
) -> int:
    """``write_table`` with a folder per year of ``date``, rows without one in one of their own.

    Adaptive execution sets the files' size: a year is split where it is large.
    """
    yearly = df.withColumn(YEAR, F.year(date)).hint("rebalance", F.col(YEAR))
    return write_table(yearly, root, name, mode, [YEAR], only_held)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for written tables that every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``; without that setting
    it is the warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its plan ends there."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def assets_table(
    spark: SparkSession,
    equities: Sequence[str] = config.EQUITY_SYMBOLS,
    cryptos: Sequence[str] = config.CRYPTO_SYMBOLS,
    fx_symbol: str = config.FX_SYMBOL,
) -> DataFrame:
    """The configured assets: equities, then crypto pairs, then the FX pair."""
    rows = [(s, "equity", "yahoo", "AUD", s, True) for s in equities]
    rows += [(s, "crypto", "binance", "USDT", s, True) for s in cryptos]
    rows += [(fx_symbol, "fx", "yahoo", "USD", "AUD/USD exchange rate", True)]
    return spark.createDataFrame(rows, schemas.ASSETS)


def portfolios_table(
    spark: SparkSession,
    fixed_name: str = config.FIXED_PORTFOLIO_NAME,
    optimized_name: str = config.OPTIMIZED_PORTFOLIO_NAME,
) -> DataFrame:
    """One fixed-weight and one optimizer portfolio."""
    rows = [
        (
            fixed_name,
            "fixed_weight",
            config.FIXED_PORTFOLIO_DESCRIPTION,
            True,
        ),
        (
            optimized_name,
            "optimizer",
            config.OPTIMIZED_PORTFOLIO_DESCRIPTION,
            True,
        ),
    ]
    return spark.createDataFrame(rows, schemas.DIM_PORTFOLIO)


def weights_table(
    spark: SparkSession,
    portfolio_name: str = config.FIXED_PORTFOLIO_NAME,
    weights: Mapping[str, float] = config.FIXED_PORTFOLIO_WEIGHTS,
) -> DataFrame:
    rows = [(portfolio_name, symbol, float(weight)) for symbol, weight in weights.items()]
    return spark.createDataFrame(rows, schemas.PORTFOLIO_WEIGHTS)
