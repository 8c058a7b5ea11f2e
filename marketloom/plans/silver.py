"""Raw documents to the Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import silver
from marketloom.sources import raw
from marketloom.sources.tables import assets_table, write_table


def _without(documents: DataFrame, rejected: DataFrame | None) -> DataFrame:
    """Documents whose file was not rejected."""
    if rejected is None:
        return documents

    def plain(path):
        return F.regexp_replace(path, "^file:/+", "/")

    bad = rejected.select(plain(F.col("path")).alias("_path"))
    # File paths in metadata columns are URI encoded; + stands for itself there.
    decoded = F.url_decode(F.replace("bronze_file_path", F.lit("+"), F.lit("%2B")))
    keyed = documents.withColumn("_path", plain(decoded))
    return keyed.join(bad, "_path", "left_anti").drop("_path")


def equity_prices(
    spark: SparkSession, raw_root: str, run_date: str, multi_line: bool = True,
    rejected: DataFrame | None = None,
) -> DataFrame:
    documents = raw.read_equity_documents(spark, raw_root, run_date, multi_line)
    return silver.struct_records_to_prices(_without(documents, rejected), run_date)


def crypto_prices(
    spark: SparkSession, raw_root: str, run_date: str, multi_line: bool = True,
    rejected: DataFrame | None = None,
) -> DataFrame:
    documents = raw.read_crypto_documents(spark, raw_root, run_date, multi_line)
    return silver.array_records_to_prices(_without(documents, rejected), run_date)


def fx_rates(
    spark: SparkSession, raw_root: str, run_date: str, multi_line: bool = True,
    rejected: DataFrame | None = None,
) -> DataFrame:
    documents = raw.read_fx_documents(spark, raw_root, run_date, multi_line)
    return silver.struct_records_to_rates(_without(documents, rejected), run_date)


def write_assets(
    spark: SparkSession, silver_root: str, assets: DataFrame | None = None, mode: str = "overwrite"
) -> int:
    assets = assets_table(spark) if assets is None else assets
    return write_table(assets, silver_root, "assets", mode)


def write_equities(
    spark: SparkSession, raw_root: str, silver_root: str, run_date: str,
    mode: str = "overwrite", multi_line: bool = True,
) -> int:
    prices = equity_prices(spark, raw_root, run_date, multi_line)
    return write_table(prices, silver_root, "asset_prices", mode)


def write_crypto(
    spark: SparkSession, raw_root: str, silver_root: str, run_date: str,
    mode: str = "overwrite", multi_line: bool = True,
) -> int:
    prices = crypto_prices(spark, raw_root, run_date, multi_line)
    return write_table(prices, silver_root, "asset_prices", mode)


def write_fx(
    spark: SparkSession, raw_root: str, silver_root: str, run_date: str,
    mode: str = "overwrite", multi_line: bool = True,
) -> int:
    rates = fx_rates(spark, raw_root, run_date, multi_line)
    return write_table(rates, silver_root, "fx_rates", mode)


def build_silver(
    spark: SparkSession,
    raw_root: str,
    silver_root: str,
    run_date: str,
    mode: str = "overwrite",
    assets: DataFrame | None = None,
    multi_line: bool = True,
    rejected: DataFrame | None = None,
) -> dict[str, int]:
    """Write assets, asset prices and FX rates; returns their row counts."""
    source = (spark, raw_root, run_date, multi_line, rejected)
    prices = silver.union_prices(equity_prices(*source), crypto_prices(*source))
    return {
        "assets": write_assets(spark, silver_root, assets, mode),
        "asset_prices": write_table(prices, silver_root, "asset_prices", mode),
        "fx_rates": write_table(fx_rates(*source), silver_root, "fx_rates", mode),
    }
