"""Declared table schemas and the projection that enforces them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, DOUBLE, LONG = StringType(), DoubleType(), LongType()
BOOLEAN, DATE, TIMESTAMP = BooleanType(), DateType(), TimestampType()


def _table(columns: dict[str, DataType], nullable: str = "") -> StructType:
    """A schema whose columns are required unless named in ``nullable``."""
    optional = nullable.split()
    return StructType([StructField(c, t, c in optional) for c, t in columns.items()])


def _document(record: DataType) -> StructType:
    fields = {"source": STRING, "symbol": STRING, "records": ArrayType(record)}
    return _table(fields, nullable="source symbol records")


_BAR_NUMBERS = ["Open", "High", "Low", "Close", "Volume"]
_BAR = _table(
    {"Date": STRING, **dict.fromkeys(_BAR_NUMBERS, DOUBLE)},
    nullable="Date Open High Low Close Volume",
)

RAW_STRUCT = _document(_BAR)
RAW_ARRAY = _document(ArrayType(STRING))

ASSETS = _table(
    {
        "symbol": STRING,
        "asset_class": STRING,
        "source": STRING,
        "currency": STRING,
        "description": STRING,
        "is_active": BOOLEAN,
    },
    nullable="description",
)
ASSET_PRICES = _table(
    {
        "symbol": STRING,
        "asset_class": STRING,
        "source": STRING,
        "price_date": DATE,
        "open_price": DOUBLE,
        "high_price": DOUBLE,
        "low_price": DOUBLE,
        "close_price": DOUBLE,
        "volume": DOUBLE,
        "currency": STRING,
        "ingestion_run_date": DATE,
        "bronze_file_path": STRING,
    },
    nullable="open_price high_price low_price close_price volume bronze_file_path",
)
FX_RATES = _table(
    {
        "symbol": STRING,
        "source": STRING,
        "rate_date": DATE,
        "base_currency": STRING,
        "quote_currency": STRING,
        "rate": DOUBLE,
        "ingestion_run_date": DATE,
        "bronze_file_path": STRING,
    },
    nullable="bronze_file_path",
)
DIM_DATE = _table(
    {
        "date_key": DATE,
        "calendar_year": LONG,
        "calendar_quarter": LONG,
        "calendar_month": LONG,
        "month_name": STRING,
        "day_of_month": LONG,
        "day_of_week": LONG,
        "day_name": STRING,
        "is_weekend": BOOLEAN,
    }
)
DIM_ASSET = ASSETS
DIM_PORTFOLIO = _table(
    {
        "portfolio_name": STRING,
        "portfolio_type": STRING,
        "description": STRING,
        "is_active": BOOLEAN,
    },
    nullable="description",
)
PORTFOLIO_WEIGHTS = _table(
    {"portfolio_name": STRING, "symbol": STRING, "target_weight": DOUBLE}
)
FACT_ASSET_DAILY = _table(
    {
        "symbol": STRING,
        "date_key": DATE,
        "close_price_native": DOUBLE,
        "close_price_aud": DOUBLE,
        "daily_return": DOUBLE,
        "is_price_observed": BOOLEAN,
        "is_price_forward_filled": BOOLEAN,
        "is_fx_observed": BOOLEAN,
        "is_fx_forward_filled": BOOLEAN,
        "source_price_date": DATE,
        "source_fx_date": DATE,
    },
    nullable="daily_return source_fx_date",
)
FACT_PORTFOLIO_DAILY = _table(
    {
        "portfolio_name": STRING,
        "date_key": DATE,
        "daily_return": DOUBLE,
        "cumulative_return": DOUBLE,
        "has_forward_filled_price": BOOLEAN,
        "has_forward_filled_fx": BOOLEAN,
        "observed_asset_count": LONG,
        "forward_filled_price_count": LONG,
        "forward_filled_fx_count": LONG,
    }
)
FACT_PORTFOLIO_SUMMARY_DAILY = _table(
    {
        "portfolio_name": STRING,
        "date_key": DATE,
        "observation_count": LONG,
        "ytd_return": DOUBLE,
        "annual_return": DOUBLE,
        "annual_volatility": DOUBLE,
        "risk_free_rate": DOUBLE,
        "sharpe_ratio": DOUBLE,
        "max_drawdown": DOUBLE,
    },
    nullable="ytd_return annual_return annual_volatility sharpe_ratio max_drawdown",
)
FACT_OPTIMIZER_SUMMARY = _table(
    {
        "portfolio_name": STRING,
        "as_of_date": DATE,
        "lookback_start_date": DATE,
        "lookback_end_date": DATE,
        "observation_count": LONG,
        "risk_free_rate": DOUBLE,
        "annual_return": DOUBLE,
        "annual_volatility": DOUBLE,
        "sharpe_ratio": DOUBLE,
        "optimizer_method": STRING,
        "constraint_set_name": STRING,
        "optimization_success": BOOLEAN,
        "optimization_message": STRING,
    },
    nullable="annual_return annual_volatility sharpe_ratio optimization_message",
)
FACT_OPTIMIZER_WEIGHTS = _table(
    {
        "portfolio_name": STRING,
        "as_of_date": DATE,
        "symbol": STRING,
        "current_weight": DOUBLE,
        "optimized_weight": DOUBLE,
        "weight_difference": DOUBLE,
    }
)
LOAD_LOG = _table(
    {
        "run_id": STRING,
        "table_name": STRING,
        "started_at": TIMESTAMP,
        "finished_at": TIMESTAMP,
        "status": STRING,
        "row_count": LONG,
        "error_message": STRING,
    },
    nullable="finished_at row_count error_message",
)

# Gold tables in dependency order; the folder name is also the published table name.
GOLD_TABLES: dict[str, StructType] = {
    "dim_date": DIM_DATE,
    "dim_asset": DIM_ASSET,
    "dim_portfolio": DIM_PORTFOLIO,
    "fact_asset_daily": FACT_ASSET_DAILY,
    "fact_portfolio_daily": FACT_PORTFOLIO_DAILY,
    "fact_portfolio_summary_daily": FACT_PORTFOLIO_SUMMARY_DAILY,
    "fact_optimizer_summary": FACT_OPTIMIZER_SUMMARY,
    "fact_optimizer_weights": FACT_OPTIMIZER_WEIGHTS,
}

# Key columns of the published tables.
GOLD_KEYS: dict[str, tuple[str, ...]] = {
    "dim_date": ("date_key",),
    "dim_asset": ("symbol",),
    "dim_portfolio": ("portfolio_name",),
    "fact_asset_daily": ("symbol", "date_key"),
    "fact_portfolio_daily": ("portfolio_name", "date_key"),
    "fact_portfolio_summary_daily": ("portfolio_name", "date_key"),
    "fact_optimizer_summary": ("portfolio_name", "as_of_date"),
    "fact_optimizer_weights": ("portfolio_name", "as_of_date", "symbol"),
}


def conform(df: DataFrame, schema: StructType, kept: Sequence[str] = ()) -> DataFrame:
    """Select the columns ``kept``, then the declared ones in order, cast to their declared types."""
    declared = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*[F.col(f"`{c}`") for c in kept], *declared)


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
