"""Publishing Gold tables with an audit log.

Every load of a table goes to a folder of its own, and the ``success`` row in
the load log makes it the current one. A load that fails leaves the table as it
was, and nothing that a reader may be using is deleted.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from marketloom import schemas
from marketloom.sources.tables import read_table, write_table

LOAD_LOG = "audit/load_logs"


def check_columns(df: DataFrame, schema: StructType, table_name: str) -> None:
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"Missing columns for {table_name}: {', '.join(missing)}")


def null_out_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns(
        {c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in floating}
    )


def publishable(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """The table's contract columns in order, with NaN as NULL."""
    schema = schema or schemas.GOLD_TABLES[name]
    check_columns(df, schema, f"gold.{name}")
    return null_out_nan(df.select([F.col(f"`{f.name}`") for f in schema]))


def preview(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, after its column check; nothing is written."""
    counts = [
        publishable(df, name)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(f"gold.{name}").alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview_folder(spark: SparkSession, gold_root: str) -> DataFrame:
    return preview({name: read_table(spark, gold_root, name) for name in schemas.GOLD_TABLES})


def _now() -> datetime:
    return datetime.now(timezone.utc)


def append_load_log(
    spark: SparkSession,
    target_root: str,
    run_id: str,
    table_name: str,
    started_at: datetime,
    status: str,
    row_count: int,
    error_message: str | None,
) -> None:
    row = (run_id, table_name, started_at, _now(), status, row_count, error_message)
    log = spark.createDataFrame([row], schemas.LOAD_LOG).coalesce(1)
    log.write.mode("append").parquet(f"{target_root}/{LOAD_LOG}")


def load_logs(spark: SparkSession, target_root: str) -> DataFrame:
    return spark.read.schema(schemas.LOAD_LOG).parquet(f"{target_root}/{LOAD_LOG}")


def publish_table(
    spark: SparkSession, gold_root: str, target_root: str, name: str, run_id: str
) -> int:
    """Replace one published table and return its row count; failures are logged and raised."""
    table_name = f"gold.{name}"
    started_at = _now()
    rows = 0
    try:
        table = publishable(read_table(spark, gold_root, name), name)
        rows = write_table(table, target_root, f"{name}/run_id={run_id}")
        append_load_log(spark, target_root, run_id, table_name, started_at, "success", rows, None)
    except Exception as error:
        append_load_log(
            spark, target_root, run_id, table_name, started_at, "failed", rows, str(error)
        )
        raise
    return rows


def publish_all(
    spark: SparkSession, gold_root: str, target_root: str, run_id: str | None = None
) -> dict[str, object]:
    """Publish all Gold tables in order, stopping at the first that fails."""
    run_id = run_id or f"load_{uuid.uuid4().hex[:12]}"
    rows = {
        name: publish_table(spark, gold_root, target_root, name, run_id)
        for name in schemas.GOLD_TABLES
    }
    return {"run_id": run_id, "rows": rows}


def published_table(spark: SparkSession, target_root: str, name: str) -> DataFrame:
    """The rows of the table's latest successful load."""
    current = (
        load_logs(spark, target_root)
        .filter((F.col("table_name") == f"gold.{name}") & (F.col("status") == "success"))
        .orderBy(F.desc("finished_at"))
        .first()
    )
    if current is None:
        raise FileNotFoundError(f"gold.{name} has not been published to {target_root}")
    return spark.read.parquet(f"{target_root}/{name}/run_id={current['run_id']}")


def write_jdbc(df: DataFrame, name: str, url: str, properties: dict[str, str]) -> None:
    """Truncate and reload the table of the same name in a database."""
    publishable(df, name).write.option("truncate", True).jdbc(
        url, f"gold.{name}", mode="overwrite", properties=properties
    )
