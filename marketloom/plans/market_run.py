"""The whole run: validate, Silver, Gold, optimize, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession

from marketloom import config
from marketloom.operators import publish, validate
from marketloom.plans import gold, silver
from marketloom.sources import raw
from marketloom.sources.tables import assets_table, stored, write_table


def validate_run(
    spark: SparkSession,
    raw_root: str,
    run_date: str,
    assets: DataFrame | None = None,
    failure_threshold: float = config.VALIDATION_FAILURE_THRESHOLD,
    rejected_root: str | None = None,
    results_root: str | None = None,
    multi_line: bool = True,
) -> tuple[Row, DataFrame, DataFrame | None]:
    """Validate a run's files.

    Returns the summary row, the results and, where ``rejected_root`` is given,
    the rejected files, which are recorded there with their errors. The raw
    files stay where they are. Results are written, to ``results_root`` or else to the
    shared folder, and read back, so that the files are read once; the report in manifest
    order goes beside them in ``results_root``. Without
    ``multi_line`` documents are lines, as ``raw.write_documents`` lands them.
    """
    assets = assets_table(spark) if assets is None else assets
    order = (*config.EQUITY_SYMBOLS, config.FX_SYMBOL, *config.CRYPTO_SYMBOLS)
    manifest = validate.expected_files(assets, raw_root, run_date, order)
    folders = [
        raw.partition_folder(raw_root, folder, source, run_date)
        for folder, source in raw.RAW_FOLDERS.values()
    ]
    check = validate.validate_files if multi_line else validate.validate_lines
    results = check(spark, manifest, folders)
    if results_root is not None:
        name = f"validation/date={run_date}"
        write_table(results, results_root, name)
        results = spark.read.parquet(f"{results_root}/{name}")
    else:
        results = stored(results, "validation")
    if results_root is not None:
        report = validate.report_lines(results, ["file_no"], failure_threshold)
        write_table(report, results_root, f"report/date={run_date}")
    summary = validate.summarize(results, failure_threshold).first()
    rejected = None
    if rejected_root is not None:
        name = f"date={run_date}"
        write_table(
            validate.rejected_files(results, raw_root, rejected_root), rejected_root, name
        )
        rejected = spark.read.parquet(f"{rejected_root}/{name}")
    return summary, results, rejected


def run_market(
    spark: SparkSession,
    raw_root: str,
    silver_root: str,
    gold_root: str,
    target_root: str,
    run_date: str,
    *,
    assets: DataFrame | None = None,
    portfolio_weights: DataFrame | None = None,
    current: Mapping[str, float] = config.FIXED_PORTFOLIO_WEIGHTS,
    symbols: Sequence[str] | None = None,
    silver_mode: str = "overwrite",
    gold_mode: str = "overwrite",
    multi_line: bool = True,
    failure_threshold: float = config.VALIDATION_FAILURE_THRESHOLD,
    rejected_root: str | None = None,
    results_root: str | None = None,
    skip_validation: bool = False,
    skip_silver: bool = False,
    skip_gold: bool = False,
    skip_publish: bool = False,
) -> dict[str, object]:
    """Run all stages that are not skipped; a failed validation stops the run."""
    done: dict[str, object] = dict.fromkeys(
        ["validation", "silver", "gold", "optimizer", "publish"]
    )
    rejected = None
    if not skip_validation:
        summary, _, rejected = validate_run(
            spark,
            raw_root,
            run_date,
            assets,
            failure_threshold,
            rejected_root,
            results_root,
            multi_line,
        )
        done["validation"] = summary.asDict()
        if summary["should_fail_run"]:
            raise RuntimeError("Stopping the run because raw file validation failed.")
    if not skip_silver:
        done["silver"] = silver.build_silver(
            spark, raw_root, silver_root, run_date, silver_mode, assets, multi_line, rejected
        )
    if not skip_gold:
        done["gold"] = gold.build_gold(
            spark, silver_root, gold_root, gold_mode, portfolio_weights
        )
        done["optimizer"] = gold.optimize_gold(
            spark, gold_root, gold_mode, symbols=symbols, current=current
        )
    if not skip_publish:
        done["publish"] = publish.publish_all(spark, gold_root, target_root)
    return done
