import json
from datetime import date, timedelta

import pytest

from marketloom import schemas
from marketloom.operators import portfolio, publish, weights
from marketloom.plans import gold, market_run
from marketloom.sources import raw
from marketloom.sources.tables import assets_table, read_table, weights_table

RUN = "2026-06-16"
START = date(2026, 1, 1)
DAY_MS = 86_400_000
CURRENT = {"VAS.AX": 0.40, "CBA.AX": 0.25, "BHP.AX": 0.15, "BTCUSDT": 0.10, "ETHUSDT": 0.10}


@pytest.fixture
def roots(tmp_path):
    """Raw files of three equities, two pairs and one rate over forty days."""
    raw = tmp_path / "raw"

    def write(folder, source, symbol, records):
        path = raw / folder / f"source={source}" / f"date={RUN}"
        path.mkdir(parents=True, exist_ok=True)
        payload = {
            "source": source, "symbol": symbol, "start_date": "2026-01-01", "end_date": None,
            "interval": "1d", "records": records,
        }
        (path / f"{symbol}.json").write_text(json.dumps(payload, indent=2))

    def bars(base, weekdays=True):
        days = [START + timedelta(k) for k in range(40)]
        return [
            {"Date": f"{day}T00:00:00+10:00", "Open": p, "High": p, "Low": p, "Close": p, "Volume": 1}
            for k, day in enumerate(days)
            if not weekdays or day.weekday() < 5
            for p in [base * (1 + 0.002 * k + 0.01 * ((k * 7 + int(base)) % 5))]
        ]

    for n, symbol in enumerate(["VAS.AX", "CBA.AX", "BHP.AX"]):
        write("equities", "yahoo", symbol, bars(10 + 7 * n))
    write("fx", "yahoo", "AUDUSD=X", bars(0.65))
    for n, symbol in enumerate(["BTCUSDT", "ETHUSDT"]):
        rows = []
        for k, b in enumerate(bars(100 + 11 * n, weekdays=False)):
            t = 1767225600000 + k * DAY_MS
            price = str(b["Close"])
            rows.append([t, price, price, price, price, "1", t + DAY_MS - 1, "1", 1, "1", "1", "0"])
        write("crypto", "binance", symbol, rows)
    return {n: str(tmp_path / n) for n in ("raw", "silver", "gold", "published")}


def run(spark, roots, **options):
    assets = assets_table(spark, ["VAS.AX", "CBA.AX", "BHP.AX"], ["BTCUSDT", "ETHUSDT"])
    return market_run.run_market(
        spark, roots["raw"], roots["silver"], roots["gold"], roots["published"], RUN,
        assets=assets, **options,
    )


def test_all_stages(spark, roots):
    done = run(spark, roots)
    assert done["validation"]["valid_count"] == 6
    assert done["silver"]["asset_prices"] == 3 * 28 + 80
    assert done["gold"]["dim_date"] == 40
    assert done["gold"]["fact_portfolio_daily"] == 39
    assert done["optimizer"] == {"fact_optimizer_summary": 1, "fact_optimizer_weights": 5}
    assert list(done["publish"]["rows"]) == list(schemas.GOLD_TABLES)
    gold.check_gold_keys(spark, roots["gold"], list(schemas.GOLD_TABLES))
    for name, schema in schemas.GOLD_TABLES.items():
        table = publish.published_table(spark, roots["published"], name)
        assert table.columns == schema.names
        assert table.count() == done["publish"]["rows"][name]
    summary = read_table(spark, roots["gold"], "fact_portfolio_summary_daily")
    assert portfolio.latest_summary(summary, 1).first().date_key == START + timedelta(39)
    chosen = read_table(spark, roots["gold"], "fact_optimizer_weights")
    top = weights.top_weight_changes(chosen, 2).collect()
    assert len(top) == 2 and top[0].weight_difference >= top[1].weight_difference
    preview = {r.table_name: r.row_count for r in publish.preview_folder(spark, roots["gold"]).collect()}
    assert preview["gold.fact_optimizer_weights"] == 5


def _documents(spark, symbols, first):
    """Landed form of the fixture's files: one row per document."""
    rows = []
    for n, symbol in enumerate(symbols):
        records = []
        for k in range(12):
            day = START + timedelta(k)
            price = float(first + n + k)
            records.append((f"{day}T00:00:00+10:00", price, price, price, price, 1.0))
        rows.append(("yahoo", symbol, records))
    record = "struct<Date string, Open double, High double, Low double, Close double, Volume double>"
    return spark.createDataFrame(rows, f"source string, symbol string, records array<{record}>")


@pytest.mark.parametrize("per_symbol", [False, True])
def test_landed_documents_pass_validation_and_reach_gold(spark, tmp_path, per_symbol):
    root = str(tmp_path / "raw")
    options = {"start_date": "2026-01-01", "per_symbol": per_symbol}
    raw.write_documents(_documents(spark, ["VAS.AX", "CBA.AX"], 10), root, "equity", RUN, **options)
    raw.write_documents(_documents(spark, ["AUDUSD=X"], 1), root, "fx", RUN, **options)
    pairs = spark.createDataFrame(
        [("binance", "BTCUSDT", [[str(1767225600000 + k * DAY_MS), *["5"] * 5, str(1767225600000 + (k + 1) * DAY_MS), "1", "1", "1", "1", "0"] for k in range(12)])],
        "source string, symbol string, records array<array<string>>",
    )
    raw.write_documents(pairs, root, "crypto", RUN, **options)
    assets = assets_table(spark, ["VAS.AX", "CBA.AX"], ["BTCUSDT"])
    held = weights_table(spark, "p", {"VAS.AX": 0.5, "CBA.AX": 0.5})
    done = market_run.run_market(
        spark, root, str(tmp_path / "silver"), str(tmp_path / "gold"), str(tmp_path / "out"), RUN,
        assets=assets, portfolio_weights=held, current={"VAS.AX": 0.5, "CBA.AX": 0.5},
        multi_line=False, rejected_root=str(tmp_path / "rejected"),
    )
    assert done["validation"]["valid_count"] == done["validation"]["total_files"] == 4
    assert done["silver"]["asset_prices"] == 36
    assert done["gold"]["fact_portfolio_daily"] == 11


def test_lines_that_are_missing_or_double_are_errors(spark, tmp_path):
    root = str(tmp_path / "raw")
    both = _documents(spark, ["VAS.AX"], 10).unionByName(_documents(spark, ["VAS.AX"], 20))
    raw.write_documents(both, root, "equity", RUN, "2026-01-01")
    assets = assets_table(spark, ["VAS.AX", "CBA.AX"], [])
    _, results, _ = market_run.validate_run(spark, root, RUN, assets, multi_line=False)
    errors = {r.symbol: r.errors for r in results.collect()}
    assert errors["VAS.AX"] == ["symbol has more than one document"]
    assert errors["CBA.AX"] == errors["AUDUSD=X"] == ["file does not exist"]


def test_a_failed_validation_stops_the_run(spark, roots, tmp_path):
    folder = tmp_path / "raw/equities/source=yahoo" / f"date={RUN}"
    for name in ("VAS.AX", "CBA.AX"):
        (folder / f"{name}.json").write_text("{")
    with pytest.raises(RuntimeError, match="validation failed"):
        run(spark, roots)
    assert not (tmp_path / "silver").exists()


def test_a_rejected_file_below_the_threshold_is_left_out(spark, roots, tmp_path):
    path = tmp_path / "raw/equities/source=yahoo" / f"date={RUN}" / "BHP.AX.json"
    payload = json.loads(path.read_text())
    payload["records"][0]["Volume"] = -1
    path.write_text(json.dumps(payload))
    done = run(
        spark, roots, rejected_root=str(tmp_path / "rejected"), skip_gold=True, skip_publish=True
    )
    assert done["silver"]["asset_prices"] == 2 * 28 + 80
    assert done["gold"] is None and done["publish"] is None
    kept = run(spark, roots, skip_validation=True, skip_gold=True, skip_publish=True)
    assert kept["silver"]["asset_prices"] == 3 * 28 - 1 + 80


def test_a_failed_load_leaves_the_published_table(spark, roots):
    run(spark, roots, skip_publish=True)
    publish.publish_table(spark, roots["gold"], roots["published"], "dim_portfolio", "load_1")
    with pytest.raises(FileNotFoundError):
        publish.publish_table(spark, "/nowhere", roots["published"], "dim_portfolio", "load_2")
    assert publish.published_table(spark, roots["published"], "dim_portfolio").count() == 2
    log = {r.run_id: r for r in publish.load_logs(spark, roots["published"]).collect()}
    assert (log["load_1"].status, log["load_1"].row_count) == ("success", 2)
    assert log["load_2"].status == "failed" and "does not exist" in log["load_2"].error_message
    with pytest.raises(FileNotFoundError, match="has not been published"):
        publish.published_table(spark, roots["published"], "dim_date")


def test_publishing_checks_columns_and_drops_nan(spark):
    df = spark.createDataFrame(
        [("p", "s", float("nan"), 1)], "portfolio_name string, symbol string, w double, extra int"
    )
    with pytest.raises(ValueError, match="Missing columns for gold.dim_portfolio: portfolio_type"):
        publish.publishable(df, "dim_portfolio")
    ready = publish.publishable(df.withColumnRenamed("w", "target_weight"), "x", schemas.PORTFOLIO_WEIGHTS)
    assert [tuple(r) for r in ready.collect()] == [("p", "s", None)]
