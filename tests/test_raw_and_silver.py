import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.operators import silver
from marketloom.plans import silver as silver_plan
from marketloom.sources import raw
from marketloom.sources.tables import assets_table, portfolios_table, read_table, write_table

RUN = "2026-06-16"


def bar(day, **changes):
    record = {
        "Date": f"{day}T00:00:00+10:00", "Open": 1.0, "High": 2.0, "Low": 0.5, "Close": 1.5,
        "Volume": 10.0, "Dividends": 0.0,
    }
    return {**record, **changes}


def kline(open_ms, volume="5", **_):
    return [open_ms, "1", "2", "0.5", "1.5", volume, open_ms + 86_399_999, "1", 2, "1", "1", "0"]


def write_json(folder, name, payload, indent=2):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(payload, indent=indent))


@pytest.fixture
def raw_root(tmp_path):
    root = tmp_path / "raw"
    equities = root / "equities/source=yahoo" / f"date={RUN}"
    write_json(equities, "CBA.AX.json", {
        "source": "yahoo", "symbol": "CBA.AX", "start_date": "2026-06-01", "end_date": None,
        "interval": "1d", "records": [bar("2026-06-01"), bar("2026-06-02", Volume=-1.0)],
    })
    (equities / "notes.txt").write_text("ignored")
    write_json(root / "fx/source=yahoo" / f"date={RUN}", "AUDUSD=X.json", {
        "source": "yahoo", "symbol": "AUDUSD=X", "start_date": "2026-06-01", "end_date": None,
        "interval": "1d", "records": [bar("2026-06-01", Close=0.65), bar("2026-06-02", Close=-0.1)],
    })
    write_json(root / "crypto/source=binance" / f"date={RUN}", "BTCUSDT.json", {
        "source": "binance", "symbol": "BTCUSDT", "start_date": "2026-06-01", "end_date": None,
        "interval": "1d",
        "records": [kline(1780272000000), kline(1780358400000, "-1"), ["x"], kline(1780444800000)],
    })
    return str(root)


def test_equity_rows(spark, raw_root):
    (row,) = silver_plan.equity_prices(spark, raw_root, RUN).collect()
    assert (row.symbol, row.asset_class, row.source, row.currency) == (
        "CBA.AX", "equity", "yahoo", "AUD",
    )
    assert (row.price_date, row.close_price, row.volume) == (date(2026, 6, 1), 1.5, 10.0)
    assert row.ingestion_run_date == date(2026, 6, 16)
    assert row.bronze_file_path.endswith("CBA.AX.json")


def test_crypto_rows_survive_a_short_record(spark, raw_root):
    rows = silver_plan.crypto_prices(spark, raw_root, RUN).orderBy("price_date").collect()
    assert [r.price_date for r in rows] == [date(2026, 6, 1), date(2026, 6, 3)]
    assert (rows[0].currency, rows[0].close_price) == ("USDT", 1.5)


def test_fx_rows(spark, raw_root):
    (row,) = silver_plan.fx_rates(spark, raw_root, RUN).collect()
    assert (row.base_currency, row.quote_currency, row.rate) == ("AUD", "USD", 0.65)


def test_no_files_is_an_error(spark, raw_root, tmp_path):
    with pytest.raises(ValueError, match="No equity JSON files found"):
        raw.read_equity_documents(spark, raw_root, "2020-01-01")
    empty = tmp_path / "raw/crypto/source=binance/date=2020-01-01"
    empty.mkdir(parents=True)
    (empty / "x.txt").write_text("no")
    with pytest.raises(ValueError, match="No crypto JSON files found"):
        raw.read_crypto_documents(spark, raw_root, "2020-01-01")


def test_build_silver_writes_and_counts(spark, raw_root, tmp_path):
    root = str(tmp_path / "silver")
    rows = silver_plan.build_silver(spark, raw_root, root, RUN)
    assert rows == {"assets": 61, "asset_prices": 3, "fx_rates": 1}
    assert read_table(spark, root, "asset_prices").columns == schemas.ASSET_PRICES.names
    silver_plan.write_equities(spark, raw_root, root, RUN, mode="append")
    assert read_table(spark, root, "asset_prices").count() == 4
    assert silver_plan.write_crypto(spark, raw_root, root, RUN) == 2
    assert silver_plan.write_fx(spark, raw_root, root, RUN) == 1


def test_rejected_files_are_left_out(spark, raw_root):
    path = f"{raw_root}/equities/source=yahoo/date={RUN}/CBA.AX.json"
    rejected = spark.createDataFrame([(path,)], "path string")
    assert silver_plan.equity_prices(spark, raw_root, RUN, rejected=rejected).count() == 0
    assert silver_plan.crypto_prices(spark, raw_root, RUN, rejected=rejected).count() == 2
    fx = f"{raw_root}/fx/source=yahoo/date={RUN}/AUDUSD=X.json"
    rejected = spark.createDataFrame([(fx,)], "path string")
    assert silver_plan.fx_rates(spark, raw_root, RUN, rejected=rejected).count() == 0


def test_landing_replaces_only_what_is_landed_again(spark, tmp_path):
    def documents(*symbols):
        rows = [("yahoo", s, [bar("2026-06-01")]) for s in symbols]
        for _, _, records in rows:
            records[0].pop("Dividends")
        return spark.createDataFrame(rows, schemas.RAW_STRUCT)

    root = str(tmp_path / "landed")
    raw.write_documents(documents("A/B", "C"), root, "equity", RUN, per_symbol=True)
    raw.write_documents(documents("C"), root, "equity", RUN, per_symbol=True)
    landed = raw.read_equity_documents(spark, root, RUN, multi_line=False)
    assert sorted(r.symbol for r in landed.collect()) == ["A/B", "C"]
    assert "file=A_B" in landed.filter("symbol = 'A/B'").first().bronze_file_path
    whole = str(tmp_path / "whole")
    raw.write_documents(documents("A", "B"), whole, "equity", RUN)
    raw.write_documents(documents("C"), whole, "equity", RUN)
    assert [r.symbol for r in raw.read_equity_documents(spark, whole, RUN, False).collect()] == ["C"]


def test_clean_rows(spark):
    good = ("s", "c", "x", date(2026, 1, 1), 0.0, 1.0, 1.0, 1.0, 1.0, "AUD", date(2026, 1, 2), None)
    rows = [good]
    for i in range(len(good) - 1):
        rows.append((*good[:i], None, *good[i + 1 :]))
    for i in range(4, 9):
        rows.append((*good[:i], -1.0, *good[i + 1 :]))
        rows.append((*good[:i], float("nan"), *good[i + 1 :]))
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ASSET_PRICES)
    assert silver.clean_prices(spark.createDataFrame(rows, nullable)).count() == 1


def test_conform_orders_casts_and_rejects_missing_columns(spark):
    df = spark.createDataFrame([("1", "p", "s", 0)], "target_weight string, portfolio_name string, symbol string, x int")
    out = schemas.conform(df, schemas.PORTFOLIO_WEIGHTS)
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in schemas.PORTFOLIO_WEIGHTS
    ]
    with pytest.raises(Exception, match="symbol"):
        schemas.conform(df.drop("symbol"), schemas.PORTFOLIO_WEIGHTS)


def test_configured_tables(spark):
    assets = assets_table(spark)
    counts = {r.asset_class: r.n for r in assets.groupBy("asset_class").agg(F.count("*").alias("n")).collect()}
    assert counts == {"equity": 30, "crypto": 30, "fx": 1}
    assert assets.filter("asset_class = 'fx'").first().description == "AUD/USD exchange rate"
    assert portfolios_table(spark).count() == 2


def test_tables_round_trip_and_key_check(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(5).withColumn("k", F.col("id") % 4)
    assert write_table(df, root, "t") == 5
    assert write_table(df, root, "t", mode="append") == 5
    table = read_table(spark, root, "t")
    assert table.count() == 10
    assert schemas.duplicate_keys(table.distinct(), ("k",)).collect()[0].k == 0
    with pytest.raises(FileNotFoundError):
        read_table(spark, root, "missing")
