import json

import pytest

from marketloom.operators import validate
from marketloom.plans import market_run
from marketloom.sources.tables import assets_table

RUN = "2026-06-16"
OPEN = 1780272000000  # 2026-06-01
DAY = 86_400_000


def bar(**changes):
    record = {"Date": "2026-06-01T00:00:00+10:00", "Open": 1, "High": 2, "Low": 1, "Close": 1.5, "Volume": 9}
    record.update(changes)
    return {k: v for k, v in record.items() if v != "DROP"}


def kline(**slots):
    values = [OPEN, "1", "2", "1", "2", "5", OPEN + DAY - 1, "3", 4, "1", "1", "0"]
    for name, value in slots.items():
        values[validate.ARRAY_SLOTS.index(name)] = value
    return values


def payload(source="yahoo", **changes):
    base = {
        "source": source, "symbol": "X", "start_date": "2026-06-01", "end_date": "2026-06-05",
        "interval": "1d", "records": [bar()] if source == "yahoo" else [kline()],
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v != "DROP"}


STRUCT = [
    ([bar(Close="DROP")], ["record 0 missing field Close"]),
    ([bar(Date="DROP")], ["record 0 missing field Date"]),
    ([bar(), bar()], ["record 1 has duplicate date 2026-06-01"]),
    ([bar(Date="2026-05-31")], ["record 0 date is before start_date"]),
    ([bar(Date="2026-06-05")], []),
    ([bar(Date="2026-06-06")], ["record 0 date is after end_date"]),
    ([bar(Date="yesterday")], ["record 0 field Date is not a valid date"]),
    ([bar(Date=20260601)], []),
    ([bar(Date=None)], ["record 0 field Date is not a valid date"]),
    ([bar(Open=None)], ["record 0 field Open is not numeric"]),
    ([bar(Open=True, High="1_0", Low=" 2 ", Close=float("nan"))], []),
    ([bar(Open=-1, Low="-2", Volume="x")],
     ["record 0 field Open is negative", "record 0 field Low is negative",
      "record 0 field Volume is not numeric"]),
    ([5, [1], bar()], ["record 0 is not an object", "record 1 is not an object"]),
]
ARRAY = [
    ([kline()[:5]], ["record 0 has fewer than 12 fields"]),
    ([{"a": 1}], ["record 0 is not a list"]),
    ([kline(volume="-1")], ["record 0 field volume is negative"]),
    ([kline(), kline()], [f"record 1 has duplicate open_time {OPEN}"]),
    ([kline(open_time=OPEN + 9 * DAY, close_time=OPEN + 10 * DAY)],
     ["record 0 date is after end_date"]),
    ([kline(open_time="x")], ["record 0 field open_time is not an integer"]),
    ([kline(open_time=-5)], ["record 0 field open_time is negative"]),
    ([kline(close_time=OPEN)], ["record 0 close_time must be greater than open_time"]),
    ([kline(number_of_trades="1.5")], ["record 0 field number_of_trades is not an integer"]),
    ([kline(number_of_trades=1.5)], []),
    ([kline(open_time=str(OPEN), quote_asset_volume=None)],
     ["record 0 field quote_asset_volume is not numeric"]),
]
TOP = [
    (payload(records="DROP"), ["missing top-level field records"]),
    (payload(interval="DROP", records=[]), ["missing top-level field interval", "records is empty"]),
    (payload(records={}), ["records is not a list"]),
    (payload(records=None), ["records is not a list"]),
    (payload(source="binance", records=[bar()]), ["source mismatch: expected yahoo, got binance"]),
    (payload(symbol=None), ["symbol mismatch: expected X, got None"]),
    (payload(start_date="June"), ["top-level field start_date is not a valid date"]),
    (payload(start_date=None, end_date=None, records=[bar(Date="1999-01-01")]), []),
    ([1], ["top-level JSON is not an object"]),
    (None, ["top-level JSON is not an object"]),
]


def test_every_rule(spark):
    cases = [("yahoo", json.dumps(payload(records=r)), e) for r, e in STRUCT]
    cases += [("binance", json.dumps(payload("binance", records=r)), e) for r, e in ARRAY]
    cases += [("yahoo", json.dumps(p), e) for p, e in TOP]
    cases += [
        ("yahoo", "{broken", ["file is not valid JSON"]),
        ("yahoo", json.dumps(payload()) + " x", ["file is not valid JSON"]),
        ("yahoo", "", ["file is not valid JSON"]),
        ("other", json.dumps(payload("other")),
         ["unsupported source for record validation: other"]),
    ]
    rows = [(i, s, "X", t) for i, (s, t, _) in enumerate(cases)]
    documents = spark.createDataFrame(rows, "no int, source string, symbol string, text string")
    got = {r.no: r.errors for r in validate.validate_documents(documents).collect()}
    for i, (_, text, expected) in enumerate(cases):
        assert got[i] == expected, text


def test_repeats_in_a_long_document(spark):
    """The cost of finding repeats must not grow with the square of the records."""
    days = [f"{2000 + k // 336}-{k // 28 % 12 + 1:02d}-{k % 28 + 1:02d}" for k in range(20_000)]
    records = [bar(Date=day) for day in days] + [bar(Date=days[7])]
    text = json.dumps(payload(start_date=None, end_date=None, records=records))
    documents = spark.createDataFrame([("yahoo", "X", text)], "source string, symbol string, text string")
    (row,) = validate.validate_documents(documents).collect()
    assert row.errors == [f"record 20000 has duplicate date {days[7]}"]


@pytest.fixture
def run_root(tmp_path):
    folder = tmp_path / "raw/equities/source=yahoo" / f"date={RUN}"
    folder.mkdir(parents=True)
    (folder / "OK.json").write_text(json.dumps(payload(symbol="OK")))
    (folder / "A_B.json").write_text(json.dumps(payload(symbol="A/B", records=[])))
    (folder / "EMPTY.json").write_text("")
    (folder / "FOLDER.json").mkdir()
    (folder / "BYTES.json").write_bytes(b"\xff\xfe{}")
    return str(tmp_path / "raw")


def test_files_of_a_run(spark, run_root, tmp_path):
    assets = assets_table(spark, ["OK", "A/B", "EMPTY", "FOLDER", "BYTES", "GONE"], ["BTCUSDT"])
    summary, results, rejected = market_run.validate_run(
        spark, run_root, RUN, assets, rejected_root=str(tmp_path / "rejected"),
        results_root=str(tmp_path / "results"),
    )
    rows = {r.symbol: r for r in results.collect()}
    assert {s: r.errors for s, r in rows.items()} == {
        "OK": [],
        "A/B": ["records is empty"],
        "EMPTY": ["file is empty"],
        "FOLDER": ["path is not a file"],
        "BYTES": ["file is not valid JSON"],
        "GONE": ["file does not exist"],
        "BTCUSDT": ["file does not exist"],
        "AUDUSD=X": ["file does not exist"],
    }
    assert rows["OK"].path == f"{run_root}/equities/source=yahoo/date={RUN}/OK.json"
    assert rows["OK"].status == "valid" and rows["OK"].file_size_bytes > 0
    assert (rows["EMPTY"].file_size_bytes, rows["GONE"].file_size_bytes) == (0, None)
    assert (summary.total_files, summary.valid_count, summary.should_fail_run) == (8, 1, True)
    moved = {r.symbol: r.rejected_path for r in rejected.collect()}
    assert set(moved) == {"A/B", "EMPTY", "FOLDER", "BYTES"}
    assert moved["A/B"] == f"{tmp_path}/rejected/equities/source=yahoo/date={RUN}/A_B.json"


def test_manifest_paths_and_extension(spark):
    assets = assets_table(spark, ["CBA.AX"], ["BTCUSDT"])
    rows = validate.expected_files(assets, "/r", RUN).orderBy("group_no").collect()
    assert [r.symbol for r in rows] == ["CBA.AX", "AUDUSD=X", "BTCUSDT"]
    assert rows[1].path == f"/r/fx/source=yahoo/date={RUN}/AUDUSD=X.json"
    expected = spark.createDataFrame(
        [("k", "s", "/r/x.txt"), ("j", "s", "/r/x.JSON")], "_key string, symbol string, path string"
    )
    checked = spark.createDataFrame([], "_key string, file_size_bytes bigint, payload_errors array<string>")
    hidden = spark.createDataFrame([], "_key string, is_folder boolean")
    got = {r.path: r.errors for r in validate.file_results(expected, checked, hidden).collect()}
    assert got["/r/x.txt"] == ["file extension is not .json", "file does not exist"]
    assert got["/r/x.JSON"] == ["file does not exist"]


@pytest.mark.parametrize("invalid, total, fails", [(1, 4, False), (1, 2, True), (0, 0, False)])
def test_verdict_is_above_the_threshold(spark, invalid, total, fails):
    rows = [("invalid" if k < invalid else "valid",) for k in range(total)]
    summary = validate.summarize(spark.createDataFrame(rows, "status string")).first()
    assert summary.should_fail_run is fails
    assert summary.failure_rate == (invalid / total if total else 0)


def test_report(spark):
    rows = [("A", "/p/A.json", "valid", []), ("B", "/p/B.json", "invalid", ["e1", "e2"])]
    results = spark.createDataFrame(rows, "symbol string, path string, status string, errors array<string>")
    assert [r.line for r in validate.report_lines(results, ["symbol"]).collect()] == [
        "Validated 2 expected Bronze files: 1 valid, 1 invalid",
        "VALID   A            /p/A.json",
        "INVALID B            /p/B.json",
        "        - e1",
        "        - e2",
        "Validation failure rate: 50.00%",
        "Validation failure threshold: 25.00%",
        "Validation decision: FAIL run",
    ]


def test_files_are_read_by_path_and_no_folder_is_listed(spark, tmp_path):
    folder = tmp_path / "equities" / "source=yahoo" / "date=2026-06-16"
    folder.mkdir(parents=True)
    rows = []
    for name in ("_A", ".B", "C", "D", "E"):
        rows.append(("equity", "yahoo", name, f"{folder}/{name}.json"))
        if name != "E":
            (folder / f"{name}.json").write_bytes(b"" if name == "D" else b"[1]")
    rows.append(("equity", "yahoo", "F", f"{tmp_path}/elsewhere.json"))
    (tmp_path / "elsewhere.json").write_bytes(b"[1]")
    manifest = spark.createDataFrame(
        rows, "asset_class string, source string, symbol string, path string"
    )
    results = validate.validate_files(spark, manifest, [str(folder), f"{tmp_path}/missing"])
    assert not results.inputFiles()
    got = {r.symbol: (r.file_size_bytes, r.errors) for r in results.collect()}
    wrong = (3, ["top-level JSON is not an object"])
    missing = (None, ["file does not exist"])
    assert got == {
        "_A": wrong, ".B": wrong, "C": wrong, "D": (0, ["file is empty"]), "E": missing, "F": missing,
    }


def test_payload_rules_alone_give_the_errors_of_no_record(spark, sf_dir):
    from marketloom.sources import sample

    documents = sample.faulty_documents(sample.customer_prices(spark, sf_dir)).limit(100)
    odd = ["", "[]", "{}", '{"records": {}}', '{"records": []}', '{"records": [1]}', '{"records": [[1]]}']
    rows = [(s, "X", text) for s in ("yahoo", "binance", "other") for text in odd]
    odd_rows = spark.createDataFrame(rows, "source string, symbol string, text string")
    documents = documents.select("source", "symbol", "text").unionByName(odd_rows).localCheckpoint()
    every, own = (
        validate.error_rows(validate.validate_documents(documents, rules), "source", "symbol")
        .filter("error NOT LIKE 'record %'" if rules else "true").select("source", "symbol", "error").collect()
        for rules in (True, False)
    )
    assert sorted(every) == sorted(own) and len(own) > 50
