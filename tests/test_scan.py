"""Running values in blocks against plain loops, and tables by year."""

import glob
import random
import statistics

import pytest
from pyspark.sql import functions as F

from marketloom import catalog
from marketloom.operators import portfolio, scan
from marketloom.sources.tables import read_table, write_by_year

ROWS = "k string, t int, v double, n int, place int, row string, at int"
KINDS = ["count", "sum", "max", "min", "last", "moments"]


def _measures():
    return {kind: (kind, F.col("v")) for kind in KINDS}


def _history(rng, n):
    keys = ["hot"] * 6 + ["a", "b", None]
    times = rng.sample(range(10 * n), n)
    values = [None if rng.random() < 0.2 else rng.uniform(-5, 5) + 1e6 for _ in range(n)]
    return [(rng.choice(keys), t, v, t, 1, "x", 2) for t, v in zip(times, values, strict=True)]


def _loop(rows):
    seen, out = {}, {}
    for k, t, v, *_ in sorted(rows, key=lambda r: r[1]):
        own = seen.setdefault(k, [])
        own += [] if v is None else [v]
        out[t] = (
            len(own), sum(own) if own else None, max(own, default=None), min(own, default=None),
            own[-1] if own else None, statistics.fmean(own) if own else None,
            statistics.stdev(own) if len(own) > 1 else None,
        )
    return out


@pytest.mark.parametrize("width", [1, 7, 100, 10**6])
def test_scan_equals_loop(spark, width):
    rows = _history(random.Random(width), 300)
    frame = spark.createDataFrame(rows, ROWS)
    got = scan.blocked_scan(frame, ["k"], ["t"], F.floor(F.col("t") / width), _measures())
    assert got.columns == [*frame.columns, *KINDS]
    got = got.withColumn("mean", F.col("moments.mean"))
    got = got.withColumn("deviation", scan.deviation(F.col("moments")))
    names = ["count", "sum", "max", "min", "last", "mean", "deviation"]
    found = {r.t: tuple(r[c] for c in names) for r in got.collect()}
    wanted = _loop(rows)
    assert found.keys() == wanted.keys()
    for t, values in wanted.items():
        for have, want in zip(found[t], values, strict=True):
            assert have == want if want is None else have == pytest.approx(want, rel=1e-9)


def test_equal_values_do_not_spread(spark):
    values = [0.1] * 40 + [0.3, 0.0]
    rows = spark.createDataFrame([("a", t, v) for t, v in enumerate(values)], "k string, t int, v double")
    moments = {"m": ("moments", F.col("v"))}
    got = scan.blocked_scan(rows, ["k"], ["t"], F.floor(F.col("t") / 3), moments)
    spread = [r.d for r in got.select("t", scan.deviation(F.col("m")).alias("d")).orderBy("t").collect()]
    assert spread[:40] == [None] + [0.0] * 39
    assert spread[40:] == [pytest.approx(statistics.stdev(values[:n])) for n in (41, 42)]


def test_scan_of_nothing_and_without_scope(spark):
    empty = spark.createDataFrame([], ROWS)
    assert scan.blocked_scan(empty, ["k"], ["t"], F.col("t"), _measures()).collect() == []
    rows = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], "k string, t int, v double")
    got = scan.blocked_scan(rows, [], ["t"], F.col("t"), {"s": ("sum", F.col("v"))})
    assert [r.s for r in got.orderBy("t").collect()] == [1.0, 3.0]


def test_one_key_of_a_million_rows(spark, tmp_path):
    spark.range(1_000_000).select(F.lit("p").alias("k"), "id").write.parquet(str(tmp_path / "r"))
    rows = spark.read.parquet(str(tmp_path / "r"))
    measures = {"s": ("sum", F.col("id")), "m": ("max", -F.col("id")), "n": ("count", F.col("id"))}
    got = scan.blocked_scan(rows, ["k"], ["id"], F.floor(F.col("id") / 4096), measures)
    right = (F.col("s") == F.col("id") * (F.col("id") + 1) / 2) & (F.col("m") == 0)
    assert got.filter(right & (F.col("n") == F.col("id") + 1)).count() == 1_000_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Rows are windowed by key and block, and only the blocks' totals by key alone.
    shuffled = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    by_key = [x for x in shuffled if "(place" not in x]
    assert len(by_key) == 1 and len(shuffled) <= 4
    assert "SinglePartition" not in plan and "Python" not in plan


def test_as_of_equals_loop(spark):
    rng = random.Random(3)
    left = [(rng.choice(["hot", "hot", "a", None]), rng.randrange(200), i) for i in range(400)]
    left += [("hot", None, 400), ("none", 5, 401)]
    right = [(rng.choice(["hot", "a", None]), rng.randrange(200), rng.random()) for _ in range(90)]
    right += [("hot", None, 9.0)]
    asked = spark.createDataFrame(left, "k string, t int, given int")
    series = spark.createDataFrame(right, "k string, t int, rate double")
    got = scan.as_of(asked, series, ["k"], "t", ["rate"], lambda t: F.floor(t / 16))
    assert got.columns == ["k", "t", "given", "rate"]
    found = {r.given: r.rate for r in got.collect()}
    for k, t, i in left:
        known = [] if k is None or t is None else [
            r[1:] for r in right if r[0] == k and r[1] is not None and r[1] <= t
        ]
        assert found.pop(i) == (max(known)[1] if known else None)
    assert not found


def test_blocked_summary_equals_windows(spark, sf_dir, tmp_path):
    catalog._portfolio(spark, sf_dir).write.parquet(str(tmp_path / "daily"))
    daily = spark.read.parquet(str(tmp_path / "daily"))
    names = ["observation_count", "ytd_return", "max_drawdown", "sharpe_ratio"]
    one, two = (
        summary.select("date_key", *[F.round(c, 9) for c in names]).orderBy("date_key").collect()
        for summary in (
            portfolio.fact_portfolio_summary_daily(daily), portfolio.blocked_summary(daily)
        )
    )
    assert len(one) > 0 and one == two


def test_a_year_is_rewritten_and_read_alone(spark, tmp_path):
    root = str(tmp_path)
    days = spark.sql(
        "SELECT explode(sequence(DATE'2020-11-01', DATE'2023-02-01')) AS date_key, 1 AS v"
    )
    assert write_by_year(days, root, "t") == days.count()
    assert read_table(spark, root, "t").columns == ["date_key", "v"]

    def files(year):
        return set(glob.glob(f"{root}/t/table_year={year}/*.parquet"))

    before = {year: files(year) for year in range(2020, 2024)}
    assert all(before.values())
    again = days.filter("year(date_key) = 2021 AND month(date_key) < 3").withColumn("v", F.lit(2))
    write_by_year(again, root, "t", only_held=True)
    after = {year: files(year) for year in range(2020, 2024)}
    assert [y for y in before if before[y] != after[y]] == [2021]
    part = read_table(spark, root, "t", ("2021-02-01", "2022-01-31"))
    assert part.groupBy("v").count().orderBy("v").collect() == [(1, 31), (2, 28)]
    scanned = part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]
    assert "table_year" in scanned.split("]")[0]
    assert set(part.inputFiles()) >= {f"file://{f}" for f in after[2021]}
