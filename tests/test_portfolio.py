from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from marketloom.operators import joins, portfolio
from marketloom.sources.tables import weights_table

FACT = (
    "symbol string, date_key date, daily_return double, is_price_observed boolean, "
    "is_price_forward_filled boolean, is_fx_forward_filled boolean"
)


def fact_of(spark, rows):
    return spark.createDataFrame([(*r, True, False, False) if len(r) == 3 else r for r in rows], FACT)


def test_portfolio_follows_its_holdings(spark):
    """Three holdings over eighty days, against the sums written out."""
    held = {"X": 0.55, "Y": 0.3, "Z": 0.15}
    days = [date(2027, 2, 1) + timedelta(k) for k in range(80)]
    moves = {
        s: [((k * (n + 3)) % 11 - 5) / 100 for k in range(80)] for n, s in enumerate(held)
    }
    rows = [(s, day, moves[s][k] if k else None) for s in held for k, day in enumerate(days)]
    daily = portfolio.fact_portfolio_daily(fact_of(spark, rows), weights_table(spark, "p", held))
    summary = portfolio.fact_portfolio_summary_daily(daily, 0.02).orderBy("date_key").collect()
    by_day = {r.date_key: r for r in daily.collect()}
    assert days[0] not in by_day and len(summary) == 79
    value, peak, worst = 1.0, 1.0, 0.0
    for k, day in enumerate(days[1:], 1):
        change = sum(w * moves[s][k] for s, w in held.items())
        value *= 1 + change
        peak = value if k == 1 else max(peak, value)
        worst = min(worst, value / peak - 1)
        assert by_day[day].daily_return == pytest.approx(change, abs=1e-12)
        assert by_day[day].cumulative_return == pytest.approx(value - 1)
        assert summary[k - 1].max_drawdown == pytest.approx(worst, abs=1e-12)
        assert (summary[k - 1].sharpe_ratio is None) == (k < 30)


def test_a_missing_holding_drops_the_day(spark):
    day = date(2026, 1, 2)
    fact = fact_of(spark, [("A", day, 0.1), ("A", day + timedelta(1), 0.1), ("B", day, 0.1)])
    weights = weights_table(spark, "p", {"A": 0.5, "B": 0.5})
    assert [r.date_key for r in portfolio.fact_portfolio_daily(fact, weights).collect()] == [day]


def test_fill_counts(spark):
    day = date(2026, 1, 3)
    fact = fact_of(
        spark, [("C", day, 0.0, False, True, False), ("B", day, 0.1, True, False, True)]
    )
    weights = weights_table(spark, "p", {"C": 0.5, "B": 0.5})
    (row,) = portfolio.fact_portfolio_daily(fact, weights).collect()
    assert row.daily_return == pytest.approx(0.05)
    assert (row.has_forward_filled_price, row.has_forward_filled_fx) == (True, True)
    assert (
        row.observed_asset_count, row.forward_filled_price_count, row.forward_filled_fx_count
    ) == (1, 1, 1)


def daily_of(spark, rows):
    return spark.createDataFrame(
        rows, "portfolio_name string, date_key date, daily_return double, cumulative_return double"
    )


def test_running_metrics_start_again_each_year(spark):
    """Returns that rise by the day, over two year ends."""
    start = date(2027, 12, 20)
    rows, value = [], 1.0
    for k in range(400):
        value *= 1 + k / 1e5
        rows.append(("p", start + timedelta(k), k / 1e5, value - 1))
    summary = portfolio.fact_portfolio_summary_daily(daily_of(spark, rows)).collect()
    assert len(summary) == 400
    for r in summary:
        first = max(0, (date(r.date_key.year, 1, 1) - start).days)
        last = (r.date_key - start).days
        grown = 1.0
        for k in range(first, last + 1):
            grown *= 1 + k / 1e5
        assert r.observation_count == last - first + 1
        assert r.ytd_return == pytest.approx(grown - 1)


def test_annual_figures_need_thirty_days(spark):
    start = date(2028, 3, 1)
    rows = [("p", start + timedelta(k), 0.0004, 1.0004 ** (k + 1) - 1) for k in range(30)]
    summary = portfolio.fact_portfolio_summary_daily(daily_of(spark, rows)).orderBy("date_key")
    *_, before, last = summary.collect()
    assert before.annual_return is None
    assert last.observation_count == 30
    assert last.annual_return == pytest.approx(1.0004**365 - 1)


def test_a_total_loss_is_skipped_by_the_running_sum(spark):
    day = date(2026, 1, 1)
    rows = [("p", day, 0.1), ("p", day + timedelta(1), -1.0), ("p", day + timedelta(2), 0.1)]
    daily = spark.createDataFrame(rows, "portfolio_name string, date_key date, daily_return double")
    got = portfolio.cumulative_return(daily).orderBy("date_key").collect()
    assert [r.cumulative_return for r in got] == pytest.approx([0.1, 0.1, 0.21])


def test_sliced_join_equals_plain_join(spark):
    weights = spark.range(500).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("portfolio_name"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias(
            "symbol"
        ),
        (F.col("id") / 7).alias("target_weight"),
    )
    fact = spark.range(200).select(
        F.when(F.col("id") % 4 == 0, "HOT").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias(
            "symbol"
        ),
        F.col("id").alias("day"),
    )
    columns = ["symbol", "day", "portfolio_name", "target_weight"]
    plain = fact.join(weights, "symbol").select(columns)
    sliced = portfolio.join_weights(fact, weights, broadcast_rows=0, slice_rows=10).select(columns)
    assert plain.count() == sliced.count() > 0
    assert plain.exceptAll(sliced).count() == 0
    small = joins.join_small(weights, fact, "symbol", "portfolio_name", 0, 10).select(columns)
    assert plain.exceptAll(small).count() == 0 and small.count() == plain.count()


def test_weights_meet_prices_before_days(spark, sf_dir, monkeypatch):
    from marketloom import catalog
    from marketloom.sources import sample

    def unlimited(table, rows):
        return False

    inputs = (
        sample.customer_prices(spark, sf_dir),
        sample.shipment_rates(spark, sf_dir),
        catalog._dates(spark, sf_dir),
    )
    held = sample.nation_weights(spark, sf_dir)
    held = held.unionByName(held.withColumn("portfolio_name", F.concat(F.lit("B"), "portfolio_name")))
    fact = catalog._wide_fact(spark, sf_dir)
    expected = portfolio.fact_portfolio_daily(fact, held).orderBy("portfolio_name", "date_key")
    # Too many weights to be broadcast: both sides of the join are shuffled.
    monkeypatch.setattr(portfolio, "has_at_most", unlimited)
    monkeypatch.setattr(catalog.sample, "nation_weights", lambda *_: held)
    got = catalog._wide_portfolio(spark, sf_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    days = plan.index("Generate explode(sequence(price_date")
    # Above the expansion only sums by portfolio and day, and the windows' rows, are shuffled.
    assert "_slice" not in plan[:days] and "_slice" in plan[days:]
    rows = [expected.collect(), got.orderBy("portfolio_name", "date_key").collect()]
    assert len(rows[0]) == len(rows[1]) > 0
    for a, b in zip(*rows, strict=True):
        assert a[:2] == b[:2] and a[-2:] == b[-2:]
        assert a.daily_return == pytest.approx(b.daily_return, abs=1e-12)
