import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.operators import assets, calendar, silver

PRICE = "symbol string, asset_class string, source string, price_date date, close_price double, currency string"
RATE = "symbol string, source string, rate_date date, rate double"


def d(day, month=1, year=2026):
    return date(year, month, day)


def prices_of(spark, rows):
    full = [(s, "crypto" if c == "USDT" else "equity", "x", day, p, c) for s, day, p, c in rows]
    return spark.createDataFrame(full, PRICE)


def rates_of(spark, rows):
    return spark.createDataFrame([("AUDUSD=X", "yahoo", day, r) for day, r in rows], RATE)


def by_key(fact):
    return {(r.symbol, r.date_key): r for r in fact.collect()}


def windowed_fact(prices, rates, dates):
    """The asset fact by window functions over every calendar row."""
    running = Window.orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)
    fx = (
        dates.select("date_key")
        .join(rates.select(F.col("rate_date").alias("date_key"), "rate"), "date_key", "left")
        .withColumn("aud_usd_rate", F.last("rate", True).over(running))
        .select("date_key", "aud_usd_rate")
    )
    filled = calendar.fill_prices_windowed(prices, dates).join(fx, "date_key", "left")
    kept = assets.convert_to_aud(filled).filter("close_price_aud > 0")
    previous = F.lag("close_price_aud").over(Window.partitionBy("symbol").orderBy("date_key"))
    return kept.select(
        "symbol", "date_key", "close_price_aud",
        (F.col("close_price_aud") / previous - 1).alias("daily_return"),
    )


def test_calendar_spans_price_dates(spark):
    prices = prices_of(spark, [("A", d(2), 1.0, "AUD"), ("A", d(5), 1.0, "AUD")])
    rows = calendar.dim_date(prices).orderBy("date_key").collect()
    assert [r.date_key for r in rows] == [d(2), d(3), d(4), d(5)]
    assert [r.is_weekend for r in rows] == [False, True, True, False]
    assert (rows[1].day_name, rows[1].day_of_week, rows[1].month_name) == ("Saturday", 7, "January")


def test_calendar_of_no_prices_is_empty(spark):
    assert calendar.dim_date(prices_of(spark, [])).count() == 0


def test_conversion_by_currency(spark):
    """A quarter of a year of one price: only the rate and the currency tell rows apart."""
    days = [d(1, 3) + timedelta(k) for k in range(90)]
    rows = [(c, day, 12.0, c) for c in ("AUD", "USDT", "NZD") for day in days]
    rates = rates_of(spark, [(day, 0.5 + k / 180) for k, day in enumerate(days)])
    prices = prices_of(spark, rows)
    got = by_key(assets.fact_asset_daily(prices, rates, calendar.dim_date(prices)))
    assert {s for s, _ in got} == {"AUD", "USDT"}
    for k, day in enumerate(days):
        assert got["AUD", day].close_price_aud == 12.0
        assert got["USDT", day].close_price_aud == pytest.approx(12 / (0.5 + k / 180))
        if k:
            falls = (0.5 + (k - 1) / 180) / (0.5 + k / 180) - 1
            assert got["USDT", day].daily_return == pytest.approx(falls)


def test_fills_tell_where_values_come_from(spark):
    """Prices every seventh day, rates every fifth: each row names both sources."""
    days = [d(1, 4) + timedelta(k) for k in range(36)]
    prices = prices_of(
        spark,
        [("N", day, 2.0 + k, "AUD") for k, day in enumerate(days) if k % 7 == 0]
        + [("T", day, 3.0 + k, "USDT") for k, day in enumerate(days) if k % 7 == 0],
    )
    rates = rates_of(spark, [(day, 1 / (4 + k)) for k, day in enumerate(days) if k % 5 == 0])
    got = by_key(assets.fact_asset_daily(prices, rates, calendar.dim_date(prices)))
    assert len(got) == 72
    for k, day in enumerate(days):
        week, five = k - k % 7, k - k % 5
        own, usdt = got["N", day], got["T", day]
        assert own.close_price_aud == 2.0 + week
        assert usdt.close_price_aud == pytest.approx((3.0 + week) * (4 + five))
        for row in (own, usdt):
            assert row.source_price_date == days[week]
            assert row.is_price_observed is (k % 7 == 0)
            assert row.is_price_forward_filled is (k % 7 != 0)
        assert (own.is_fx_observed, own.is_fx_forward_filled, own.source_fx_date) == (False, False, None)
        assert usdt.source_fx_date == days[five]
        assert (usdt.is_fx_observed, usdt.is_fx_forward_filled) == (k % 5 == 0, k % 5 != 0)


def test_pairs_are_filled_and_used_apart(spark):
    rows = [
        ("EUR", "USD", d(1), 1.1), ("AUD", "USD", d(1), 0.5), ("AUD", "NZD", d(2), 1.3),
        ("EUR", "USD", d(3), 1.2),
    ]
    table = spark.createDataFrame(
        rows, "base_currency string, quote_currency string, rate_date date, rate double"
    )
    prices = prices_of(spark, [("B", d(1), 60.0, "USDT"), ("B", d(3), 60.0, "USDT")])
    dates = calendar.dim_date(prices)
    filled = calendar.fill_pairs(table, dates).collect()
    got = {(r.base_currency + r.quote_currency, r.date_key.day): r.rate for r in filled}
    assert got == {
        ("EURUSD", 1): 1.1, ("EURUSD", 2): 1.1, ("EURUSD", 3): 1.2,
        ("AUDUSD", 1): 0.5, ("AUDUSD", 2): 0.5, ("AUDUSD", 3): 0.5,
        ("AUDNZD", 2): 1.3, ("AUDNZD", 3): 1.3,
    }
    fact = by_key(assets.fact_asset_daily(prices, table, dates))
    assert {r.close_price_aud for r in fact.values()} == {120.0}


def test_rates_before_the_first_price_are_not_carried_in(spark):
    prices = prices_of(spark, [("B", d(2), 50.0, "USDT"), ("B", d(4), 50.0, "USDT")])
    rates = rates_of(spark, [(d(1), 0.4), (d(3), 0.5)])
    rows = by_key(assets.fact_asset_daily(prices, rates, calendar.dim_date(prices)))
    assert set(rows) == {("B", d(3)), ("B", d(4))}
    assert rows["B", d(3)].daily_return is None
    assert rows["B", d(4)].daily_return == 0.0
    fx = calendar.fx_calendar(rates, calendar.dim_date(prices)).orderBy("date_key").collect()
    assert [r.aud_usd_rate for r in fx] == [None, 0.5, 0.5]
    assert [r.is_fx_forward_filled for r in fx] == [False, False, True]


def test_latest_run_wins_where_a_day_is_held_twice(spark):
    rows = [("A", d(1), 1.0, d(10)), ("A", d(1), 2.0, d(11)), ("A", d(2), 9.0, d(10))]
    table = spark.createDataFrame(
        rows, "symbol string, price_date date, close_price double, ingestion_run_date date"
    )
    kept = silver.one_per_day(table, "symbol", "price_date", "close_price")
    assert sorted((r.price_date, r.close_price) for r in kept.collect()) == [(d(1), 2.0), (d(2), 9.0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interval_expansion_equals_windows(spark, seed):
    """Random gaps, zero prices, and rates that start late."""
    rng = random.Random(seed)
    start = d(20, 12, 2025)
    rows, rates = [], []
    for n in range(12):
        currency = rng.choice(["AUD", "USDT", "USDT", "EUR"])
        for k in range(40):
            if rng.random() < 0.4:
                price = rng.choice([0.0, rng.uniform(1, 9), rng.uniform(1, 9)])
                rows.append((f"S{n}", start + timedelta(k), price, currency))
    for k in range(rng.randrange(8), 45):
        if rng.random() < 0.5:
            rates.append((start + timedelta(k), rng.uniform(0.5, 0.8)))
    prices, fx = prices_of(spark, rows), rates_of(spark, rates)
    dates = calendar.dim_date(prices)
    a, b = calendar.fill_prices(prices, dates), calendar.fill_prices_windowed(prices, dates)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    expected = by_key(windowed_fact(prices, fx, dates))
    for keyed in (True, False):
        got = by_key(assets.fact_asset_daily(prices, fx, dates, keyed=keyed))
        assert set(got) == set(expected)
        for key, row in expected.items():
            assert got[key].close_price_aud == pytest.approx(row.close_price_aud)
            if row.daily_return is None:
                assert got[key].daily_return is None
            else:
                assert got[key].daily_return == pytest.approx(row.daily_return, abs=1e-12)


def test_return_runs_are_the_returns_of_the_fact(spark, sf_dir):
    from pyspark.sql import functions as F

    from marketloom.operators import moments
    from marketloom.sources import sample

    late = F.col("rate_date") >= "1996-05-01"
    rates = sample.shipment_rates(spark, sf_dir).filter(late)
    day = F.dayofmonth("price_date")
    # Prices of zero, a currency without a rule, and days before the first rate.
    prices = sample.customer_prices(spark, sf_dir).withColumns({
        "close_price": F.when(day == 9, 0.0).otherwise(F.col("close_price")),
        "currency": F.when(F.col("symbol") == "C7", "EUR").otherwise(F.col("currency")),
        "list": F.substring("symbol", 2, 20).cast("long") % 9,
    })
    dates = calendar.dim_date(prices)
    fact = assets.fact_asset_daily(prices, rates, dates, keyed=True)
    runs = assets.return_runs(prices, rates, dates, ["list"])
    each = runs.select("symbol", "date_key", F.posexplode("daily_returns").alias("n", "r"))
    got = each.select("symbol", F.expr("date_add(date_key, n)").alias("date_key"), "r").dropna()
    both = fact.select("symbol", "date_key", "daily_return").dropna().join(
        got, ["symbol", "date_key"], "full"
    )
    apart = F.abs(F.col("daily_return") - F.col("r"))
    assert both.count() > 10_000
    assert both.filter(~F.coalesce(apart < 1e-12, F.lit(False))).count() == 0

    key = F.substring("symbol", 2, 20).cast("long") % 9
    old = moments.grouped(fact.withColumn("list", key), ["list"]).orderBy("list").collect()
    found = moments.grouped(runs, ["list"])
    # Days are not expanded into rows, and lists are brought together once.
    plan = found._jdf.queryExecution().executedPlan().toString().split("Subquery subquery")[0]
    assert "Generate" not in plan
    new = found.orderBy("list").collect()
    assert len(old) == len(new) == 9
    for a, b in zip(old, new, strict=True):
        assert (a.symbols, a.observation_count) == (b.symbols, b.observation_count)
        if a.annual_returns is not None:
            assert a.annual_returns == pytest.approx(b.annual_returns, abs=1e-9)
            for x, y in zip(a.annual_covariances, b.annual_covariances, strict=True):
                assert x == pytest.approx(y, abs=1e-9)
