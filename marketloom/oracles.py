"""The catalog's queries as SQL over the same tables, written independently of it.

Calendar fill is a cross product with a window here, and returns are a window
over the filled rows, where the operators expand intervals.
"""

from __future__ import annotations

from marketloom import config
from marketloom.sources.sample import PRIORITY_WEIGHTS, RUN_DATE, SYMBOLS

ORACLES: dict[str, str] = {}

PRICE_COLUMNS = (
    "symbol, asset_class, source, price_date, open_price, high_price, low_price, close_price, "
    "volume, currency, ingestion_run_date"
)


def _rounded(sql: str, *columns: str, digits: int = 6) -> str:
    replaced = ", ".join(f'round("{c}", {digits}) + 0.0 AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


def _prices(symbol: str, crypto: str) -> str:
    return f"""
    SELECT {symbol} AS symbol,
           CASE WHEN {crypto} THEN 'crypto' ELSE 'equity' END AS asset_class,
           CASE WHEN {crypto} THEN 'binance' ELSE 'yahoo' END AS source,
           CAST(o_orderdate AS DATE) AS price_date,
           10000 + min(o_totalprice) / 1000 AS open_price,
           10000 + max(o_totalprice) / 1000 AS high_price,
           10000 + min(o_totalprice) / 1000 AS low_price,
           10000 + max(o_totalprice) / 1000 AS close_price,
           CAST(count(*) AS DOUBLE) AS volume,
           CASE WHEN {crypto} THEN 'USDT' ELSE 'AUD' END AS currency,
           DATE '{RUN_DATE}' AS ingestion_run_date
    FROM orders GROUP BY 1, 2, 3, 4, 10"""


NARROW = _prices("o_orderpriority", "o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')")
WIDE = _prices("'C' || o_custkey", "right(CAST(o_custkey AS VARCHAR), 1) IN ('8', '9')")

RATES = f"""
    SELECT 'AUDUSD=X' AS symbol, 'yahoo' AS source, CAST(l_shipdate AS DATE) AS rate_date,
           'AUD' AS base_currency, 'USD' AS quote_currency,
           CAST(0.6 AS DOUBLE) + min(l_tax) AS rate, DATE '{RUN_DATE}' AS ingestion_run_date
    FROM lineitem WHERE isodow(l_shipdate) <= 5 GROUP BY CAST(l_shipdate AS DATE)"""

EVERY_RATE = RATES.replace("WHERE isodow(l_shipdate) <= 5 ", "")

MODE_RATES = f"""
    SELECT quote_currency, rate_date, rate FROM ({RATES})
    UNION ALL
    SELECT l_returnflag, CAST(l_shipdate AS DATE), CAST(2.0 AS DOUBLE) + max(l_tax)
    FROM lineitem GROUP BY 1, 2"""

DAYS = """
    SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)),
           max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date_key FROM orders"""

FX = """
    SELECT date_key,
           last_value(rate IGNORE NULLS) OVER w AS aud_usd_rate,
           last_value(rate_date IGNORE NULLS) OVER w AS source_fx_date,
           rate_date IS NOT NULL AS is_fx_observed,
           rate_date IS NULL AND last_value(rate_date IGNORE NULLS) OVER w IS NOT NULL
               AS is_fx_forward_filled
    FROM days LEFT JOIN rates ON rate_date = date_key
    WINDOW w AS (ORDER BY date_key ROWS UNBOUNDED PRECEDING)"""

FILLED = """
    SELECT * FROM (
        SELECT c.symbol, c.currency, c.date_key,
               last_value(p.close_price IGNORE NULLS) OVER w AS close_price_native,
               last_value(p.price_date IGNORE NULLS) OVER w AS source_price_date,
               p.price_date IS NOT NULL AS is_price_observed,
               p.price_date IS NULL AS is_price_forward_filled
        FROM (SELECT * FROM (SELECT DISTINCT symbol, currency FROM prices), days) c
        LEFT JOIN prices p ON p.symbol = c.symbol AND p.price_date = c.date_key
        WINDOW w AS (PARTITION BY c.symbol ORDER BY c.date_key ROWS UNBOUNDED PRECEDING))
    WHERE source_price_date IS NOT NULL"""

CONVERTED = """
    SELECT f.*,
           CASE currency WHEN 'AUD' THEN close_price_native
                WHEN 'USDT' THEN close_price_native / aud_usd_rate END AS close_price_aud,
           currency = 'USDT' AND is_fx_observed AS usdt_observed,
           currency = 'USDT' AND is_fx_forward_filled AS usdt_filled,
           CASE WHEN currency = 'USDT' THEN source_fx_date END AS usdt_date
    FROM filled f JOIN fx USING (date_key)"""

FACT = """
    SELECT symbol, date_key, close_price_native, close_price_aud,
           close_price_aud / lag(close_price_aud) OVER (PARTITION BY symbol ORDER BY date_key) - 1
               AS daily_return,
           is_price_observed, is_price_forward_filled,
           usdt_observed AS is_fx_observed, usdt_filled AS is_fx_forward_filled,
           source_price_date, usdt_date AS source_fx_date
    FROM converted WHERE close_price_aud > 0"""

_weight_rows = ", ".join(
    f"('{config.FIXED_PORTFOLIO_NAME}', '{s}', CAST({w} AS DOUBLE))"
    for s, w in PRIORITY_WEIGHTS.items()
)
WEIGHTS = f"SELECT * FROM (VALUES {_weight_rows}) v(portfolio_name, symbol, target_weight)"

NATION_WEIGHTS = """
    SELECT 'NATION-' || c_nationkey AS portfolio_name, 'C' || c_custkey AS symbol,
           1.0 / CAST(count(*) OVER (PARTITION BY c_nationkey) AS DOUBLE) AS target_weight
    FROM customer"""

PORTFOLIO = """
    SELECT portfolio_name, date_key, daily_return,
           exp(sum(CASE WHEN daily_return > -1 THEN ln(1 + daily_return) END) OVER (
               PARTITION BY portfolio_name ORDER BY date_key ROWS UNBOUNDED PRECEDING)) - 1
               AS cumulative_return,
           forward_filled_price_count > 0 AS has_forward_filled_price,
           forward_filled_fx_count > 0 AS has_forward_filled_fx,
           observed_asset_count, forward_filled_price_count, forward_filled_fx_count
    FROM (SELECT portfolio_name, date_key,
                 sum(daily_return * target_weight) AS daily_return,
                 sum(target_weight) AS available_weight,
                 count(*) FILTER (WHERE is_price_observed) AS observed_asset_count,
                 count(*) FILTER (WHERE is_price_forward_filled) AS forward_filled_price_count,
                 count(*) FILTER (WHERE is_fx_forward_filled) AS forward_filled_fx_count
          FROM fact JOIN weights USING (symbol) WHERE daily_return IS NOT NULL
          GROUP BY 1, 2)
    WHERE available_weight >= 0.999999"""

RUNNING = """
    SELECT *, value / peak - 1 AS drawdown,
           min(value / peak - 1) OVER (PARTITION BY portfolio_name, y ORDER BY date_key
               ROWS UNBOUNDED PRECEDING) AS max_drawdown
    FROM (SELECT *, max(value) OVER w AS peak, count(daily_return) OVER w AS n,
                 avg(daily_return) OVER w AS mean, stddev_samp(daily_return) OVER w AS sd,
                 exp(sum(CASE WHEN daily_return > -1 THEN ln(1 + daily_return) END) OVER w) - 1
                     AS ytd
          FROM (SELECT *, cumulative_return + 1 AS value, year(date_key) AS y FROM portfolio)
          WINDOW w AS (PARTITION BY portfolio_name, y ORDER BY date_key
                       ROWS UNBOUNDED PRECEDING))"""

SUMMARY = f"""
    SELECT portfolio_name, date_key, n AS observation_count, ytd AS ytd_return, annual_return,
           annual_volatility, CAST({config.RISK_FREE_RATE} AS DOUBLE) AS risk_free_rate,
           CASE WHEN annual_volatility > 0
                THEN (annual_return - {config.RISK_FREE_RATE}) / annual_volatility END
               AS sharpe_ratio,
           max_drawdown
    FROM (SELECT *, CASE WHEN n >= 30 THEN pow(1 + ytd, 365.0 / n) - 1 END AS annual_return,
                 CASE WHEN n >= 30 THEN sd * sqrt(365) END AS annual_volatility
          FROM running)"""


def _with(*names: str, wide: bool = False) -> str:
    """The named steps as WITH entries, in dependency order."""
    steps = {
        "prices": WIDE if wide else NARROW,
        "rates": RATES,
        "days": DAYS,
        "fx": FX,
        "filled": FILLED,
        "converted": CONVERTED,
        "fact": FACT,
        "weights": NATION_WEIGHTS if wide else WEIGHTS,
        "portfolio": PORTFOLIO,
        "running": RUNNING,
        "summary": SUMMARY,
    }
    return ", ".join(f"{n} AS ({steps[n]})" for n in names)


_FACT_STEPS = ["prices", "rates", "days", "fx", "filled", "converted", "fact"]
_PORTFOLIO_STEPS = [*_FACT_STEPS, "weights", "portfolio"]
_SUMMARY_STEPS = [*_PORTFOLIO_STEPS, "running", "summary"]
FACT_WITH = _with(*_FACT_STEPS)
FACT_WITH_WIDE = _with(*_FACT_STEPS, wide=True)
PORTFOLIO_WITH = _with(*_PORTFOLIO_STEPS)
PORTFOLIO_WITH_WIDE = _with(*_PORTFOLIO_STEPS, wide=True)
SUMMARY_WITH = _with(*_SUMMARY_STEPS)
SUMMARY_WITH_WIDE = _with(*_SUMMARY_STEPS, wide=True)

# Raw documents and Silver

_OHLC = ["open_price", "high_price", "low_price", "close_price", "volume"]

ORACLES["raw_struct_records"] = _rounded(
    f"""SELECT symbol, 'equity' AS asset_class, source, price_date, open_price, high_price,
               low_price, close_price, volume, 'AUD' AS currency, ingestion_run_date
        FROM ({WIDE}) WHERE day(price_date) <> 13""",
    *_OHLC,
)
ORACLES["raw_array_records"] = _rounded(
    f"""SELECT 'U' || user_id || 'USDT' AS symbol, 'crypto' AS asset_class, 'binance' AS source,
               CASE WHEN day(ts) = 9 THEN DATE '1970-01-01'
                    - CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER)
                    ELSE CAST(ts AS DATE) END AS price_date,
               min(value) AS open_price, max(value) AS high_price,
               min(value) AS low_price, max(value) AS close_price,
               CAST(count(*) AS DOUBLE) AS volume, 'USDT' AS currency,
               DATE '{RUN_DATE}' AS ingestion_run_date
        FROM events WHERE day(ts) NOT IN (8, 10, 13, 17)
        GROUP BY user_id, CAST(ts AS DATE), day(ts)""",
    *_OHLC,
)
ORACLES["fx_rates"] = _rounded(
    f"SELECT * FROM ({EVERY_RATE}) WHERE day(rate_date) <> 13", "rate"
)
ORACLES["land_raw"] = _rounded(
    f"""SELECT symbol, source, price_date, close_price, volume FROM ({WIDE})
        WHERE source = 'binance' OR day(price_date) <> 13""",
    "close_price", "volume",
)
ORACLES["land_fx"] = _rounded(f"SELECT * FROM ({RATES}) WHERE day(rate_date) <> 13", "rate")
ORACLES["raw_lineage"] = f"""
    SELECT symbol, count(*) AS record_count, TRUE AS is_in_run_folder
    FROM ({WIDE}) GROUP BY symbol"""

_IS_CRYPTO = "right(CAST(c_custkey AS VARCHAR), 1) IN ('8', '9')"
CUSTOMER_ASSETS = f"""
    SELECT 'C' || c_custkey AS symbol,
           CASE WHEN {_IS_CRYPTO} THEN 'crypto' ELSE 'equity' END AS asset_class,
           CASE WHEN {_IS_CRYPTO} THEN 'binance' ELSE 'yahoo' END AS source,
           CASE WHEN {_IS_CRYPTO} THEN 'USDT' ELSE 'AUD' END AS currency,
           c_name AS description, TRUE AS is_active
    FROM customer"""
ORACLES["assets"] = CUSTOMER_ASSETS
ORACLES["dim_asset"] = f"SELECT DISTINCT * FROM ({CUSTOMER_ASSETS})"
ORACLES["conform_schema"] = _rounded(
    f"SELECT {PRICE_COLUMNS}, '1' AS bronze_file_path FROM ({WIDE})", *_OHLC
)
ORACLES["clean_prices"] = _rounded(
    f"""SELECT * REPLACE (CASE WHEN day(price_date) = 7 THEN 0.0 ELSE low_price END AS low_price)
        FROM ({WIDE}) WHERE day(price_date) NOT IN (3, 13, 29, 31)""",
    *_OHLC,
)
ORACLES["clean_fx"] = _rounded(
    f"SELECT * FROM ({EVERY_RATE}) WHERE day(rate_date) NOT IN (13, 29)", "rate"
)
ORACLES["union_prices"] = _rounded(
    f"SELECT {PRICE_COLUMNS} FROM ({NARROW}) UNION ALL SELECT {PRICE_COLUMNS} FROM ({WIDE})",
    *_OHLC,
)
ORACLES["latest_run_prices"] = _rounded(
    f"""SELECT symbol, price_date,
               ingestion_run_date + CAST(day(price_date) > 15 AS INTEGER) AS ingestion_run_date,
               CASE WHEN day(price_date) > 15 THEN low_price ELSE close_price END AS close_price
        FROM ({WIDE})""",
    "close_price",
)

# Calendar and FX

ORACLES["date_bounds"] = """
    SELECT min(CAST(o_orderdate AS DATE)) AS start_date, max(CAST(o_orderdate AS DATE)) AS end_date
    FROM orders"""
ORACLES["dim_date"] = f"""
    SELECT date_key, CAST(year(date_key) AS BIGINT) AS calendar_year,
           CAST(quarter(date_key) AS BIGINT) AS calendar_quarter,
           CAST(month(date_key) AS BIGINT) AS calendar_month, monthname(date_key) AS month_name,
           CAST(day(date_key) AS BIGINT) AS day_of_month,
           CAST(dayofweek(date_key) + 1 AS BIGINT) AS day_of_week,
           dayname(date_key) AS day_name, dayofweek(date_key) IN (0, 6) AS is_weekend
    FROM ({DAYS})"""
ORACLES["asset_calendar"] = f"""
    WITH {_with("prices", "days")}
    SELECT symbol, asset_class, source, currency, date_key AS price_date
    FROM (SELECT DISTINCT symbol, asset_class, source, currency FROM prices), days"""
ORACLES["asset_calendar_fill"] = _rounded(
    f"WITH {_with('prices', 'days', 'filled')} SELECT * FROM filled", "close_price_native"
)
ORACLES["asset_calendar_fill_wide"] = _rounded(
    f"""WITH {_with('prices', 'days', 'filled', wide=True)}
        SELECT symbol, count(*) AS days,
               count(*) FILTER (WHERE is_price_forward_filled) AS filled_days,
               max(date_key) AS last_day, avg(close_price_native) AS average_price
        FROM filled GROUP BY symbol""",
    "average_price",
)
ORACLES["fx_calendar_fill"] = _rounded(
    f"WITH {_with('rates', 'days', 'fx')} SELECT * FROM fx", "aud_usd_rate"
)
ORACLES["fx_pairs_fill"] = _rounded(
    f"""WITH pairs AS ({MODE_RATES}), days AS ({DAYS}),
        inside AS (SELECT * FROM pairs SEMI JOIN days ON rate_date = date_key),
        grid AS (SELECT quote_currency, date_key
                 FROM (SELECT DISTINCT quote_currency FROM inside), days),
        filled AS (
            SELECT g.quote_currency, g.date_key,
                   last_value(rate IGNORE NULLS) OVER w AS rate,
                   last_value(rate_date IGNORE NULLS) OVER w AS source_fx_date,
                   rate_date IS NOT NULL AS is_fx_observed,
                   rate_date IS NULL AS is_fx_forward_filled
            FROM grid g LEFT JOIN inside i
                 ON i.quote_currency = g.quote_currency AND rate_date = date_key
            WINDOW w AS (PARTITION BY g.quote_currency ORDER BY g.date_key
                         ROWS UNBOUNDED PRECEDING))
        SELECT 'AUD' AS base_currency, * FROM filled WHERE source_fx_date IS NOT NULL""",
    "rate",
)
ORACLES["asof_fx"] = _rounded(
    f"""WITH {_with('rates', 'days', 'fx')}
        SELECT o_orderkey, date_key AS order_date, aud_usd_rate, source_fx_date
        FROM orders JOIN fx ON date_key = CAST(o_orderdate AS DATE)""",
    "aud_usd_rate",
)

# Asset facts

ORACLES["currency_conversion"] = _rounded(
    f"""WITH {_with('prices', 'rates', 'days', 'fx', wide=True)},
        c AS (SELECT symbol, price_date, close_price AS close_price_native,
                     CASE WHEN day(price_date) = 13 THEN 'EUR' ELSE currency END AS currency
              FROM prices)
        SELECT symbol, price_date, currency, close_price_native,
               CASE currency WHEN 'AUD' THEN close_price_native
                    WHEN 'USDT' THEN close_price_native / aud_usd_rate END AS close_price_aud
        FROM c JOIN fx ON date_key = price_date""",
    "close_price_native", "close_price_aud",
)
ORACLES["fact_asset_daily"] = _rounded(
    f"WITH {FACT_WITH} SELECT * FROM fact", "close_price_native", "close_price_aud", "daily_return"
)
ORACLES["fact_asset_pairs"] = ORACLES["fact_asset_daily"]
_HARD = {
    "prices": f"""SELECT * REPLACE (
                      CASE WHEN day(price_date) = 9 THEN 0.0 ELSE close_price END AS close_price,
                      CASE WHEN symbol = '3-MEDIUM' THEN 'EUR' ELSE currency END AS currency)
                  FROM ({NARROW})""",
    "rates": f"SELECT * FROM ({RATES}) WHERE rate_date >= DATE '1996-05-01'",
}
_hard_steps = ", ".join(
    f"{name} AS ({_HARD[name]})" if name in _HARD else _with(name) for name in _FACT_STEPS
)
ORACLES["fact_asset_hard"] = _rounded(
    f"WITH {_hard_steps} SELECT * FROM fact",
    "close_price_native", "close_price_aud", "daily_return",
)
ORACLES["fact_asset_daily_wide"] = _rounded(
    f"""WITH {FACT_WITH_WIDE}
        SELECT symbol, count(*) AS days, count(daily_return) AS returns,
               sum(daily_return) AS total_return, avg(close_price_aud) AS average_price_aud,
               count(*) FILTER (WHERE is_price_forward_filled) AS filled_days,
               count(*) FILTER (WHERE is_fx_forward_filled) AS filled_fx_days
        FROM fact GROUP BY symbol""",
    "total_return", "average_price_aud",
)
ORACLES["daily_returns"] = _rounded(
    f"WITH {FACT_WITH} SELECT symbol, date_key, daily_return FROM fact", "daily_return"
)
ORACLES["fill_flags"] = f"""
    WITH {FACT_WITH}
    SELECT symbol, date_key, is_price_observed, is_price_forward_filled, is_fx_observed,
           is_fx_forward_filled, source_price_date, source_fx_date FROM fact"""

# Portfolios

ORACLES["portfolio_weights"] = _rounded(NATION_WEIGHTS, "target_weight")
ORACLES["dim_portfolio"] = f"""
    SELECT DISTINCT 'NATION-' || c_nationkey AS portfolio_name, 'fixed_weight' AS portfolio_type,
           'Customers of one nation at equal weight.' AS description, TRUE AS is_active
    FROM customer
    UNION ALL SELECT '{config.FIXED_PORTFOLIO_NAME}', 'fixed_weight',
           '{config.FIXED_PORTFOLIO_DESCRIPTION}', TRUE
    UNION ALL SELECT '{config.OPTIMIZED_PORTFOLIO_NAME}', 'optimizer',
           '{config.OPTIMIZED_PORTFOLIO_DESCRIPTION}', TRUE"""
ORACLES["portfolio_weighted"] = _rounded(
    f"""WITH {_with(*_FACT_STEPS, 'weights')}
        SELECT portfolio_name, symbol, date_key, daily_return * target_weight AS weighted_return
        FROM fact JOIN weights USING (symbol) WHERE daily_return IS NOT NULL""",
    "weighted_return",
)
_portfolio_doubles = ("daily_return", "cumulative_return")
ORACLES["portfolio_daily"] = _rounded(
    f"WITH {PORTFOLIO_WITH} SELECT * FROM portfolio", *_portfolio_doubles
)
ORACLES["portfolio_daily_wide"] = _rounded(
    f"WITH {PORTFOLIO_WITH_WIDE} SELECT * FROM portfolio", *_portfolio_doubles
)
ORACLES["cumulative_return"] = _rounded(
    f"WITH {PORTFOLIO_WITH} SELECT portfolio_name, date_key, cumulative_return FROM portfolio",
    "cumulative_return",
)
ORACLES["drawdown"] = _rounded(
    f"""WITH {SUMMARY_WITH}
        SELECT portfolio_name, date_key, value AS portfolio_value, peak AS running_peak_value,
               drawdown, max_drawdown FROM running""",
    "portfolio_value", "running_peak_value", "drawdown", "max_drawdown",
)
ORACLES["ytd_return"] = _rounded(
    f"""WITH {SUMMARY_WITH}
        SELECT portfolio_name, date_key, n AS observation_count, mean AS average_daily_return,
               sd AS daily_volatility, ytd AS ytd_return FROM running""",
    "average_daily_return", "daily_volatility", "ytd_return",
)
_summary_doubles = (
    "ytd_return", "annual_return", "annual_volatility", "risk_free_rate", "sharpe_ratio",
    "max_drawdown",
)
ORACLES["portfolio_summary"] = _rounded(
    f"WITH {SUMMARY_WITH} SELECT * FROM summary", *_summary_doubles
)
ORACLES["portfolio_summary_wide"] = _rounded(
    f"WITH {SUMMARY_WITH_WIDE} SELECT * FROM summary", *_summary_doubles
)
ORACLES["portfolio_summary_blocked"] = ORACLES["portfolio_summary_wide"]
ORACLES["events_running"] = _rounded(
    """SELECT event_id, count(value) OVER w AS value_count, sum(value) OVER w AS value_sum,
              max(value) OVER w AS value_max, min(value) OVER w AS value_min,
              coalesce(last_value(CASE WHEN user_id % 3 = 0 THEN event_id END IGNORE NULLS)
                       OVER w, -1) AS last_marked,
              stddev_samp(value) OVER w AS value_deviation
       FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id
                                ROWS UNBOUNDED PRECEDING)""",
    "value_sum", "value_max", "value_min", "value_deviation",
)
ORACLES["events_as_of"] = _rounded(
    """WITH both_sides AS (
           SELECT event_id, user_id % 2 AS market, ts, 1 AS side, NULL AS rate, NULL AS rate_id
           FROM events
           UNION ALL
           SELECT NULL, user_id % 2, ts, 0, value, event_id FROM events
           WHERE event_type = 'purchase')
       SELECT event_id, market, rate, coalesce(rate_id, -1) AS rate_id FROM (
           SELECT event_id, side, market,
                  last_value(rate IGNORE NULLS) OVER w AS rate,
                  last_value(rate_id IGNORE NULLS) OVER w AS rate_id
           FROM both_sides WINDOW w AS (PARTITION BY market ORDER BY ts, side, rate, rate_id
                                        ROWS UNBOUNDED PRECEDING))
       WHERE side = 1""",
    "rate",
)
ORACLES["fact_year_rewrite"] = _rounded(
    f"""WITH {FACT_WITH}
        SELECT * REPLACE (CASE WHEN year(date_key) = 1996 THEN 2 ELSE 1 END * close_price_aud
                          AS close_price_aud)
        FROM fact WHERE date_key BETWEEN DATE '1995-06-01' AND DATE '1997-06-30'""",
    "close_price_native", "close_price_aud", "daily_return",
)
ORACLES["land_unread"] = """
    SELECT 'C' || o_custkey AS symbol, count(DISTINCT CAST(o_orderdate AS DATE)) AS record_count
    FROM orders WHERE o_custkey % 3 = 0 GROUP BY o_custkey"""
ORACLES["latest_summary"] = _rounded(
    f"""WITH {SUMMARY_WITH_WIDE}
        SELECT * FROM summary ORDER BY date_key DESC, portfolio_name LIMIT 30""",
    *_summary_doubles,
)

# Return matrix, moments and weights

_pivot = ", ".join(
    f"max(daily_return) FILTER (WHERE symbol = '{s}') AS \"{s}\"" for s in SYMBOLS
)
_complete = " AND ".join(f'"{s}" IS NOT NULL' for s in SYMBOLS)
MATRIX = f"""SELECT * FROM (SELECT date_key, {_pivot} FROM fact GROUP BY date_key)
             WHERE {_complete}"""
MATRIX_WITH = f"{FACT_WITH}, matrix AS ({MATRIX})"
ORACLES["return_matrix"] = _rounded(f"WITH {MATRIX_WITH} SELECT * FROM matrix", *SYMBOLS)
ORACLES["return_matrix_range"] = _rounded(
    f"""WITH {MATRIX_WITH} SELECT * FROM matrix
        WHERE date_key BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'""",
    *SYMBOLS,
)
ORACLES["return_matrix_head"] = _rounded(
    f"WITH {MATRIX_WITH} SELECT * FROM matrix ORDER BY date_key LIMIT 10", *SYMBOLS
)
ORACLES["lookback_stats"] = f"""
    WITH {MATRIX_WITH}
    SELECT min(date_key) AS lookback_start_date, max(date_key) AS lookback_end_date,
           count(*) AS observation_count FROM matrix"""
LONG = """SELECT f.symbol, f.date_key, f.daily_return
          FROM fact f JOIN matrix USING (date_key)"""
ORACLES["annual_mean_returns"] = _rounded(
    f"""WITH {MATRIX_WITH}, returns AS ({LONG})
        SELECT symbol, avg(daily_return) * 365 AS annual_return FROM returns GROUP BY symbol""",
    "annual_return",
)
ORACLES["annual_covariance"] = _rounded(
    f"""WITH {MATRIX_WITH}, returns AS ({LONG})
        SELECT a.symbol AS symbol_i, b.symbol AS symbol_j,
               covar_samp(a.daily_return, b.daily_return) * 365 AS annual_covariance
        FROM returns a JOIN returns b USING (date_key) GROUP BY 1, 2""",
    "annual_covariance",
)
ORACLES["rolling_covariance"] = _rounded(
    f"""WITH {MATRIX_WITH}, returns AS ({LONG}), pairs AS (
            SELECT date_key, a.symbol AS symbol_i, b.symbol AS symbol_j,
                   covar_samp(a.daily_return, b.daily_return) OVER w * 365 AS annual_covariance,
                   row_number() OVER (PARTITION BY a.symbol, b.symbol ORDER BY date_key) AS day
            FROM returns a JOIN returns b USING (date_key)
            WHERE a.symbol <= b.symbol
            WINDOW w AS (PARTITION BY a.symbol, b.symbol ORDER BY date_key
                         ROWS BETWEEN 89 PRECEDING AND CURRENT ROW))
        SELECT 'priorities' AS list_name, date_key, symbol_i, symbol_j, annual_covariance
        FROM pairs WHERE day >= 90""",
    "annual_covariance",
)
ORACLES["asset_limits"] = _rounded(
    f"""SELECT symbol, asset_class = 'crypto' AS is_crypto, CAST(0 AS DOUBLE) AS lower_bound,
               CAST(CASE WHEN asset_class = 'crypto' THEN 0.15 ELSE 0.60 END AS DOUBLE)
                   AS upper_bound FROM ({CUSTOMER_ASSETS})""",
    "lower_bound", "upper_bound",
)
ORACLES["feasible_universe"] = _rounded(
    f"""SELECT universe, capacity, capacity + 1e-6 >= 1.0 AS is_feasible
        FROM (SELECT c_custkey // 3 AS universe,
                     CAST(0.60 * count(*) FILTER (WHERE NOT {_IS_CRYPTO})
                     + least(0.25, 0.15 * count(*) FILTER (WHERE {_IS_CRYPTO})) AS DOUBLE)
                         AS capacity
              FROM customer GROUP BY 1)""",
    "capacity",
)
CANDIDATES = """
    SELECT 'C' || o_custkey AS candidate_id, o_orderpriority AS symbol,
           CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_custkey) AS weight
    FROM orders GROUP BY o_custkey, o_orderpriority"""
_CRYPTO = "symbol IN ('4-NOT SPECIFIED', '5-LOW')"
FEASIBLE = f"""
    SELECT *, abs(total_weight - 1) <= 1e-6 AND out_of_bounds = 0
              AND crypto_weight <= 0.25 + 1e-6 AS is_feasible
    FROM (SELECT candidate_id, sum(weight) AS total_weight,
                 coalesce(sum(weight) FILTER (WHERE {_CRYPTO}), 0.0) AS crypto_weight,
                 count(*) FILTER (WHERE weight >
                     CASE WHEN {_CRYPTO} THEN 0.15 ELSE 0.60 END + 1e-6) AS out_of_bounds
          FROM candidates GROUP BY candidate_id)"""
ORACLES["feasible_candidates"] = _rounded(
    f"WITH candidates AS ({CANDIDATES}) {FEASIBLE}", "total_weight", "crypto_weight"
)

_n = len(SYMBOLS)
MOMENTS = "SELECT {} FROM matrix".format(
    ", ".join(
        [f'avg("{s}") * 365 AS m{i}' for i, s in enumerate(SYMBOLS)]
        + [
            f'covar_samp("{SYMBOLS[i]}", "{SYMBOLS[j]}") * 365 AS c{i}{j}'
            for i in range(_n)
            for j in range(_n)
        ]
    )
)
_RETURN = " + ".join(f"w{i} * m{i}" for i in range(_n))
_VARIANCE = " + ".join(f"w{i} * w{j} * c{i}{j}" for i in range(_n) for j in range(_n))


def _score(vectors: str) -> str:
    return f"""
        SELECT *, (annual_return - {config.RISK_FREE_RATE}) / annual_volatility AS sharpe_ratio
        FROM (SELECT v.*, {_RETURN} AS annual_return, sqrt({_VARIANCE}) AS annual_volatility
              FROM ({vectors}) v, moments)"""


_vector_columns = ", ".join(
    f"coalesce(sum(weight) FILTER (WHERE symbol = '{s}'), 0.0) AS w{i}"
    for i, s in enumerate(SYMBOLS)
)
VECTORS = f"SELECT candidate_id, {_vector_columns} FROM candidates GROUP BY candidate_id"
SCORED_WITH = f"""{MATRIX_WITH}, moments AS ({MOMENTS}), candidates AS ({CANDIDATES}),
                  scored AS ({_score(VECTORS)})"""
_score_columns = "candidate_id, annual_return, annual_volatility, sharpe_ratio"
_score_doubles = ("annual_return", "annual_volatility", "sharpe_ratio")
ORACLES["score_candidates"] = _rounded(
    f"WITH {SCORED_WITH} SELECT {_score_columns} FROM scored", *_score_doubles
)
ORACLES["best_portfolio"] = _rounded(
    f"""WITH {SCORED_WITH}, feasible AS ({FEASIBLE})
        SELECT {_score_columns} FROM scored JOIN feasible USING (candidate_id)
        WHERE is_feasible ORDER BY sharpe_ratio DESC, candidate_id LIMIT 1""",
    *_score_doubles,
)
ORACLES["clean_weights"] = _rounded(
    f"""WITH candidates AS ({CANDIDATES}),
        cleaned AS (SELECT candidate_id, symbol,
                           CASE WHEN weight < 0.15 THEN 0 ELSE weight * 3 END AS weight
                    FROM candidates)
        SELECT candidate_id, symbol,
               CASE WHEN sum(weight) OVER w > 0 THEN weight / sum(weight) OVER w
                    ELSE weight END AS weight
        FROM cleaned WINDOW w AS (PARTITION BY candidate_id)""",
    "weight",
)


# How often the first lattice's step is quartered; results are compared to four digits.
_LEVELS = 10


def _search_steps() -> str:
    """The lattice and its finer and finer steps, as a chain of WITH entries."""
    units = 20 * 4**_LEVELS
    crypto_cap = units // 4
    caps = [units * 3 // 5] * 3 + [units * 3 // 20] * 2
    entries = []
    for level, step in enumerate(4**power for power in range(_LEVELS, -1, -1)):
        names = [f"u{i}" for i in range(_n)]
        last = names[-1]
        rest = f"{units} - " + " - ".join(names[:-1])
        limits = " AND ".join(f"{u} BETWEEN 0 AND {cap}" for u, cap in zip(names, caps))
        if level == 0:
            ranges = ", ".join(
                f"(SELECT unnest(range(0, {caps[i] + 1}, {step})) AS u{i})" for i in range(_n - 1)
            )
            near = "TRUE"
        else:
            ranges = f"best{level - 1} b, " + ", ".join(
                f"(SELECT unnest(range(-{4 * step}, {4 * step + 1}, {step})) AS d{i})"
                for i in range(_n - 1)
            )
            near = f"{last} BETWEEN b{last} - {4 * step} AND b{last} + {4 * step}"
        moved = ", ".join(f"b.u{i} + d{i} AS u{i}" for i in range(_n - 1))
        first = ", ".join(names[:-1]) if level == 0 else f"{moved}, b.{last} AS b{last}"
        points = f"""SELECT {", ".join(names)} FROM (
                         SELECT *, {rest} AS {last} FROM (SELECT {first} FROM {ranges}))
                     WHERE {limits} AND u3 + u4 <= {crypto_cap} AND {near}"""
        shares = ", ".join(f"u{i} / {units}.0 AS w{i}" for i in range(_n))
        scored = _score(f"SELECT *, {shares} FROM ({points})")
        entries.append(
            f"""best{level} AS MATERIALIZED (SELECT * FROM ({scored})
                ORDER BY sharpe_ratio DESC, concat_ws('-', {", ".join(names)}) LIMIT 1)"""
        )
    return ", ".join(entries)


SEARCH_WITH = f"{MATRIX_WITH}, moments AS ({MOMENTS}), {_search_steps()}"
_NAME = config.OPTIMIZED_PORTFOLIO_NAME
ORACLES["optimizer_summary"] = _rounded(
    f"""WITH {SEARCH_WITH},
        lookback AS (SELECT min(date_key) AS s, max(date_key) AS e, count(*) AS n FROM matrix)
        SELECT '{_NAME}' AS portfolio_name, e AS as_of_date, s AS lookback_start_date,
               e AS lookback_end_date, n AS observation_count,
               CAST({config.RISK_FREE_RATE} AS DOUBLE) AS risk_free_rate, annual_return,
               annual_volatility, sharpe_ratio,
               '{config.CONSTRAINT_SET_NAME}' AS constraint_set_name, TRUE AS optimization_success
        FROM best{_LEVELS}, lookback""",
    "risk_free_rate", *_score_doubles,
)
ORACLES["optimizer_summary"] = _rounded(ORACLES["optimizer_summary"], *_score_doubles, digits=4)
_chosen = " UNION ALL ".join(
    f"SELECT '{s}' AS symbol, w{i} AS optimized_weight FROM best{_LEVELS}" for i, s in enumerate(SYMBOLS)
)
DIFFERENCES = f"""
    WITH {SEARCH_WITH}, weights AS ({WEIGHTS}), chosen AS ({_chosen})
    SELECT '{_NAME}' AS portfolio_name, (SELECT max(date_key) FROM matrix) AS as_of_date, symbol,
           target_weight AS current_weight, optimized_weight,
           optimized_weight - target_weight AS weight_difference
    FROM chosen JOIN weights USING (symbol)"""
_difference_doubles = ("current_weight", "optimized_weight", "weight_difference")
ORACLES["weight_difference"] = _rounded(DIFFERENCES, *_difference_doubles, digits=4)
ORACLES["top_weight_changes"] = _rounded(
    f"{DIFFERENCES} ORDER BY weight_difference DESC LIMIT 3", *_difference_doubles, digits=4
)


def _certificate(members: int) -> str:
    """What must hold of the best weights: limits and certificate, wherever there are any."""
    return f"""
        WITH {FACT_WITH_WIDE},
        listed AS (
            SELECT CAST(substr(symbol, 2) AS BIGINT) // {members} AS universe, symbol,
                   right(symbol, 1) IN ('8', '9') AS is_crypto, date_key
            FROM fact WHERE daily_return IS NOT NULL),
        sizes AS (
            SELECT universe, count(*) AS symbols,
                   0.60 * count(*) FILTER (WHERE NOT is_crypto)
                   + least(0.25, 0.15 * count(*) FILTER (WHERE is_crypto)) AS capacity
            FROM (SELECT DISTINCT universe, symbol, is_crypto FROM listed) GROUP BY universe),
        listed_days AS (SELECT universe, date_key, count(*) AS n FROM listed GROUP BY ALL),
        complete AS (
            SELECT universe, count(*) FILTER (WHERE n = symbols) AS observation_count
            FROM listed_days JOIN sizes USING (universe) GROUP BY universe)
        SELECT universe, symbols, observation_count,
               capacity + 1e-6 >= 1 AND observation_count > 1 AS within_limits,
               capacity + 1e-6 >= 1 AND observation_count > 1 AS is_optimal
        FROM sizes JOIN complete USING (universe)"""


ORACLES["optimizer_certificate_5"] = _certificate(5)
ORACLES["optimizer_certificate_12"] = _certificate(12)
ORACLES["optimizer_certificate_60"] = _certificate(60)
ORACLES["starting_weights"] = _rounded(
    f"""WITH candidates AS ({CANDIDATES}), checked AS ({FEASIBLE}),
        symbols AS (SELECT DISTINCT symbol FROM candidates)
        SELECT candidate_id, s.symbol,
               CASE WHEN is_feasible THEN coalesce(c.weight, 0.0) END AS weight
        FROM checked CROSS JOIN symbols s LEFT JOIN candidates c USING (candidate_id, symbol)""",
    "weight",
)

# Validation

_DAY_FOLDER = f"date={RUN_DATE}"
ORACLES["expected_files"] = f"""
    SELECT CASE asset_class WHEN 'equity' THEN 1 ELSE 3 END AS group_no,
           row_number() OVER (ORDER BY asset_class <> 'equity', symbol) AS file_no,
           CASE asset_class WHEN 'equity' THEN 'equities' ELSE asset_class END AS asset_class,
           source, symbol,
           'raw/' || CASE asset_class WHEN 'equity' THEN 'equities' ELSE asset_class END
           || '/source=' || source || '/{_DAY_FOLDER}/' || symbol || '.json' AS path
    FROM ({CUSTOMER_ASSETS})"""

# Landed documents: volumes and rates of every 13th are negative in struct records.
ORACLES["land_validate"] = f"""
    WITH documents AS (
        SELECT symbol, source, price_date, row_number() OVER w - 1 AS pos
        FROM ({WIDE}) WINDOW w AS (PARTITION BY symbol ORDER BY price_date)),
    rates AS (
        SELECT rate_date, row_number() OVER (ORDER BY rate_date) - 1 AS pos FROM ({RATES})),
    faults AS (
        SELECT symbol, pos, 'record ' || pos || ' field Volume is negative' AS error
        FROM documents WHERE source = 'yahoo' AND day(price_date) = 13
        UNION ALL
        SELECT 'AUDUSD=X', pos, 'record ' || pos || ' field Close is negative'
        FROM rates WHERE day(rate_date) = 13
        UNION ALL
        SELECT symbol, -1, 'file does not exist' FROM ({CUSTOMER_ASSETS})
        WHERE symbol NOT IN (SELECT symbol FROM documents)),
    counted AS (
        SELECT symbol, count(*) AS n, arg_min(error, pos) AS first_error
        FROM faults GROUP BY symbol),
    expected AS (
        SELECT symbol, CASE asset_class WHEN 'equity' THEN 'equities' ELSE asset_class END
               AS asset_class FROM ({CUSTOMER_ASSETS})
        UNION ALL SELECT 'AUDUSD=X', 'fx')
    SELECT symbol, asset_class, CASE WHEN n IS NULL THEN 'valid' ELSE 'invalid' END AS status,
           coalesce(n, 0) AS error_count, first_error
    FROM expected LEFT JOIN counted USING (symbol)"""

# Every record of the faulty documents with its position and the rule inputs.
RECORDS = f"""
    SELECT *, day(price_date) AS d, right(symbol, 1) AS last,
           row_number() OVER (PARTITION BY symbol ORDER BY price_date, copy) - 1 AS pos
    FROM (SELECT symbol, source, price_date, unnest(CASE WHEN day(price_date) = 5
                 THEN [1, 2] ELSE [1] END) AS copy FROM ({WIDE}))"""


def _record_error(condition: str, text: str) -> str:
    return f"SELECT symbol, 'record ' || pos || ' {text}' AS error FROM records WHERE {condition}"


_NUMERIC = [
    _record_error("d = 2", "field Low is not numeric"),
    _record_error("d = 7", "field High is not numeric"),
    _record_error("d = 13", "field Volume is negative"),
]
_DUPLICATES = [
    "SELECT symbol, 'record ' || pos || ' has duplicate date ' || price_date AS error "
    "FROM records WHERE copy = 2"
]
# Only a date that could be read is compared with the document's bounds.
_RANGES = [
    _record_error(
        "d NOT IN (11, 31) AND last <> '4' AND price_date < DATE '1996-01-01'",
        "date is before start_date",
    ),
    _record_error(
        "d NOT IN (11, 31) AND last <> '6' AND price_date > DATE '2001-01-01'",
        "date is after end_date",
    ),
]
_OTHER = [
    _record_error("d = 11", "is not an object"),
    _record_error("d = 29", "missing field Close"),
    _record_error("d = 31", "field Date is not a valid date"),
]
_PAYLOAD = [
    """SELECT DISTINCT symbol, 'source mismatch: expected yahoo, got binance' AS error
       FROM records WHERE source = 'binance'""",
    """SELECT DISTINCT symbol, 'symbol mismatch: expected ' || symbol || ', got ' || lower(symbol)
       FROM records WHERE last = '5'""",
    """SELECT DISTINCT symbol, 'top-level field start_date is not a valid date'
       FROM records WHERE last = '4'""",
    "SELECT DISTINCT symbol, 'missing top-level field interval' FROM records WHERE last = '7'",
]


def _errors(*groups: list[str]) -> str:
    return " UNION ALL ".join(sql for group in groups for sql in group)


RECORDS_WITH = f"WITH records AS ({RECORDS})"
_RECORD_GROUPS = (_NUMERIC, _DUPLICATES, _RANGES, _OTHER)
ORACLES["validate_payload"] = f"{RECORDS_WITH} {_errors(_PAYLOAD)}"
ORACLES["validate_struct_records"] = f"{RECORDS_WITH} {_errors(*_RECORD_GROUPS)}"
ORACLES["validate_numeric"] = f"{RECORDS_WITH} {_errors(_NUMERIC)}"
ORACLES["validate_duplicates"] = f"{RECORDS_WITH} {_errors(_DUPLICATES)}"
ORACLES["validate_date_range"] = f"{RECORDS_WITH} {_errors(_RANGES)}"

KLINES = """
    SELECT *, day(price_date) AS d,
           row_number() OVER (PARTITION BY symbol ORDER BY price_date, copy) - 1 AS pos
    FROM (SELECT 'U' || user_id || 'USDT' AS symbol, price_date,
                 unnest(CASE WHEN day(price_date) = 5 THEN [1, 2] ELSE [1] END) AS copy
          FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS price_date FROM events))"""
_KLINE_RULES = [
    ("d = 19", "is not a list"),
    ("d = 3", "has fewer than 12 fields"),
    ("d = 17", "field open_time is not an integer"),
    ("d = 9", "field open_time is negative"),
    ("d = 13", "field volume is negative"),
    ("d = 23", "field number_of_trades is not an integer"),
    ("d IN (7, 8, 10)", "close_time must be greater than open_time"),
    ("copy = 2", "has duplicate open_time '"
     " || datediff('day', DATE '1970-01-01', price_date) * 86400000 || '"),
    ("d IN (8, 10)", "field open_time is out of range"),
    ("d NOT IN (3, 8, 9, 10, 17, 19) AND price_date < DATE '2024-01-04'",
     "date is before start_date"),
    ("d NOT IN (3, 8, 9, 10, 17, 19) AND price_date > DATE '2024-01-25'",
     "date is after end_date"),
]
_kline_errors = " UNION ALL ".join(
    f"SELECT symbol, pos, {rule} AS rule, 'record ' || pos || ' {text}' AS error "
    f"FROM klines WHERE {condition}"
    for rule, (condition, text) in enumerate(_KLINE_RULES)
)
ORACLES["validate_array_records"] = f"""
    WITH klines AS ({KLINES}), errors AS ({_kline_errors})
    SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY pos, rule) - 1 AS error_no,
           error FROM errors"""

# A document's errors in order: the payload's first, then by record and rule.
_ORDERED = [
    """SELECT DISTINCT symbol, -1 AS pos, 0 AS rule, 'missing top-level field interval' AS error
       FROM records WHERE last = '7'""",
    """SELECT DISTINCT symbol, -1, 1, 'source mismatch: expected yahoo, got binance'
       FROM records WHERE source = 'binance'""",
    """SELECT DISTINCT symbol, -1, 2,
              'symbol mismatch: expected ' || symbol || ', got ' || lower(symbol)
       FROM records WHERE last = '5'""",
    """SELECT DISTINCT symbol, -1, 3, 'top-level field start_date is not a valid date'
       FROM records WHERE last = '4'""",
] + [
    f"SELECT symbol, pos, {rule}, 'record ' || pos || ' {text}' FROM records WHERE {condition}"
    for rule, (condition, text) in enumerate(
        [
            ("d = 11", "is not an object"),
            ("d = 31", "field Date is not a valid date"),
            ("copy = 2", "has duplicate date ' || price_date || '"),
            ("d NOT IN (11, 31) AND last <> '4' AND price_date < DATE '1996-01-01'",
             "date is before start_date"),
            ("d NOT IN (11, 31) AND last <> '6' AND price_date > DATE '2001-01-01'",
             "date is after end_date"),
            ("d = 7", "field High is not numeric"),
            ("d = 2", "field Low is not numeric"),
            ("d = 29", "missing field Close"),
            ("d = 13", "field Volume is negative"),
        ]
    )
]
_FILE_PATH = f"'raw/equities/source=yahoo/{_DAY_FOLDER}/C' || c_custkey || '.json'"
FILES_WITH = f"""
    WITH records AS ({RECORDS}), errors AS ({" UNION ALL ".join(_ORDERED)}),
    documents AS (SELECT DISTINCT symbol FROM records),
    files AS (
        SELECT 'C' || c_custkey AS symbol, {_FILE_PATH} AS path,
               d.symbol IS NULL AS is_missing,
               CASE WHEN d.symbol IS NULL THEN 1 ELSE coalesce(n, 0) END AS error_count,
               CASE WHEN d.symbol IS NULL THEN 'file does not exist' ELSE first_error END
                   AS first_error
        FROM customer LEFT JOIN documents d ON d.symbol = 'C' || c_custkey
        LEFT JOIN (SELECT symbol, count(*) AS n, arg_min(error, (pos, rule)) AS first_error
                   FROM errors GROUP BY symbol) e ON e.symbol = 'C' || c_custkey),
    results AS (SELECT *, CASE WHEN error_count = 0 THEN 'valid' ELSE 'invalid' END AS status
                FROM files)"""
ORACLES["validate_files"] = (
    f"{FILES_WITH} SELECT symbol, path, status, error_count, first_error FROM results"
)
ORACLES["validate_landed_files"] = """
    WITH priced AS (SELECT DISTINCT o_custkey FROM orders WHERE day(o_orderdate) <> 13),
    files AS (
        SELECT 'C' || c_custkey AS symbol, c_custkey % 12 AS fault,
               o_custkey IS NOT NULL AND c_custkey % 12 <> 1 AS landed
        FROM customer LEFT JOIN priced ON o_custkey = c_custkey),
    texts AS (
        SELECT *, CASE WHEN fault = 9 THEN ['file extension is not .json'] ELSE [] END
                  || CASE WHEN NOT landed THEN ['file does not exist']
                          WHEN fault = 2 THEN ['file is empty']
                          WHEN fault = 3 THEN ['path is not a file']
                          WHEN fault IN (4, 6) THEN ['file is not valid JSON']
                          WHEN fault = 5 THEN ['top-level JSON is not an object']
                          WHEN fault = 7 THEN ['records is not a list']
                          WHEN fault = 8 THEN ['records is empty'] ELSE [] END AS errors
        FROM files)
    SELECT symbol, CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'invalid' END AS status,
           len(errors) AS error_count, errors[1] AS first_error,
           landed AND fault NOT IN (2, 3) AS has_bytes
    FROM texts"""
_SUMMARY = """
    SELECT count(*) AS total_files, count(*) FILTER (WHERE status = 'valid') AS valid_count,
           count(*) FILTER (WHERE status <> 'valid') AS invalid_count,
           avg(CASE WHEN status = 'valid' THEN 0.0 ELSE 1.0 END) AS failure_rate,
           CAST(0.25 AS DOUBLE) AS failure_threshold,
           avg(CASE WHEN status = 'valid' THEN 0.0 ELSE 1.0 END) > 0.25 AS should_fail_run
    FROM results"""
ORACLES["validation_summary"] = _rounded(
    f"{FILES_WITH} {_SUMMARY}", "failure_rate", "failure_threshold"
)
ORACLES["validation_report"] = f"""
    {FILES_WITH}, summary AS ({_SUMMARY}),
    texts AS (
        SELECT symbol, pos, rule, error FROM errors
        UNION ALL SELECT symbol, 0, 0, 'file does not exist' FROM files WHERE is_missing),
    numbers AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS file_no FROM files)
    SELECT section, coalesce(file_no, 0) AS file_no, line_no, line FROM (
    SELECT 1 AS section, symbol, 0 AS line_no,
           rpad(CASE WHEN status = 'valid' THEN 'VALID' ELSE 'INVALID' END, 8, ' ')
           || rpad(symbol, 12, ' ') || ' ' || path AS line FROM results
    UNION ALL SELECT 1, symbol, row_number() OVER (PARTITION BY symbol ORDER BY pos, rule),
           '        - ' || error FROM texts
    UNION ALL SELECT 0, NULL, 0, 'Validated ' || total_files || ' expected Bronze files: '
           || valid_count || ' valid, ' || invalid_count || ' invalid' FROM summary
    UNION ALL SELECT 2, NULL, 0,
           'Validation failure rate: ' || printf('%.2f', failure_rate * 100) || '%' FROM summary
    UNION ALL SELECT 2, NULL, 1, 'Validation failure threshold: 25.00%'
    UNION ALL SELECT 2, NULL, 2, 'Validation decision: '
           || CASE WHEN should_fail_run THEN 'FAIL run' ELSE 'PASS run' END FROM summary)
    LEFT JOIN numbers USING (symbol)"""
ORACLES["quarantine_split"] = f"""
    {FILES_WITH}
    SELECT symbol, status,
           CASE WHEN status = 'invalid' THEN replace(path, 'raw/', 'rejected/') END
               AS rejected_path
    FROM results WHERE NOT is_missing"""
ORACLES["run_summary"] = """
    SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS ingestion_successes,
           count(*) FILTER (WHERE event_type = 'error') AS ingestion_failures
    FROM events GROUP BY user_id"""

# Publishing

ORACLES["null_out_nan"] = _rounded(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events""",
    "value",
)
_COUNTS = f"""
    WITH {PORTFOLIO_WITH}
    SELECT 'gold.dim_date' AS table_name, count(*) AS row_count FROM days
    UNION ALL SELECT 'gold.dim_asset', count(*) FROM customer
    UNION ALL SELECT 'gold.dim_portfolio', 2
    UNION ALL SELECT 'gold.fact_asset_daily', count(*) FROM fact
    UNION ALL SELECT 'gold.fact_portfolio_daily', count(*) FROM portfolio
    UNION ALL SELECT 'gold.fact_portfolio_summary_daily', count(*) FROM portfolio
    UNION ALL SELECT 'gold.fact_optimizer_summary', 1
    UNION ALL SELECT 'gold.fact_optimizer_weights', {len(SYMBOLS)}"""
ORACLES["publish_preview"] = _COUNTS
ORACLES["publish_all"] = f"SELECT table_name, 'success' AS status, row_count FROM ({_COUNTS})"
