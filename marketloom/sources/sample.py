"""Engine inputs derived from the sample order, shipment, customer and event tables.

Only max, min and count are used on the source values, so the inputs do not
depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Run date of all derived inputs, and the weights of five assets.
RUN_DATE = "2026-06-16"
PRIORITY_WEIGHTS = {
    "1-URGENT": 0.40,
    "2-HIGH": 0.25,
    "3-MEDIUM": 0.15,
    "4-NOT SPECIFIED": 0.10,
    "5-LOW": 0.10,
}
PRIORITY_CRYPTO = ("4-NOT SPECIFIED", "5-LOW")
SYMBOLS = list(PRIORITY_WEIGHTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_symbol(custkey: Column) -> Column:
    return F.concat(F.lit("C"), custkey.cast("string"))


def customer_is_crypto(custkey: Column) -> Column:
    """Two customers in ten are priced in USDT, by the last digit of the key."""
    return F.right(custkey.cast("string"), F.lit(1)).isin("8", "9")


def _prices(orders: DataFrame, symbol: Column, is_crypto: Column) -> DataFrame:
    total = F.col("o_totalprice")
    daily = orders.groupBy(
        symbol.alias("symbol"),
        is_crypto.alias("is_crypto"),
        F.to_date("o_orderdate").alias("price_date"),
    ).agg(
        (F.lit(10000.0) + F.min(total) / 1000).alias("open_price"),
        (F.lit(10000.0) + F.max(total) / 1000).alias("high_price"),
        (F.lit(10000.0) + F.min(total) / 1000).alias("low_price"),
        (F.lit(10000.0) + F.max(total) / 1000).alias("close_price"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )
    crypto = F.col("is_crypto")
    return daily.select(
        "symbol",
        F.when(crypto, "crypto").otherwise("equity").alias("asset_class"),
        F.when(crypto, "binance").otherwise("yahoo").alias("source"),
        "price_date",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        F.when(crypto, "USDT").otherwise("AUD").alias("currency"),
        F.lit(RUN_DATE).cast("date").alias("ingestion_run_date"),
    )


def priority_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five assets: one per order priority."""
    symbol = F.col("o_orderpriority")
    return _prices(table(spark, sf_dir, "orders"), symbol, symbol.isin(*PRIORITY_CRYPTO))


def customer_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide universe: one asset per customer."""
    key = F.col("o_custkey")
    orders = table(spark, sf_dir, "orders")
    return _prices(orders, customer_symbol(key), customer_is_crypto(key))


def price_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price dates without the aggregation to prices, for the calendar's bounds."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("price_date"))


def shipment_rates(spark: SparkSession, sf_dir: str, every_day: bool = False) -> DataFrame:
    """One FX rate per weekday, or per day."""
    day = F.to_date("l_shipdate")
    shipped = table(spark, sf_dir, "lineitem")
    days = shipped if every_day else shipped.filter(F.weekday(day) < 5)
    return (
        days.groupBy(day.alias("rate_date"))
        .agg((F.lit(0.6) + F.min("l_tax")).alias("rate"))
        .select(
            F.lit("AUDUSD=X").alias("symbol"),
            F.lit("yahoo").alias("source"),
            "rate_date",
            F.lit("AUD").alias("base_currency"),
            F.lit("USD").alias("quote_currency"),
            "rate",
            F.lit(RUN_DATE).cast("date").alias("ingestion_run_date"),
        )
    )


def mode_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUD/USD, and as many other pairs as there are return flags, each with days of its own."""
    day = F.to_date("l_shipdate")
    modes = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("quote_currency"), day.alias("rate_date")
    ).agg((F.lit(2.0) + F.max("l_tax")).alias("rate"))
    aud_usd = shipment_rates(spark, sf_dir)
    others = modes.select(
        F.concat(F.lit("AUD"), "quote_currency", F.lit("=X")).alias("symbol"),
        F.lit("yahoo").alias("source"),
        "rate_date",
        F.lit("AUD").alias("base_currency"),
        "quote_currency",
        "rate",
        F.lit(RUN_DATE).cast("date").alias("ingestion_run_date"),
    )
    return aud_usd.unionByName(others)


def hard_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority prices with zeros on every 9th and a currency without a conversion rule."""
    close = F.when(F.dayofmonth("price_date") == 9, 0.0).otherwise(F.col("close_price"))
    currency = F.when(F.col("symbol") == "3-MEDIUM", "EUR").otherwise(F.col("currency"))
    return priority_prices(spark, sf_dir).withColumns(
        {"close_price": close, "currency": currency}
    )


def customer_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    crypto = customer_is_crypto(key)
    return table(spark, sf_dir, "customer").select(
        customer_symbol(key).alias("symbol"),
        F.when(crypto, "crypto").otherwise("equity").alias("asset_class"),
        F.when(crypto, "binance").otherwise("yahoo").alias("source"),
        F.when(crypto, "USDT").otherwise("AUD").alias("currency"),
        F.col("c_name").alias("description"),
        F.lit(True).alias("is_active"),
    )


def nation_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One portfolio per nation, holding its customers at equal weight."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sizes = customers.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("holdings"))
    held = customers.join(sizes, "c_nationkey")
    return held.select(
        F.concat(F.lit("NATION-"), F.col("c_nationkey").cast("string")).alias("portfolio_name"),
        customer_symbol(F.col("c_custkey")).alias("symbol"),
        (F.lit(1.0) / F.col("holdings")).alias("target_weight"),
    )


def order_mix_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate weights: each customer's orders by priority, as shares."""
    orders = table(spark, sf_dir, "orders")
    counts = orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("o_custkey").agg(F.sum("n").alias("total"))
    return counts.join(totals, "o_custkey").select(
        customer_symbol(F.col("o_custkey")).alias("candidate_id"),
        F.col("o_orderpriority").alias("symbol"),
        (F.col("n") / F.col("total")).alias("weight"),
    )


def _bar(price: DataFrame) -> Column:
    return F.struct(
        F.date_format("price_date", "yyyy-MM-dd'T00:00:00+10:00'").alias("Date"),
        F.col("open_price").alias("Open"),
        F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"),
        F.col("close_price").alias("Close"),
        F.when(F.dayofmonth("price_date") == 13, -F.col("volume"))
        .otherwise(F.col("volume"))
        .alias("Volume"),
    )


def price_klines(prices: DataFrame) -> DataFrame:
    """One array-record document per symbol, 12 texts per record, without faults."""
    day_ms = F.unix_date("price_date").cast("bigint") * 86_400_000
    prices_of = [F.col(c).cast("string") for c in ("open_price", "high_price", "low_price", "close_price")]
    slots = [
        day_ms.cast("string"),
        *prices_of,
        F.col("volume").cast("string"),
        (day_ms + 86_399_999).cast("string"),
        F.lit("0"),
        F.lit("1"),
        F.lit("0"),
        F.lit("0"),
        F.lit("0"),
    ]
    keyed = prices.select(
        "source", "symbol", F.struct("price_date", F.array(*slots).alias("record")).alias("r")
    )
    return (
        keyed.groupBy("source", "symbol")
        .agg(F.sort_array(F.collect_list("r")).alias("rs"))
        .select("source", "symbol", F.col("rs.record").alias("records"))
    )


def price_documents(prices: DataFrame) -> DataFrame:
    """One struct-record document per symbol; volumes of every 13th are negative.

    A document holds at most one record per calendar day.
    """
    return prices.groupBy("source", "symbol").agg(
        F.sort_array(F.collect_list(_bar(prices))).alias("records")
    ).select("source", "symbol", "records")


def rate_documents(rates: DataFrame) -> DataFrame:
    """One FX document; rates of every 13th are negative."""
    close = F.when(F.dayofmonth("rate_date") == 13, -F.col("rate")).otherwise(F.col("rate"))
    record = F.struct(
        F.date_format("rate_date", "yyyy-MM-dd'T00:00:00+10:00'").alias("Date"),
        F.col("rate").alias("Open"),
        F.col("rate").alias("High"),
        F.col("rate").alias("Low"),
        close.alias("Close"),
        F.lit(0.0).alias("Volume"),
    )
    return rates.groupBy("source", "symbol").agg(
        F.sort_array(F.collect_list(record)).alias("records")
    ).select("source", "symbol", "records")


def user_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of event values per user, as crypto pairs."""
    value = F.col("value")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.count(F.lit(1)).alias("trades"),
        )
        .withColumn("symbol", F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("USDT")))
    )


def _odd_times(day: Column, ms: Column) -> Column:
    """Text of an open time: nanoseconds, negative or twenty digits on some days."""
    text = ms.cast("string")
    return (
        F.when(day == 8, F.concat(text, F.lit("000000")))
        .when(day == 9, F.concat(F.lit("-"), text))
        .when(day == 10, F.lit("9" * 20))
        .otherwise(text)
    )


def kline_documents(klines: DataFrame) -> DataFrame:
    """One array-record document per pair, 12 texts per record.

    Volumes of every 13th are negative, and open times of every 17th are not
    numbers. Open times are nanoseconds on the 8th, negative on the 9th and have twenty
    digits on the 10th. A document holds at most one record per calendar day.
    """
    day_ms = F.unix_date("day").cast("bigint") * 86_400_000
    day = F.dayofmonth("day")
    trades = F.col("trades").cast("string")
    slots = [
        F.when(day == 17, F.lit("open")).otherwise(_odd_times(day, day_ms)),
        F.col("low").cast("string"),
        F.col("high").cast("string"),
        F.col("low").cast("string"),
        F.col("high").cast("string"),
        F.when(day == 13, F.concat(F.lit("-"), trades)).otherwise(trades),
        (day_ms + 86_399_999).cast("string"),
        F.col("high").cast("string"),
        trades,
        F.col("low").cast("string"),
        F.col("low").cast("string"),
        F.lit("0"),
    ]
    keyed = klines.select("symbol", F.struct("day", F.array(*slots).alias("record")).alias("r"))
    return (
        keyed.groupBy("symbol")
        .agg(F.sort_array(F.collect_list("r")).alias("rs"))
        .select(F.lit("binance").alias("source"), "symbol", F.col("rs.record").alias("records"))
    )


def faulty_documents(prices: DataFrame) -> DataFrame:
    """Raw texts of struct-record documents, with faults for the validator to find.

    Faults of the document go by the last digit of its symbol, faults of a
    record by its day of the month:

    * symbol ..3 holds the interval twice, which is no fault; ..4 has a bad start date,
      ..5 a lower-case symbol, ..6 a null end date, ..7 no interval; crypto symbols carry
      another source
    * day 2 a null Low, 5 the record twice, 7 a High that is no number, 11 a
      list, 13 a negative Volume, 29 no Close, 31 a Date that is no date
    """
    day = F.dayofmonth("price_date")
    date = F.when(day == 31, F.lit("not-a-date")).otherwise(
        F.date_format("price_date", "yyyy-MM-dd'T00:00:00+10:00'")
    )

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    fields = F.concat(
        F.lit('{"Date":"'), date,
        F.lit('","Open":'), text("open_price"),
        F.lit(',"High":'), F.when(day == 7, F.lit('"n/a"')).otherwise(text("high_price")),
        F.lit(',"Low":'), F.when(day == 2, F.lit("null")).otherwise(text("low_price")),
        F.when(day == 29, F.lit("")).otherwise(F.concat(F.lit(',"Close":'), text("close_price"))),
        F.lit(',"Volume":'), F.when(day == 13, F.lit("-")).otherwise(F.lit("")), text("volume"),
        F.lit("}"),
    )
    record = F.when(day == 11, F.lit("[1,2]")).otherwise(fields)
    copies = F.sequence(F.lit(1), F.when(day == 5, F.lit(2)).otherwise(F.lit(1)))
    rows = prices.select(
        "symbol", "source", F.explode(copies).alias("copy"), "price_date", record.alias("record")
    )
    # At most two records per symbol and day.
    grouped = rows.groupBy("symbol", "source").agg(
        F.sort_array(F.collect_list(F.struct("price_date", "copy", "record"))).alias("rs")
    )
    last = F.right("symbol", F.lit(1))
    body = F.concat(
        F.lit('{"source":"'), F.col("source"),
        F.lit('","symbol":"'), F.when(last == "5", F.lower("symbol")).otherwise(F.col("symbol")),
        F.lit('","start_date":"'), F.when(last == "4", F.lit("n/a")).otherwise(F.lit("1996-01-01")),
        F.lit('","end_date":'), F.when(last == "6", F.lit("null")).otherwise(F.lit('"2001-01-01"')),
        F.when(last == "3", F.lit(',"interval":null')).otherwise(F.lit("")),
        F.when(last == "7", F.lit("")).otherwise(F.lit(',"interval":"1d"')),
        F.lit(',"records":['), F.array_join("rs.record", ","), F.lit("]}"),
    )
    return grouped.select(F.lit("yahoo").alias("source"), "symbol", body.alias("text"))


def faulty_klines(klines: DataFrame) -> DataFrame:
    """Raw texts of array-record documents, with faults by day of the month.

    Day 3 has too few values, 5 comes twice, 7 closes before it opens, 13 has a
    negative volume, 17 an open time that is no number, 19 an object, 23 a trade
    count with a fraction in a text. Open times are nanoseconds on day 8, negative on
    day 9 and have twenty digits on day 10.
    """
    day = F.dayofmonth("day")
    opened = F.unix_date("day").cast("bigint") * 86_400_000
    closed = F.when(day == 7, opened - 1).otherwise(opened + 86_399_999)
    trades = F.col("trades").cast("string")

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    low, high = quoted(F.col("low").cast("string")), quoted(F.col("high").cast("string"))
    values = F.array(
        F.when(day == 17, F.lit('"open"')).otherwise(_odd_times(day, opened)),
        low, high, low, high,
        quoted(F.when(day == 13, F.concat(F.lit("-"), trades)).otherwise(trades)),
        closed.cast("string"),
        high,
        F.when(day == 23, F.lit('"1.5"')).otherwise(trades),
        low, low, F.lit('"0"'),
    )
    kept = F.when(day == 3, F.slice(values, 1, 5)).otherwise(values)
    record = F.when(day == 19, F.lit('{"a":1}')).otherwise(
        F.concat(F.lit("["), F.array_join(kept, ","), F.lit("]"))
    )
    copies = F.sequence(F.lit(1), F.when(day == 5, F.lit(2)).otherwise(F.lit(1)))
    rows = klines.select("symbol", "day", F.explode(copies).alias("copy"), record.alias("record"))
    # At most two records per pair and day.
    grouped = rows.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("day", "copy", "record"))).alias("rs")
    )
    body = F.concat(
        F.lit('{"source":"binance","symbol":"'), F.col("symbol"),
        F.lit('","start_date":"2024-01-04","end_date":"2024-01-25","interval":"1d","records":['),
        F.array_join("rs.record", ","), F.lit("]}"),
    )
    return grouped.select(F.lit("binance").alias("source"), "symbol", body.alias("text"))
