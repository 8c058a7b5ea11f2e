"""Return matrix, mean vector and covariance of a list of symbols."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom import config


def symbol_column(symbol: str) -> Column:
    """A matrix column; symbols contain dots, so the name is quoted."""
    return F.col(f"`{symbol}`")


def complete_returns(
    fact: DataFrame,
    symbols: Sequence[str],
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """One row per date, one column per symbol; only dates where every symbol has a return."""
    if not symbols:
        raise ValueError("A return matrix needs one symbol or more.")
    returns = fact.select("date_key", "symbol", "daily_return").filter(
        F.col("symbol").isin(*symbols) & F.col("daily_return").isNotNull()
    )
    if start_date is not None:
        returns = returns.filter(F.col("date_key") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        returns = returns.filter(F.col("date_key") <= F.lit(end_date).cast("date"))
    matrix = (
        returns.groupBy("date_key")
        .pivot("symbol", list(symbols))
        .agg(F.first("daily_return", ignorenulls=True))
    )
    # dropna would drop NaN as well.
    complete = matrix.filter(reduce(and_, [symbol_column(s).isNotNull() for s in symbols]))
    columns = [symbol_column(s).cast("double").alias(s) for s in symbols]
    return complete.select("date_key", *columns)


def return_matrix(
    fact: DataFrame,
    symbols: Sequence[str],
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """``complete_returns`` in date order, for presentation."""
    return complete_returns(fact, symbols, start_date, end_date).orderBy("date_key")


def lookback(matrix: DataFrame) -> DataFrame:
    """First and last matrix date and the number of dates, one row."""
    return matrix.agg(
        F.min("date_key").alias("lookback_start_date"),
        F.max("date_key").alias("lookback_end_date"),
        F.count(F.lit(1)).alias("observation_count"),
    )


def day_vectors(returns: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(by, symbols) of each list, and (by, symbols, date_key, x) of its complete days.

    ``x`` holds the returns in symbol order. NaN counts as missing.
    """
    kept = returns.select(*by, "symbol", "date_key", "daily_return").dropna(subset="daily_return")
    names = kept.select(*by, "symbol").distinct()
    lists = names.groupBy(*by).agg(F.array_sort(F.collect_list("symbol")).alias("symbols"))
    # Rows of a day are gathered where the shuffle brings them: lists do not shrink before it.
    days = kept.repartition(*by, "date_key").groupBy(*by, "date_key").agg(
        F.array_sort(F.collect_list(F.struct("symbol", "daily_return"))).alias("cells")
    )
    complete = days.join(lists, list(by)).filter(F.size("cells") == F.size("symbols"))
    return lists, complete.select(
        *by, "symbols", "date_key", F.col("cells.daily_return").cast("array<double>").alias("x")
    )


def day_statistics(vectors: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, observations, statistics) of each list: sums, then sums of products, as one array.

    The products are those of symbols i and j from i on, i by i. Such arrays of disjoint days
    add up, and those of days that leave a lookback are subtracted. Days are summed in the
    tasks that hold them before sums are shuffled.
    """
    # A number of tasks is set, since a row stands for as many products as its symbols have pairs.
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    days = vectors.select(*by, "date_key", "x").repartition(tasks, *by, "date_key")
    pairs = (
        days.select(*by, "x", F.posexplode("x").alias("i", "p"))
        .select(*by, "i", "p", F.posexplode("x").alias("j", "q"))
        .filter("i <= j")
    )
    summed = pairs.groupBy(*by, "i", "j").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("p").alias("sum"),
        F.sum(F.col("p") * F.col("q")).alias("product"),
    )
    cells = summed.groupBy(*by).agg(
        F.max("days").alias("observations"),
        F.array_sort(F.collect_list(F.struct("i", "j", "sum", "product"))).alias("cells"),
    )
    sums = F.expr("filter(cells, c -> c.i = c.j).sum")
    return cells.select(
        *by, "observations", F.concat(sums, F.col("cells.product")).alias("statistics")
    )


GROUPED = (
    "symbols array<string>, observation_count long, annual_returns array<double>, "
    "annual_covariances array<array<double>>"
)
GROUPED_TYPES = {
    "symbols": pa.list_(pa.string()),
    "observation_count": pa.int64(),
    "annual_returns": pa.list_(pa.float64()),
    "annual_covariances": pa.list_(pa.list_(pa.float64())),
}


def _moments_row(key: tuple, names: list[str], values: list | None) -> pa.Table:
    """One row of key and values in ``GROUPED_TYPES``, or none."""
    types = [*(k.type for k in key), *GROUPED_TYPES.values()]
    cells = [] if values is None else [*(k.as_py() for k in key), *values]
    columns = [[c] for c in cells] or [[]] * len(types)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.Table.from_arrays(arrays, [*names, *GROUPED_TYPES])


def grouped(
    returns: DataFrame, by: Sequence[str], days: int = config.CALENDAR_DAYS_PER_YEAR
) -> DataFrame:
    """Annual moments of many symbol lists at once, from rows (by, symbol, date_key, daily_return).

    Rows may hold ``daily_returns`` instead, those of consecutive days from ``date_key`` on
    (``assets.return_runs``). A group's matrix has one row per date on which all of its symbols
    have a return, as in ``complete_returns``; it is as large as its calendar times its symbols,
    and tasks hold one at a time. Below two such dates the moments are NULL. NaN counts as
    missing. Rows that lie together by ``by`` already are not shuffled again.
    """
    by = list(by)
    if "daily_returns" in returns.columns:
        runs = F.col("daily_returns").cast("array<double>")
    else:
        known = F.col("daily_return").cast("double")
        runs = F.when(~F.isnan(known), F.array(known))
    kept = returns.select(
        *by, "symbol", F.unix_date(F.col("date_key").cast("date")).alias("day"), runs.alias("runs")
    ).dropna(subset=["day", "runs"])
    keys = kept.select(*by).schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in keys]
    names_of_keys = keys.names

    def of_group(key: tuple, rows: pa.Table) -> pa.Table:
        symbol = rows["symbol"].combine_chunks().dictionary_encode(null_encoding="encode")
        names = np.array(symbol.dictionary.to_pylist(), object)
        runs = rows["runs"].combine_chunks()
        lengths, flat = runs.value_lengths().to_numpy(), runs.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        at = np.repeat(rows["day"].to_numpy() - ends + lengths, lengths) + np.arange(len(flat))
        place = np.repeat(symbol.indices.to_numpy(), lengths)
        known = ~np.isnan(flat)
        at, place, flat = at[known], place[known], flat[known]
        # Symbols without any return are not in the list.
        held, place = np.unique(place, return_inverse=True)
        names, order = names[held], np.argsort(names[held])
        if not len(names):
            return _moments_row(key, names_of_keys, None)
        at = at - at.min()
        values = np.full((at.max() + 1, len(names)), np.nan)
        values[at, place] = flat
        if np.count_nonzero(~np.isnan(values)) != len(flat):
            raise ValueError("A symbol has several returns on one date.")
        names, values = names[order], values[:, order]
        values = values[~np.isnan(values).any(axis=1)]
        result = [names.tolist(), len(values), None, None]
        if len(values) > 1:
            covariances = np.atleast_2d(np.cov(values, rowvar=False)) * days
            result[2:] = [values.mean(axis=0) * days, covariances.tolist()]
        return _moments_row(key, names_of_keys, result)

    return kept.groupBy(*by).applyInArrow(of_group, ", ".join([*fields, GROUPED]))


def rolling_covariances(
    returns: DataFrame,
    by: Sequence[str],
    length: int,
    days: int = config.CALENDAR_DAYS_PER_YEAR,
) -> DataFrame:
    """Annual covariances of every pair of a list over the last ``length`` complete days.

    Rows (by, date_key, symbol_i, symbol_j, annual_covariance) of i up to j, from the first
    full lookback on. Running sums of a pair are added day by day; what left the lookback is
    subtracted. Tasks are dealt by pair.
    """
    by = list(by)
    _, vectors = day_vectors(returns, by)
    # Returns are centred on the list's means: small sums lose fewer digits when subtracted.
    means = day_statistics(vectors, by).select(
        *by, F.expr("transform(statistics, s -> s / observations)").alias("m")
    )
    pairs = vectors.join(means, by).select(
        *by,
        "date_key",
        F.explode(
            F.expr(
                "flatten(transform(sequence(0, size(x) - 1), i -> transform(sequence(i, size(x) - 1), "
                "j -> named_struct('symbol_i', symbols[i], 'symbol_j', symbols[j], "
                "'p', x[i] - m[i], 'q', x[j] - m[j]))))"
            )
        ).alias("c"),
    ).select(*by, "date_key", "c.*")
    pair = Window.partitionBy(*by, "symbol_i", "symbol_j").orderBy("date_key")
    running = pair.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = pairs.select(
        *by, "date_key", "symbol_i", "symbol_j",
        F.row_number().over(pair).alias("day"),
        F.sum("p").over(running).alias("sp"),
        F.sum("q").over(running).alias("sq"),
        F.sum(F.col("p") * F.col("q")).over(running).alias("spq"),
    )
    left = {f"{c}_left": F.coalesce(F.lag(c, length).over(pair), F.lit(0.0)) for c in ("sp", "sq", "spq")}
    inside = sums.withColumns(left).filter(F.col("day") >= length)
    p, q, pq = (F.col(c) - F.col(f"{c}_left") for c in ("sp", "sq", "spq"))
    covariance = (pq - p * q / length) / (length - 1) * days
    return inside.select(
        *by, "date_key", "symbol_i", "symbol_j", covariance.alias("annual_covariance")
    )


def _per_symbol(matrix: DataFrame, symbols: Sequence[str], days: int) -> DataFrame:
    """(i, mean, covariances) for each symbol, in one pass over the matrix.

    Each row is repeated for each of its symbols with the whole row beside it, and the sums of
    symbol i with all others are running aggregates of group i. No pair rows are built,
    and the plan has the same shape for any number of symbols.
    """
    values = F.array(*[symbol_column(s) for s in symbols])
    each = matrix.select(values.alias("row")).select(
        F.posexplode("row").alias("i", "x"), "row"
    )
    with_others = [
        F.covar_samp("x", F.get("row", F.lit(j))) * days for j in range(len(symbols))
    ]
    return each.groupBy("i").agg(
        (F.avg("x") * days).alias("mean"), F.array(*with_others).alias("covariances")
    )


def _named(symbols: Sequence[str], at: str) -> Column:
    return F.get(F.array(*[F.lit(s) for s in symbols]), F.col(at))


def annual_means(
    matrix: DataFrame, symbols: Sequence[str], days: int = config.CALENDAR_DAYS_PER_YEAR
) -> DataFrame:
    """Arithmetic annual mean return per symbol; NULL without a row in the matrix."""
    columns = [
        F.struct(F.lit(s).alias("symbol"), (F.avg(symbol_column(s)) * days).alias("annual_return"))
        for s in symbols
    ]
    row = matrix.agg(*[c.alias(f"m{i}") for i, c in enumerate(columns)])
    return row.select(F.inline(F.array(*row.columns)))


def annual_covariances(
    matrix: DataFrame, symbols: Sequence[str], days: int = config.CALENDAR_DAYS_PER_YEAR
) -> DataFrame:
    """Annual sample covariance of every ordered pair of symbols; NULL below two dates."""
    rows = _per_symbol(matrix, symbols, days)
    pairs = rows.select("i", F.posexplode("covariances").alias("j", "annual_covariance"))
    return pairs.select(
        _named(symbols, "i").alias("symbol_i"),
        _named(symbols, "j").alias("symbol_j"),
        "annual_covariance",
    )


def moments(
    matrix: DataFrame, symbols: Sequence[str], days: int = config.CALENDAR_DAYS_PER_YEAR
) -> DataFrame:
    """One row: annual means and covariances as arrays in symbol order, and the lookback.

    The result has as many numbers as the symbol list squared.
    """
    rows = _per_symbol(matrix, symbols, days)
    ordered = rows.agg(
        F.array_sort(F.collect_list(F.struct("i", "mean", "covariances"))).alias("r")
    )
    window = lookback(matrix).select(F.struct("*")).scalar()
    return ordered.withColumn("w", window).select(
        F.col("r.mean").alias("annual_returns"),
        F.col("r.covariances").alias("annual_covariances"),
        "w.observation_count",
        "w.lookback_start_date",
        "w.lookback_end_date",
    )
