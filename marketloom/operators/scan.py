"""Running values of long histories, in blocks: no task holds a whole history.

Rows are cut into blocks, such as the days of a history in seconds. A window runs within each
block, and the blocks' totals, one row each, are carried over the blocks before: a prefix scan
whose two parts merge by the measure's own rule. Windows over all rows of a key (``operators.
portfolio``) give the same and are simpler where a key has a row per day.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

Measure = tuple[str, Column]


def _mean(average: Column, least: Column, most: Column) -> Column:
    """The mean, exact where all values are the same, so that these spread by nothing."""
    return F.when(least == most, least).otherwise(average)


def _within(kind: str, value: Column, running: WindowSpec) -> Column:
    """The measure up to each row, within its block."""
    if kind == "moments":
        return F.struct(
            F.count(value).over(running).alias("n"),
            _mean(*[f(value).over(running) for f in (F.avg, F.min, F.max)]).alias("mean"),
            (F.var_pop(value).over(running) * F.count(value).over(running)).alias("m2"),
        )
    if kind == "last":
        return F.last(value, ignorenulls=True).over(running)
    return getattr(F, kind)(value).over(running)


def _total(kind: str, value: Column, order: Column) -> Column:
    """The measure of a whole block."""
    if kind == "moments":
        n = F.count(value)
        mean = _mean(F.avg(value), F.min(value), F.max(value))
        return F.struct(n.alias("n"), mean.alias("mean"), (F.var_pop(value) * n).alias("m2"))
    if kind == "last":
        return F.max(F.when(value.isNotNull(), F.struct(order, value.alias("value"))))["value"]
    return getattr(F, kind)(value)


def _carried(kind: str, total: Column, before: WindowSpec) -> Column:
    """The measure of all blocks before each."""
    if kind == "count":
        return F.coalesce(F.sum(total).over(before), F.lit(0))
    if kind == "last":
        return F.last(total, ignorenulls=True).over(before)
    if kind != "moments":
        return getattr(F, kind)(total).over(before)
    # Squares are taken around the first mean. That block is among those before each, so
    # what cancels out is at most its share of the rows.
    n, apart = total["n"], total["mean"] - total["first"]
    held = F.coalesce(F.sum(n).over(before), F.lit(0))
    off = F.try_divide(F.sum(n * apart).over(before), held)
    around = F.sum(total["m2"] + n * apart**2).over(before)
    spread = F.greatest(around - held * off**2, F.lit(0.0))
    mean = F.first(total["mean"], ignorenulls=True).over(before) + off
    return F.struct(held.alias("n"), mean.alias("mean"), spread.alias("m2"))


def _merged(kind: str, before: Column, own: Column) -> Column:
    if kind == "count":
        return F.coalesce(before, F.lit(0)) + own
    if kind == "sum":
        return F.coalesce(before + own, before, own)
    if kind == "max":
        return F.greatest(before, own)
    if kind == "min":
        return F.least(before, own)
    if kind == "last":
        return F.coalesce(own, before)
    nothing = F.lit(0.0)
    n = F.coalesce(before["n"], F.lit(0)) + own["n"]
    apart = F.coalesce(own["mean"] - before["mean"], nothing)
    mean = F.coalesce(
        before["mean"] + apart * own["n"] / F.nullif(n, F.lit(0)), before["mean"], own["mean"]
    )
    m2 = F.coalesce(before["m2"], nothing) + F.coalesce(own["m2"], nothing)
    m2 += F.coalesce(apart**2 * before["n"] * own["n"] / F.nullif(n, F.lit(0)), nothing)
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def blocked_scan(
    rows: DataFrame,
    scope: Sequence[str],
    order: Sequence[str],
    block: Column,
    measures: Mapping[str, Measure],
) -> DataFrame:
    """Rows with running measures per ``scope``, in ``order``, each row included.

    ``measures`` maps a new column to (kind, value); kinds are sum, count, max, min, last (the
    last value that is not null) and moments (a struct n, mean, m2: see ``deviation``). ``block``
    must not fall as ``order`` rises, and one block is what one task sorts. Null scopes, and null
    blocks, which come first, are groups of their own. Rows equal in ``order`` follow each
    other in any order. ``rows`` is read twice, so hand in a table. Columns keep any names.
    """
    named = [(f"v{i}", name, kind) for i, (name, (kind, _)) in enumerate(measures.items())]
    place = F.struct(*[F.col(f"`{c}`").alias(f"s{i}") for i, c in enumerate(scope)], block.alias("b"))
    packed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)]).alias("at"),
        # Null fields of a struct are equal in a join, and the window's partitioning serves it.
        place.alias("place"),
        *[value.alias(v) for (v, _, _), (_, value) in zip(named, measures.values(), strict=True)],
    )
    running = Window.partitionBy("place").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = packed.select(
        "row", "place", *[_within(kind, F.col(v), running).alias(v) for v, _, kind in named]
    )
    totals = packed.groupBy("place").agg(
        *[_total(kind, F.col(v), F.col("at")).alias(v) for v, _, kind in named]
    )
    key = [F.col(f"place.s{i}") for i in range(len(scope))]
    whole = Window.partitionBy(*key)
    before = whole.orderBy("place.b").rowsBetween(Window.unboundedPreceding, -1)
    first = whole.orderBy("place.b").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    for v, _, kind in named:
        if kind == "moments":
            mean = F.first(F.col(f"{v}.mean"), ignorenulls=True).over(first)
            totals = totals.withColumn(v, F.col(v).withField("first", mean))
    carry = totals.select(
        F.col("place").alias("held_place"),
        *[_carried(kind, F.col(v), before).alias(f"held_{v}") for v, _, kind in named],
    )
    joined = local.join(carry, F.col("place") == F.col("held_place"))
    return joined.select(
        *[F.col(f"row.`{c}`") for c in rows.columns],
        *[_merged(kind, F.col(f"held_{v}"), F.col(v)).alias(name) for v, name, kind in named],
    )


def deviation(moments: Column) -> Column:
    """The sample standard deviation of running moments; null below two values."""
    return F.when(moments["n"] > 1, F.sqrt(moments["m2"] / (moments["n"] - 1)))


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    block: Callable[[Column], Column],
) -> DataFrame:
    """Every row of ``left`` with the ``values`` that ``right`` held at or before its ``time``.

    Both sides have ``keys`` and ``time`` of any ordered type, and ``block`` maps a time to its
    block (``blocked_scan``), so that a key's rows spread over tasks. Rows without a match, without
    a key or a time have null values; of several right rows of one time the greatest values count.
    """
    shared = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)]
    asking = left.select(
        *shared, F.col(f"`{time}`").alias("t"), F.lit(1).alias("side"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("asked"),
    )
    known = F.lit(True)
    for name in [*keys, time]:
        known = known & F.col(f"`{name}`").isNotNull()
    given = right.filter(known).select(
        *shared, F.col(f"`{time}`").alias("t"), F.lit(0).alias("side"),
        F.struct(*[F.col(f"`{c}`") for c in values]).alias("given"),
    )
    both = given.unionByName(asking, allowMissingColumns=True)
    scope = [f"k{i}" for i in range(len(keys))]
    held = blocked_scan(
        both, scope, ["t", "side", "given"], block(F.col("t")),
        {"held": ("last", F.col("given"))},
    )
    return held.filter("side = 1").select(
        *[F.col(f"asked.`{c}`") for c in left.columns], *[F.col(f"held.`{c}`") for c in values]
    )
