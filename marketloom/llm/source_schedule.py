"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equal size. Slot i has the golden-ratio point
frac((i + 1) * phi); the cumulative target shares map that point to a source, so any
stretch of the schedule holds each source close to its share. The slots of a source are
ranked, and rank r takes the r-th block of that source: its documents in shuffled order,
laid end to end and cut into blocks of ``block`` words, beginning again at the first
document once all are used.

Cases: null or blank texts have size 0 and are taken 0 words; the null source is a source
of its own, ordered last; rows that repeat a doc_id are documents of their own, numbered by
``copy``; rows without doc_id are documents like others, told apart by ``row``, a hash of source
and text, and numbered by ``copy`` where that is equal; an empty table gives an empty mix. Extra
columns of any name are ignored, or kept by ``mixed_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.llm.common import written

# The golden ratio's fraction in units of 2**-32: points are exact whole numbers.
GOLDEN, UNITS = 2654435769, 2**32
WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 8192
SLOTS_PER_CHUNK = 4096
CELLS_PER_SOURCE = 4
# A document: whether it has a doc_id, that or a hash, and its number among equal ones.
IDENTITY = ["named", "row", "copy"]


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(
    sources: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_repeats: float = MOST_REPEATS,
) -> DataFrame:
    """Add ``target`` to (source, source_size): shares by weight below a cap.

    Resharing the excess of capped sources by weight until none is above its cap ends where
    every other source has the same level of words per weight. Sources are capped in
    ascending order of cap per weight; the level is the first that lies below the next cap.
    One row per source: the windows run over as many rows as there are sources.
    """
    ordered = W.orderBy(F.col("source").asc_nulls_last())
    by_room = W.orderBy("room", F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(0))
    weight_list = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sources.withColumn("position", F.row_number().over(ordered) - 1)
        .withColumn("weight", F.get(weight_list, F.col("position") % len(weights)))
        .withColumn("cap", F.col("source_size") * F.lit(float(most_repeats)))
        .withColumn("room", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(total_share)))
    )
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    leveled = ranked.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (
            F.sum("weight").over(everything)
            - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        ),
    ).withColumn(
        "water",
        F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "position", "level"))).over(
            everything
        )["level"],
    )
    # Without such a level every source is at its cap.
    target = F.least(F.col("cap"), F.coalesce(F.col("water"), F.col("room")) * F.col("weight"))
    return leveled.select("source", "source_size", "position", target.alias("target"))


def _row_key(doc_id: Column, source: Column, text: Column) -> tuple[Column, Column]:
    named = doc_id.isNotNull()
    return named.alias("named"), F.coalesce(doc_id, F.xxhash64(source, text)).alias("row")


def _same_document(a: str, b: str) -> Column:
    named, row, copy = (F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in IDENTITY)
    return named & row & copy


def _shuffled(sized: DataFrame, seed: int) -> DataFrame:
    """Add ``begin``: words before the document in its source's shuffled order.

    A source may hold any share of the rows. Its order is bucket, hash, identity. There are as many
    buckets as the square root of the rows, so neither the windows within them nor those over
    one row for each bucket grow with more than that root.
    """
    buckets = sized.select(F.greatest(F.lit(1), F.ceil(F.sqrt(F.count(F.lit(1))))).alias("n"))
    key = F.xxhash64(F.lit(seed), "row")
    spread = sized.withColumn("key", key).withColumn(
        "bucket", F.pmod(F.shiftrightunsigned("key", 20), buckets.scalar())
    )
    within = W.partitionBy("source", "bucket").orderBy("key", *IDENTITY)
    sums = spread.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    ahead = W.partitionBy("source").orderBy("bucket")
    starts = sums.select(
        F.col("source").alias("s"),
        F.col("bucket").alias("b"),
        (F.sum("bucket_size").over(ahead) - F.col("bucket_size")).alias("bucket_begin"),
    )
    placed = spread.withColumn("inner_begin", F.sum("size").over(within) - F.col("size"))
    joined = placed.join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    )
    return joined.select(
        "doc_id",
        *IDENTITY,
        "source",
        "size",
        (F.col("bucket_begin") + F.col("inner_begin")).alias("begin"),
    )


def schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source, rank, words): every source has ceil(target / block) slots.

    The points of a source keep their order; ``rank`` counts them. N golden-ratio points leave
    no gap above 1.9 / N, so twice as many points as slots give every source its slots. Those
    beyond a source's need are left out, and its last slot is as short as its target asks.
    Counting is in two steps, per stretch of slots and then within it, so no window holds all
    slots of a source.
    """
    spark = targets.sparkSession
    needed = targets.select(
        "source",
        "position",
        F.floor("target").alias("words_needed"),
        F.ceil(F.floor("target") / block).alias("slots"),
    ).filter("slots > 0")
    everything, ordered = W.partitionBy(F.lit(0)), W.orderBy("position")
    shares = needed.withColumn("share", F.col("slots") / F.sum("slots").over(everything))
    shares = shares.withColumn("high", F.sum("share").over(ordered)).withColumn(
        "low", F.coalesce(F.lag("high").over(ordered), F.lit(0.0))
    )
    top = F.max("position").over(everything)
    shares = written(
        shares.withColumn("high", F.when(F.col("position") == top, 1.0).otherwise(F.col("high"))),
        "mix-shares",
    )
    total, held = shares.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    points, cells = 2 * total, max(1, CELLS_PER_SOURCE * held)
    # Points are even over the cells, which hold 1.25 intervals on average, whatever their lengths.
    first, last = F.floor(F.col("low") * cells), F.floor(F.col("high") * cells)
    intervals = shares.select(
        "position", "low", "high", F.explode(F.sequence(first, last)).alias("cell")
    )
    point = F.pmod((F.col("slot") + 1) * F.lit(GOLDEN), F.lit(UNITS)) / UNITS
    slots = spark.range(points).select(F.col("id").alias("slot"))
    drawn = slots.withColumn("point", point).withColumn("cell", F.floor(F.col("point") * cells))
    found = drawn.join(intervals, "cell").filter("low <= point AND point < high")
    mapped = found.select(
        "slot", F.floor(F.col("slot") / SLOTS_PER_CHUNK).alias("chunk"), "position"
    )
    counts = mapped.groupBy("position", "chunk").agg(F.count(F.lit(1)).alias("n"))
    ahead = W.partitionBy("position").orderBy("chunk")
    before = counts.select(
        "position", "chunk", (F.sum("n").over(ahead) - F.col("n")).alias("rank_before")
    )
    within = W.partitionBy("position", "chunk").orderBy("slot")
    ranked = (
        mapped.withColumn("inner_rank", F.row_number().over(within) - 1)
        .join(before, ["position", "chunk"])
        .withColumn("rank", F.col("rank_before") + F.col("inner_rank"))
    )
    return ranked.join(shares, "position").filter("rank < slots").select(
        "slot",
        "source",
        "rank",
        F.least(F.lit(block), F.col("words_needed") - F.col("rank") * block).alias("words"),
    )


def mix(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_repeats: int = MOST_REPEATS,
    block: int = BLOCK_WORDS,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(segments, sizes) of the mix of ``documents`` (doc_id, text, source).

    ``segments``: slot, slot_offset, doc_id, named, row, copy, pass, first_word, n_words. Read by
    (slot, slot_offset) they are the mix. ``sizes``: doc_id, named, row, copy, source, size,
    source_size, target.
    """
    text = F.col("text")
    sized = written(
        documents.select(
            "doc_id",
            *_row_key(F.col("doc_id"), F.col("source"), text),
            "source",
            word_count(text).alias("size"),
            F.xxhash64("text").alias("text_key"),
        ),
        "mix-sizes",
    )
    twins = W.partitionBy("named", "row").orderBy("source", "text_key")
    sized = sized.withColumn("copy", F.row_number().over(twins) - 1).drop("text_key")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sources, weights, total_share, most_repeats), "mix-targets")
    slots = schedule(targets, block)
    facts = targets.select(
        F.col("source").alias("s"), "source_size", "target", F.floor("target").alias("need")
    )
    placed = _shuffled(sized, seed).join(facts, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = written(placed, "mix-documents")
    passes = F.explode(F.sequence(F.lit(0), F.lit(int(math.ceil(most_repeats)) - 1)))
    begin = F.col("begin") + F.col("pass") * F.col("source_size")
    taken = placed.filter("size > 0").withColumn("pass", passes).withColumn("from", begin)
    taken = taken.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("need"))).filter(
        "from < to"
    )
    first, last = F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)
    pieces = taken.withColumn("rank", F.explode(F.sequence(first, last)))
    low = F.greatest(F.col("from"), F.col("rank") * block)
    high = F.least(F.col("to"), (F.col("rank") + 1) * block)
    pieces = pieces.select(
        F.col("source").alias("s"),
        F.col("rank").alias("r"),
        "doc_id",
        *IDENTITY,
        "pass",
        (low - F.col("from")).alias("first_word"),
        (high - low).alias("n_words"),
        (low - F.col("rank") * block).alias("slot_offset"),
    )
    joined = slots.join(
        pieces, F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r"))
    )
    segments = joined.select(
        "slot", "slot_offset", "doc_id", *IDENTITY, "pass", "first_word", "n_words"
    )
    return segments, placed.select(
        "doc_id", *IDENTITY, "source", "size", "source_size", "target"
    )


def taken_words(segments: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): each document once, taken 0 if left out."""
    sums = segments.groupBy(*IDENTITY).agg(F.sum("n_words").alias("taken"))
    joined = sizes.alias("d").join(sums.alias("t"), _same_document("d", "t"), "left")
    return joined.select(
        "d.doc_id",
        "d.size",
        "d.source_size",
        "d.target",
        F.coalesce("t.taken", F.lit(0)).alias("taken"),
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents of the mix, whole, once for each pass that takes words of them.

    A row is repeated as often as the schedule begins it; columns stay as they are. Only the
    document at which a source's target falls is taken whole where the mix takes a part.
    """
    segments, _ = mix(documents, **options)
    passes = segments.groupBy(*IDENTITY).agg(F.countDistinct("pass").alias("times"))
    copies = F.map_from_entries(F.collect_list(F.struct("copy", "times")))
    passes = passes.groupBy("named", "row").agg(copies.alias("times"))
    # The whole row beside its identity: its columns may have any names.
    columns = [F.col(f"`{c}`") for c in documents.columns]
    key = _row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    joined = documents.select(*key, F.struct(*columns).alias("document")).join(
        passes, ["named", "row"]
    )
    # Rows of one identity are numbered as in mix(); the join has brought them together.
    twins = W.partitionBy("named", "row").orderBy("document.source", F.xxhash64("document.text"))
    numbered = joined.withColumn("copy", F.row_number().over(twins) - 1)
    times = F.coalesce(F.element_at("times", F.col("copy")), F.lit(0)).cast("int")
    repeated = numbered.select("document", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select("document.*")
