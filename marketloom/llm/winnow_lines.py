"""Line deduplication by winnowing over line hashes.

A document is the sequence of its lines, white space at their ends and blank lines aside.
A *run* is consecutive lines that count ``window`` lines or hold ``words`` words (runs of
anything but white space); a long line alone is one. A document short of both is a run as
a whole. Windows are the runs that lose this when their last or their first line goes; they
cover every run. Of the lines of each window the one of the least hash is selected (the last of
equals): two copies of a run select the same line. Selected lines that occur once in
the corpus are done with. Windows that selected one of the others are joined by content;
every window but the first, by (doc_id, place), is deleted, and overlapping windows make up
the whole extent of a match to both sides. So exactly those lines go that lie in
a run found earlier, and short documents that equal an earlier one.

Cases: null and empty texts have no lines and stay; rows that repeat a doc_id with the same
text are one document, and each gets the same result; with other texts they are documents
of their own, in order of a hash; rows without doc_id stay as they are and take no part. In a
line repeated over and over the first stays. A script without spaces has one word a line, so
there runs count by lines. An empty table gives no rows. ``deduplicated`` keeps other columns,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import flat_lists, free_name, mix, written

WINDOW = 3
WORDS = 10
BLANKS = " \t\r"
SOLID = r"[^\x20\x09-\x0D]+"
KEY = ["doc_id", "version"]


def version(text: Column) -> Column:
    return F.xxhash64(text)


def _lines(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, version, places, hashes, words) of the lines that are not blank."""
    bare = F.transform(
        F.split(F.col("text"), "\n", -1),
        lambda line, i: F.struct(i.alias("i"), F.btrim(line, F.lit(BLANKS)).alias("t")),
    )
    kept = documents.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long"),
        version(F.col("text")).alias("version"),
        F.filter(bare, lambda x: x["t"] != "").alias("lines"),
    )
    # A line of more than ``words`` words counts like one of just as many.
    solid = F.transform(
        "lines", lambda x: F.least(F.regexp_count(x["t"], F.lit(SOLID)), F.lit(words))
    )
    return kept.select(
        *KEY,
        F.transform("lines", lambda x: x["i"]).alias("places"),
        F.transform("lines", lambda x: F.xxhash64(x["t"])).alias("hashes"),
        solid.alias("words"),
    )


def windows(
    offsets: np.ndarray, counts: np.ndarray, window: int, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of all windows of documents laid end to end, in order.

    ``offsets`` cut the lines into documents, ``counts`` are their words.
    """
    sizes = np.diff(offsets)
    low, high = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    at = np.arange(len(counts))
    last = np.minimum(np.searchsorted(total, total[:-1] + words) - 1, at + window - 1)
    first = np.maximum(
        np.searchsorted(total, total[1:] - words, side="right") - 1, at - window + 1
    )
    ahead, behind = last < high, first >= low
    held = total[offsets[1:]] - total[offsets[:-1]]
    short = (sizes > 0) & (sizes < window) & (held < words)
    firsts = np.concatenate([at[ahead], first[behind], offsets[:-1][short]])
    lasts = np.concatenate([last[ahead], at[behind], offsets[1:][short] - 1])
    firsts, more = np.divmod(np.unique(firsts * window + lasts - firsts), window)
    return firsts, firsts + more


def selected(hashes: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """For each window the place of its least hash, the last of equals."""
    best = firsts.copy()
    for step in range(1, int((lasts - firsts).max(initial=0)) + 1):
        here = np.minimum(firsts + step, lasts)
        best = np.where(hashes[here] <= hashes[best], here, best)
    return best


def _laid(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, hashes and word counts of a batch's lines."""
    offsets, hashes = flat_lists(batch["hashes"])
    return offsets.astype(np.int64), hashes, flat_lists(batch["words"])[1]


def _selected(
    batches: Iterable[pa.RecordBatch], window: int, words: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, hashes, counts = _laid(batch)
        marked = np.unique(selected(hashes, *windows(offsets, counts, window, words)))
        rows = np.searchsorted(offsets, marked, side="right") - 1
        columns = [batch[c].take(pa.array(rows)) for c in KEY]
        columns += [pa.array((marked - offsets[rows]).astype(np.int32)), pa.array(hashes[marked])]
        yield pa.RecordBatch.from_arrays(columns, [*KEY, "at", "mark"])


def _runs(batches: Iterable[pa.RecordBatch], window: int, words: int) -> Iterator[pa.RecordBatch]:
    """The windows that selected one of the given places, with a hash of 128 bits."""
    for batch in batches:
        offsets, hashes, counts = _laid(batch)
        bounds, around = flat_lists(batch["around"])
        wanted = np.zeros(len(hashes), bool)
        wanted[np.repeat(offsets[:-1], np.diff(bounds)) + around] = True
        firsts, lasts = windows(offsets, counts, window, words)
        kept = wanted[selected(hashes, firsts, lasts)]
        firsts, lasts = firsts[kept], lasts[kept]
        own, sizes = hashes.view(np.uint64), lasts - firsts + 1
        sums = np.tile(sizes.astype(np.uint64), (2, 1))
        for step in range(window):
            inside = step < sizes
            line = own[firsts[inside] + step]
            for k, factor in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
                sums[k, inside] = mix(sums[k, inside] * np.uint64(factor) + line)
        rows = np.searchsorted(offsets, firsts, side="right") - 1
        columns = [batch[c].take(pa.array(rows)) for c in KEY]
        places = (firsts - offsets[rows]).astype(np.int32), sizes.astype(np.int32)
        columns += [pa.array(x) for x in (*places, *sums.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, [*KEY, "start", "size", "one", "two"])


def repeated_lines(documents: DataFrame, window: int = WINDOW, words: int = WORDS) -> DataFrame:
    """(doc_id, version, removed): the lines, counted from 0, of later repeated runs."""
    lines = written(_lines(documents, words), "line-hashes")
    schema = "doc_id long, version long, at int, mark long"
    marks = lines.mapInArrow(lambda b: _selected(b, window, words), schema)
    marks = written(marks, "line-marks")
    shared = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    around = marks.join(shared, "mark", "left_semi").groupBy(*KEY).agg(
        F.collect_set("at").alias("around")
    )
    schema = "doc_id long, version long, start int, size int, one long, two long"
    runs = lines.join(around, KEY).select(*KEY, "hashes", "words", "around")
    runs = written(runs.mapInArrow(lambda b: _runs(b, window, words), schema), "line-runs")
    place = F.struct("doc_id", "version", "start")
    first = runs.groupBy("one", "two").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
    )
    later = runs.join(first.filter("n > 1"), ["one", "two"]).filter(place > F.col("first"))
    found = F.collect_set(F.struct("start", "size")).alias("found")
    inside = F.array_distinct(
        F.flatten(
            F.transform("found", lambda r: F.sequence(r["start"], r["start"] + r["size"] - 1))
        )
    )
    numbered = lines.join(later.groupBy(*KEY).agg(found), KEY).select(
        *KEY, F.array_sort(F.transform(inside, lambda i: F.get("places", i))).alias("removed")
    )
    return numbered.dropDuplicates(KEY)


def deduplicated(documents: DataFrame, window: int = WINDOW, words: int = WORDS) -> DataFrame:
    """All documents with text less its removed lines; ``__removed`` lists those lines.

    Where ``documents`` has a column of that name, the list's gets more underscores before it.
    """
    removed = repeated_lines(documents, window, words)
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"))
    same = (F.col("doc.doc_id") == F.col("doc_id")) & (
        version(F.col("doc.text")) == F.col("version")
    )
    # Membership by a map, so that long documents are not searched once per line.
    gone = F.map_from_entries(F.transform("removed", lambda i: F.struct(i, F.lit(True))))
    joined = packed.join(removed, same, "left").select("doc", "removed", gone.alias("gone"))
    lines = F.split(F.col("doc.text"), "\n", -1)
    kept = F.filter(lines, lambda line, i: F.try_element_at("gone", i).isNull())
    text = F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(F.array_join(kept, "\n"))
    columns = [
        text.alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in documents.columns
    ]
    return joined.select(*columns, F.col("removed").alias(free_name(documents, "__removed")))
