"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by size: partition u holds items of at most u five-word shingles
and more than half of that. A MinHash of a whole long document says nothing about a short
item, so for each partition a document is cut into windows of 2u shingles, u apart; any
passage of an item's length lies whole in one of them. The signature of a set is the least
hash in each of some bins. An item is a candidate of a document if a window agrees with it in
one bin. Candidates are verified: the share of the item's distinct shingles that the
document holds, counted exactly, must reach the threshold.

Documents are not shuffled. Items go to the tasks in blocks of a bounded number of shingles,
one pass over the documents for each block.

An item wholly inside a document has at least a quarter of a window's shingles, so it is
missed with a probability below 1e-5; one at the threshold about once in 1e4 or less.

Cases: null and empty texts and those under five words have no shingle and match nothing;
repeated rows are searched and reported each; empty tables give no pairs. Extra columns are
ignored, or kept by ``decontaminated``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import (
    flat_lists,
    shingle_hashes,
    slices,
    word_hashes,
    written,
)

CONTAINMENT = 0.8
BLOCK_SHINGLES = 4_000_000
# Words that a task searches at a time.
SLICE = 200_000
HASHES = "__word_hashes"
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def bins(size: int) -> int:
    """Bins of a signature; small sets need more, so that two shingles seldom share one."""
    return 256 if size < 8 else 64


class Index:
    """A block of test items, as tasks search it."""

    def __init__(self, item_ids: list, shingles: list[np.ndarray], threshold: float):
        self.item_ids, self.threshold = item_ids, threshold
        self.shingles = [np.unique(s) for s in shingles]
        self.partitions: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list[int]] = {}
        for i, s in enumerate(self.shingles):
            if len(s):
                by_size.setdefault(2 ** len(s).bit_length() - 1, []).append(i)
        for size, items in by_size.items():
            values = [signature(self.shingles[i], 0, 1, bins(size))[0] for i in items]
            values = [v[v != NONE] for v in values]
            owners = np.repeat(items, [len(v) for v in values])
            marks = np.concatenate(values)
            order = np.argsort(marks, kind="stable")
            self.partitions[size] = (marks[order], owners[order])

    def pairs(self, words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of a batch of documents, verified."""
        rows = [shingle_hashes(words[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        flat = np.concatenate([*rows, np.empty(0, np.uint64)])
        lengths = np.array([len(r) for r in rows], np.int64)
        row_of = np.repeat(np.arange(len(rows)), lengths)
        position = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        candidates: set[tuple[int, int]] = set()
        for size, (marks, owners) in self.partitions.items():
            counts = -(-lengths // size)
            first = np.cumsum(counts) - counts
            low = signature(flat, first[row_of] + position // size, int(counts.sum()), bins(size))
            owner_row = np.repeat(np.arange(len(rows)), counts)
            if len(low) == 0:
                continue
            # A window is a stretch and the next of the same document; the last stands alone.
            following = np.append(owner_row[1:] == owner_row[:-1], False)
            window = low.copy()
            inner = np.flatnonzero(following)
            window[inner] = np.minimum(low[inner], low[inner + 1])
            at = np.searchsorted(marks, window.ravel()).reshape(window.shape)
            hit = (marks[np.minimum(at, len(marks) - 1)] == window) & (window != NONE)
            for w, b in zip(*np.nonzero(hit), strict=True):
                for i in range(at[w, b], np.searchsorted(marks, window[w, b], "right")):
                    candidates.add((int(owner_row[w]), int(owners[i])))
        found, have = [], {}
        for row, item in sorted(candidates):
            if row not in have:
                have = {row: np.unique(rows[row])}
            own = self.shingles[item]
            at = np.minimum(np.searchsorted(have[row], own), len(have[row]) - 1)
            shared = int((have[row][at] == own).sum())
            if shared >= self.threshold * len(own) - 1e-9:
                found.append((row, item, shared))
        return found


def signature(hashes: np.ndarray, group: np.ndarray | int, groups: int, n_bins: int) -> np.ndarray:
    """The least hash in each bin, for each group; bins follow from the lowest bits."""
    low = np.full(groups * n_bins, NONE, np.uint64)
    np.minimum.at(low, group * n_bins + (hashes % np.uint64(n_bins)).astype(np.int64), hashes)
    return low.reshape(groups, n_bins)


def _blocks(benchmark: DataFrame, threshold: float) -> Iterator[Index]:
    """The items in blocks by hash of their id, so that a block's shingles are bounded."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("words"))
    items = written(items.filter(F.size("words") > 0), "benchmark-items")
    total = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    count = -(-total // BLOCK_SHINGLES)
    for block in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(count)) == block)
        got = part.toArrow()
        offsets, words = flat_lists(got["words"])
        sets = [shingle_hashes(words[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield Index(got["item_id"].to_pylist(), sets, threshold)


def _search(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "item_id", "n_shared", "n_item"]
    for batch in batches:
        for rows in slices(batch, HASHES, SLICE):
            offsets, words = flat_lists(rows[HASHES])
            found = index.pairs(words, offsets)
            columns = [
                rows["doc_id"].take(pa.array([r for r, _, _ in found], pa.int64())),
                pa.array([index.item_ids[i] for _, i, _ in found], pa.int64()),
                pa.array([n for _, _, n in found], pa.int64()),
                pa.array([len(index.shingles[i]) for _, i, _ in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def contaminated(
    documents: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): items that documents contain."""
    spark = documents.sparkSession
    hashed = documents.select(
        F.col("doc_id").cast("long"), word_hashes(F.col("text")).alias(HASHES)
    )
    schema = "doc_id long, item_id long, n_shared long, n_item long"
    pairs = spark.createDataFrame([], schema)
    for index in _blocks(benchmark, threshold):
        shared = spark.sparkContext.broadcast(index)
        pairs = pairs.unionByName(
            hashed.mapInArrow(lambda b, shared=shared: _search(b, shared.value), schema)
        )
    return pairs.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def _kept(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, HASHES, SLICE):
            offsets, words = flat_lists(rows[HASHES])
            keep = np.ones(rows.num_rows, bool)
            keep[[r for r, _, _ in index.pairs(words, offsets)]] = False
            yield rows.drop_columns([HASHES]).filter(pa.array(keep))


def decontaminated(
    documents: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT
) -> DataFrame:
    """The documents that contain no test item, with all their columns; no shuffle."""
    kept = documents
    for index in _blocks(benchmark, threshold):
        shared = documents.sparkSession.sparkContext.broadcast(index)
        hashed = kept.withColumn(HASHES, word_hashes(F.col("text")))
        kept = hashed.mapInArrow(
            lambda b, shared=shared: _kept(b, shared.value), documents.schema
        )
    return kept
