"""Near-duplicate documents by Order MinHash, verified by banded alignment.

The k-mers of a document are its five-word shingles, each labelled by how often it has
occurred before. Each of ``hashes`` random orders of labelled k-mers picks the ``picks``
least and keeps them in text order: a sketch entry agrees for two documents if they share
these k-mers and their sequence, which makes agreement follow edit similarity.

Documents of the same words are one class before anything else; one of them stands for all.
Representatives that agree in an entry share a bucket. Candidates are verified by aligning
their word sequences within the band that the threshold allows: with c aligned of a and b words
the similarity is c / (a + b - c). At 0.8 that admits a ninth of the words replaced. Texts whose
shingles have a Jaccard similarity of 0.8 agree in an entry with a probability of 0.51 and are
missed in all 48 with one below 1e-14. One replaced word breaks five shingles: with a ninth of the
words replaced at random places 0.39 of the shingles are shared, an entry agrees with 0.06
and all 48 miss with 0.06. Edits that lie together break fewer.

Buckets are never paired off. First the members of a bucket are aligned with its least
document, and verified links merge components, however large the group. Buckets that still
hold several components are then packed into blocks of a bounded number of rows (a
representative is a row for each such bucket, ``hashes`` at most, whatever the size of a group),
and blocks of one bucket are compared within tasks: pairs of one component, of sizes that differ
too much, or whose signatures put the Jaccard similarity of their labelled words, which the
similarity cannot exceed, more than a margin below the threshold (a byte for each of 1024 bins,
four standard errors, made by the task from the block's words) are passed over; the others are aligned, once, for the least bucket that
they share, by the task that holds their blocks, unless links that it found before connect them.
So every two components that share a bucket are compared, and only links become rows, fewer
in a task than the components it meets. The result are the components of all verified links.

Cases: a null text is a class of its own, a null id has class null; texts without words are
a class if equal; those under five words match equal words only; rows that repeat a doc_id
are classed by their own texts, and two classes of the same least doc_id bear the same name; an
empty table gives no rows. Other columns are ignored, or kept by ``one_of_each``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import (
    SHINGLE_WORDS,
    flat_lists,
    mix,
    shingle_hashes,
    slices,
    word_hashes,
    written,
)
from marketloom.llm.graph import components

SIMILARITY = 0.8
HASHES, PICKS = 48, 3
SLICE, CELLS = 400_000, 2_000_000
BINS, MARGIN, BLOCK_ROWS, BLOCK_BYTES = 1024, 0.05, 1024, 4 << 20
# Elements that occur more often are kept as bits.
FREQUENT = 256
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
KEY = ["doc_id", "one", "two"]
SEEDS = mix(np.arange(1, 1025, dtype=np.uint64))


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes mixed with the number of equal ones before."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    seen = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.append(starts, len(ordered))))
    occurrence = np.empty(len(ordered), np.uint64)
    occurrence[order] = seen.astype(np.uint64)
    return mix(hashes + occurrence * np.uint64(0x9E3779B97F4A7C15))


def signature(labels: np.ndarray) -> np.ndarray:
    """A byte for the least label in each bin, 0 for an empty bin."""
    low = np.full(BINS, NONE, np.uint64)
    np.minimum.at(low, (labels % np.uint64(BINS)).astype(np.int64), labels // np.uint64(BINS))
    return np.where(low == NONE, 0, low % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def sketch(
    words: np.ndarray, hashes: int = HASHES, picks: int = PICKS
) -> tuple[np.ndarray, np.ndarray]:
    """The entries of a text and the words' signature."""
    if len(words) < SHINGLE_WORDS:
        return np.empty(0, np.int64), np.zeros(BINS, np.uint8)
    return entries_of(words, hashes, picks), text_signature(words)


def text_signature(words: np.ndarray) -> np.ndarray:
    return signature(labelled(np.ascontiguousarray(words).view(np.uint64)))


def entries_of(words: np.ndarray, hashes: int = HASHES, picks: int = PICKS) -> np.ndarray:
    """A number for each random order, none for texts without a shingle."""
    shingles = shingle_hashes(words)
    n = len(shingles)
    if not n:
        return np.empty(0, np.int64)
    labels, least = labelled(shingles), np.empty((hashes, min(n, picks)), np.int64)
    step = max(1, CELLS // n)
    for at in range(0, hashes, step):
        seeds = SEEDS[at : min(at + step, hashes), None]
        ranks = (labels[None, :] ^ seeds) * np.uint64(0xD6E8FEB86659FD93)
        ranks ^= ranks >> np.uint64(32)
        ranks *= np.uint64(0x9E3779B97F4A7C15)
        if n > picks:
            rows = np.arange(len(ranks))
            for pick in range(picks):
                lowest = ranks.argmin(axis=1)
                least[at : at + step, pick] = lowest
                ranks[rows, lowest] = NONE
        else:
            least[at : at + step] = np.arange(n)
    entry = np.zeros(hashes, np.uint64)
    for place in np.sort(least, axis=1).T:
        entry = mix(entry * np.uint64(0x9E3779B97F4A7C15) + shingles[place])
    return mix(entry + SEEDS[:hashes]).view(np.int64)


def _sketched(batches: Iterable[pa.RecordBatch], hashes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "words", SLICE):
            offsets, words = flat_lists(rows["words"])
            found = [
                entries_of(words[a:b], hashes)
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            ends = np.cumsum([0, *map(len, found)])
            entries = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate(found), pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    rows["doc_id"],
                    rows["one"],
                    rows["two"],
                    pa.array(np.diff(offsets), pa.int32()),
                    entries,
                ],
                ["doc_id", "one", "two", "n", "sketch"],
            )


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence whose matches lie within ``band`` of the diagonal.

    Bit-parallel: a bit of the row is 0 where that element of ``a`` lengthens the alignment. Only
    the bits within the band can change; whole numbers of any length hold them.
    """
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    start = int(differ[0]) if len(differ) else short
    a, b = a[start:], b[start:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    end = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - end].tolist(), b[: len(b) - end].tolist()
    common, n = start + end, len(a)
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    masks = {x: sum(1 << i for i in at) for x, at in places.items() if len(at) > FREQUENT}
    low, high, row = 0, min(n, band), (1 << min(n, band)) - 1
    for j, x in enumerate(b):
        if j > band:
            # The lowest bit leaves the band; a zero is an aligned element.
            common += 1 - (row & 1) if low < high else 0
            row, low = row >> 1, min(low + 1, n)
        if j + band < n:
            row |= 1 << (j + band - low)
            high = j + band + 1
        if x in masks:
            match = (masks[x] >> low) & ((1 << (high - low)) - 1)
        elif x in places:
            at = places[x]
            match = 0
            for i in at[bisect_left(at, low) : bisect_left(at, high)]:
                match |= 1 << (i - low)
        else:
            continue
        kept = row & match
        row = ((row + kept) | (row - kept)) & ((1 << (high - low)) - 1)
    return common + (high - low) - row.bit_count()


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two word sequences are similar; see the module."""
    total = len(a) + len(b)
    # c / (total - c) >= t  <=>  c >= total * t / (1 + t)
    least = int(np.ceil(total * threshold / (1 + threshold) - 1e-9))
    if min(len(a), len(b)) < least:
        return False
    return aligned(a, b, total - 2 * least) >= least


def _verified(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (one, x), (two, y) = flat_lists(batch["x"]), flat_lists(batch["y"])
        keep = [
            similar(x[one[i] : one[i + 1]], y[two[i] : two[i + 1]], threshold)
            for i in range(batch.num_rows)
        ]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _members(reps: DataFrame) -> DataFrame:
    """(bucket, node, n) of the representatives that share a bucket with another."""
    entries = reps.select("node", "n", F.explode("sketch").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = shared.filter("low < high").select("bucket")
    return written(entries.join(shared, "bucket", "left_semi"), "near-members")


# Signatures are the largest part and follow from the words: blocks are written without them.
BLOCK = {
    "block": pa.int64(),
    "nodes": pa.list_(pa.int64()),
    "components": pa.list_(pa.int64()),
    "sizes": pa.list_(pa.int32()),
    "signatures": pa.binary(),
    "sketches": pa.list_(pa.int64()),
    "words": pa.binary(),
}
# Blocks as they are written; ``split`` if their bucket has others.
PACKED = {"bucket": pa.int64(), "split": pa.bool_()}
PACKED |= {c: k for c, k in BLOCK.items() if c != "signatures"} | {"sketches": pa.binary()}
ZSTD = pa.Codec("zstd")


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows and their blocks: at most ``BLOCK_ROWS`` of a bucket, about ``BLOCK_BYTES``."""
    task, number, last, rows, size = TaskContext.get().partitionId(), 0, None, 0, 0
    for batch in batches:
        blocks = []
        for bucket, n in zip(batch["bucket"].to_pylist(), batch["n"].to_pylist(), strict=True):
            full = rows == BLOCK_ROWS or size + 8 * n > BLOCK_BYTES
            if rows and (bucket != last or full):
                number, rows, size = number + 1, 0, 0
            last, rows, size = bucket, rows + 1, size + 8 * n
            blocks.append(task << 32 | number)
        columns = [*batch.columns, pa.array(blocks, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "block"])


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block as one row a block; copies share most words: these are compressed."""
    held: list[tuple] = []

    def batch_of(blocks: list[list]) -> pa.RecordBatch:
        rows = []
        for block in blocks:
            bucket, split, number, node, component, size, sketches, texts = zip(*block, strict=True)
            both = np.array(sketches, np.int64).tobytes(), b"".join(texts)
            packed = [ZSTD.compress(x, asbytes=True) for x in both]
            rows.append((bucket[0], split[0], number[0], node, component, size, *packed))
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, PACKED.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(PACKED))

    for batch in batches:
        done = []
        offsets, words = flat_lists(batch["words"])
        texts = [words[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        for row in zip(*(c.to_pylist() for c in batch.columns[:-1]), texts, strict=True):
            if held and row[2] != held[0][2]:
                done.append(held)
                held = []
            held.append(row)
        if done:
            yield batch_of(done)
    if held:
        yield batch_of([held])


def _opened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, a row at a time, as ``_compared`` takes them."""
    for batch in batches:
        names = [c for c in batch.schema.names if not c.startswith("split")]
        kinds = {"bucket": pa.int64(), **BLOCK}
        for row in batch.select(names).to_pylist():
            for mark in ("", "_") if "block_" in row else ("",):
                for c in ("sketches", "words"):
                    with pa.CompressedInputStream(pa.py_buffer(row[c + mark]), "zstd") as stream:
                        row[c + mark] = stream.read()
                row[f"sketches{mark}"] = np.frombuffer(row[f"sketches{mark}"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[c]], kinds[c.removesuffix("_")]) for c in names], names
            )


def _compared(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between components within a block, or between two blocks of a bucket.

    Pairs are aligned here, and those that links found before in the task connect are passed over:
    a task's links are fewer than the components it meets, and pairs are never rows.
    """
    none = np.iinfo(np.int64).max
    united: dict[int, int] = {}

    def head(component: int) -> int:
        while component in united:
            above = united[component]
            united[component] = united.get(above, above)
            component = above
        return component

    for batch in batches:
        found = []
        crossed = "block_" in batch.schema.names
        for row in batch.to_pylist():
            bucket, sides = row["bucket"], []
            for mark in ("", "_") if crossed else ("",):
                n = np.array(row[f"sizes{mark}"])
                entries = np.array(row[f"sketches{mark}"], np.int64).reshape(len(n), -1)
                words = np.frombuffer(row[f"words{mark}"], np.int64)
                texts = np.split(words, np.cumsum(n)[:-1])
                marks = np.array([text_signature(text) for text in texts])
                comps = row[f"components{mark}"]
                sides.append((row[f"nodes{mark}"], comps, n, marks, entries, texts))
            a, a_comp, a_n, x, p, a_texts = sides[0]
            b, b_comp, b_n, y, q, b_texts = sides[-1]
            open_ = np.array(a_comp)[:, None] != np.array(b_comp)[None, :]
            fits = np.minimum(a_n[:, None], b_n) >= np.maximum(a_n[:, None], b_n) * threshold - 1e-9
            open_ &= fits
            if not crossed:
                open_ &= np.tri(len(a), k=-1, dtype=bool).T
            used, used_ = x > 0, y > 0
            for i in np.flatnonzero(open_.any(axis=1)):
                at = np.flatnonzero(open_[i])
                own = head(a_comp[i])
                at = at[[head(b_comp[j]) != own for j in at]]
                others = y[at]
                same = ((others == x[i]) & used[i]).sum(axis=1)
                either = (used_[at] | used[i]).sum(axis=1)
                at = at[same >= (threshold - MARGIN) * either]
                if not len(at):
                    continue
                shared = np.where(q[at] == p[i], p[i], none).min(axis=1)
                for j in at[shared == bucket]:
                    one, two = head(a_comp[i]), head(b_comp[j])
                    if one != two and similar(a_texts[i], b_texts[j], threshold):
                        united[max(one, two)] = min(one, two)
                        found.append((max(a[i], b[j]), min(a[i], b[j])))
        columns = list(zip(*found, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _verify(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    x = words.select(F.col("node").alias("a"), F.col("words").alias("x"))
    y = words.select(F.col("node").alias("b"), F.col("words").alias("y"))
    joined = pairs.distinct().join(x, "a").join(y, "b").select("a", "b", "x", "y")
    checked = joined.mapInArrow(lambda b: _verified(b, threshold), "a long, b long")
    return written(checked.distinct(), "near-links")


def links(documents: DataFrame, reps: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(a, b): verified pairs of representatives, enough to hold every class together."""
    spark = documents.sparkSession
    members = _members(reps)
    asked = reps.join(members.select("node").distinct(), "node", "left_semi")
    # The text of a representative, once; other texts of its doc_id have other digests.
    likely = documents.join(asked.select("doc_id").distinct(), "doc_id", "left_semi")
    own = _digests(likely).join(asked.select(*KEY, "node"), KEY)
    words = written(own.groupBy("node").agg(F.first("words").alias("words")), "near-words")
    leaders = members.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.min_by("n", "node").alias("leader_n")
    )
    leaders = written(leaders, "near-leaders")
    # Sequences whose lengths differ too much cannot reach the threshold.
    fits = F.least("n", "leader_n") >= F.greatest("n", "leader_n") * threshold - 1e-9
    stars = members.join(leaders, "bucket").filter((F.col("node") != F.col("leader")) & fits)
    stars = stars.select(F.col("node").alias("a"), F.col("leader").alias("b"))
    found = _verify(stars, words, threshold)

    comps = components(found)
    placed = members.join(comps, "node", "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("component")
    )
    placed = written(placed, "near-placed")
    several = placed.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    several = several.filter("low < high").select("bucket")
    rest = written(placed.join(several, "bucket", "left_semi"), "near-rest")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rest.repartitionByRange(parts, "bucket", "node").sortWithinPartitions(
        "bucket", "node"
    )
    fields = "bucket long, node long, n int, component long"
    numbered = ordered.select("bucket", "node", "n", "component").mapInArrow(
        _numbered, f"{fields}, block long"
    )
    # Blocks are dealt out before words meet them: words travel once for each bucket.
    numbered = written(numbered, "near-numbered")
    split = numbered.groupBy("bucket").agg((F.min("block") < F.max("block")).alias("split"))
    texts = reps.select("node", "sketch").join(words, "node")
    gathered = numbered.join(split, "bucket").join(texts, "node")
    gathered = gathered.repartitionById(parts, F.shiftright("block", 32).cast("int"))
    gathered = gathered.sortWithinPartitions("block", "node")
    schema = (
        "bucket long, split boolean, block long, nodes array<long>, components array<long>, "
        "sizes array<int>, sketches binary, words binary"
    )
    fields = ["bucket", "split", "block", "node", "component", "n", "sketch", "words"]
    packed = gathered.select(*fields).mapInArrow(_packed, schema)
    blocks = written(packed, "near-blocks")

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compared(_opened(batches), threshold)

    within = blocks.mapInArrow(compared, "a long, b long")
    # Most buckets are one block, which the joins leave out. Pairs of different blocks are dealt by
    # both, so that a bucket of many is many tasks' work.
    blocks = blocks.filter("split")
    others = blocks.select("bucket", *[F.col(c).alias(f"{c}_") for c in blocks.columns[1:]])
    ids = blocks.select("bucket", "block").join(others.select("bucket", "block_"), "bucket")
    ids = ids.filter("block < block_").repartition(parts, "block", "block_")
    both = ids.join(blocks.drop("bucket"), "block").join(others.drop("bucket"), "block_")
    across = both.mapInArrow(compared, "a long, b long")
    return found.unionByName(written(within.unionByName(across).distinct(), "near-links"))


def _digests(documents: DataFrame, *carried: Column) -> DataFrame:
    """(doc_id, words, one, two): word hashes of each row and two digests of its words."""
    text = F.col("text")
    hashed = documents.select(
        F.col("doc_id").cast("long"), "text", word_hashes(text).alias("words"), *carried
    )
    bare = F.size("words") == 0
    return hashed.select(
        "doc_id",
        *hashed.columns[3:],
        "words",
        F.when(text.isNull(), F.col("doc_id"))
        .when(bare, F.xxhash64("text"))
        .otherwise(F.xxhash64("words"))
        .alias("one"),
        F.when(text.isNull(), F.lit(-1).cast("long"))
        .when(bare, F.xxhash64(F.lit(2), "text"))
        .otherwise(F.xxhash64(F.lit(1), "words"))
        .alias("two"),
    )


def _classed(documents: DataFrame, threshold: float, hashes: int) -> DataFrame:
    """(doc_id, one, two, component, class_id) of each row; rows without doc_id have neither."""
    schema = "doc_id long, one long, two long, n int, sketch array<long>"
    sketched = _digests(documents).mapInArrow(lambda b: _sketched(b, hashes), schema)
    rows = written(sketched, "near-sketches")
    exact = rows.filter("doc_id IS NOT NULL").groupBy("one", "two").agg(
        F.min("doc_id").alias("doc_id"),
        *[F.first(c).alias(c) for c in ("n", "sketch")],
    )
    # A doc_id may stand for several texts, so representatives have numbers of their own.
    exact = exact.withColumn("node", F.monotonically_increasing_id())
    exact = written(exact, "near-representatives")
    comps = components(links(documents, exact, threshold))
    linked = exact.select("node", F.col("doc_id").alias("least")).join(comps, "node")
    names = linked.groupBy("component").agg(F.min("least").alias("class_id"))
    named = exact.select("one", "two", "node", F.col("doc_id").alias("least")).join(
        comps.join(names, "component"), "node", "left"
    )
    named = named.select(
        "one",
        "two",
        F.coalesce("component", "node").alias("component"),
        F.coalesce("class_id", "least").alias("class_id"),
    )
    joined = rows.select("doc_id", "one", "two").join(named, ["one", "two"], "left")
    has_id = F.col("doc_id").isNotNull()
    return joined.select(
        "doc_id", "one", "two", *[F.when(has_id, F.col(c)).alias(c) for c in ("component", "class_id")]
    )


def near_duplicates(
    documents: DataFrame, threshold: float = SIMILARITY, hashes: int = HASHES
) -> DataFrame:
    """(doc_id, class_id) of each row; a class is named by its least doc_id."""
    return _classed(documents, threshold, hashes).select("doc_id", "class_id")


def one_of_each(
    documents: DataFrame, threshold: float = SIMILARITY, hashes: int = HASHES
) -> DataFrame:
    """One document of each class, that of the least id; rows without doc_id stay.

    Rows are judged by their own texts: of a repeated doc_id each text goes or stays by itself.
    Of rows that repeat id and words the one of the least text stays.
    """
    classes = written(_classed(documents, threshold, hashes), "near-classes")
    known = classes.filter("doc_id IS NOT NULL")
    first = known.groupBy("component").agg(F.min(F.struct(*KEY)).alias("first"))
    kept = written(first.select("first.*"), "near-kept")
    several = known.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    several = written(several, "near-repeated-ids")
    unnamed = documents.filter("doc_id IS NULL")
    single = documents.join(several, "doc_id", "left_anti").join(kept, "doc_id", "left_semi")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    repeated = documents.join(several, "doc_id", "left_semi")
    # The whole row beside its digests: its columns may have any names.
    packed = _digests(repeated, F.struct(*columns).alias("row")).join(kept, KEY, "left_semi")
    chosen = packed.groupBy(*KEY).agg(F.min_by("row", F.struct("row.text")).alias("row"))
    once = unnamed.select(*columns).unionByName(single.select(*columns))
    return once.unionByName(chosen.select("row.*"))
