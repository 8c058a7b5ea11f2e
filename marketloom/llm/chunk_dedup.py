"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes: h = 2h + gear[byte]. A cut falls behind a byte where
four bits of h that depend on the last 16 bytes are zero, at least ``LEAST`` and at most ``MOST``
bytes behind the previous cut, never inside a character. Cuts depend on nearby bytes only,
so an insertion changes the chunks around it and the rest line up again.

A chunk is repeated if a chunk of the same 128-bit digest stands earlier, by (doc_id, version,
place), where the version is a hash of the text.
Neighbouring repeated chunks make up a span; spans of at least ``min_chars`` characters
count, for shorter ones are common phrases, unless they are a whole document: a text of fewer
characters counts where all its chunks are repeated. All but the first occurrence can thus
be removed.

Chunks are counted by half their digest first, and only those counted twice are joined on.

Cases: null and empty texts have no chunks and stay; rows that repeat a doc_id with the same
text are one document, and each gets the same result; with other texts they are documents of
their own, and each loses only spans of its own text; rows without doc_id take no part; an empty
table gives no spans. Other columns are ignored, or kept by ``deduplicated``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import mix, slices, written

LEAST, MOST = 16, 128
MIN_CHARS = 96
SLICE = 4_000_000
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
CUT_SHIFT, CUT_BITS = 11, 15


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash behind each byte; sixteen bytes decide its sixteen lowest bits."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step].copy() << np.uint32(step)
    return h


def cuts(data: np.ndarray) -> list[int]:
    """Ends of the chunks of one text's bytes."""
    n = len(data)
    if not n:
        return []
    hashes = gear_hashes(data) if n > 8 else GEAR[data]
    wanted = (hashes >> np.uint32(CUT_SHIFT)) & np.uint32(CUT_BITS) == 0
    whole = np.append((data[1:] & 0xC0) != 0x80, True)
    ends, last = [], 0
    for cut in [*(np.flatnonzero(wanted & whole) + 1).tolist(), n]:
        while cut - last > MOST:
            last += MOST
            while not whole[last - 1]:
                last -= 1
            ends.append(last)
        if cut - last >= LEAST:
            ends.append(last := cut)
    if last < n:
        ends.append(n)
    return ends


def _chunks(batches: Iterable[pa.RecordBatch], digests: bool) -> Iterator[pa.RecordBatch]:
    """Half of each chunk's digest alone, or all that is known of the chunk."""
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            ids, starts, sizes, found, counts = [], [], [], [], []
            columns = (rows[c].to_pylist() for c in ("doc_id", "text"))
            for doc_id, text in zip(*columns, strict=True):
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                ends = cuts(data)
                begins = [0, *ends[:-1]]
                found += [
                    blake2b(raw[a:b], digest_size=16).digest()
                    for a, b in zip(begins, ends, strict=True)
                ] if ends else []
                if digests and ends:
                    places = np.cumsum((data & 0xC0) != 0x80)[np.array(ends) - 1]
                    starts.append(np.concatenate([[0], places[:-1]]))
                    sizes.append(np.diff(places, prepend=0))
                    ids.append(np.full(len(ends), doc_id))
                counts.append(len(ends))
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            if not digests:
                yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0].copy())], ["one"])
            elif ids:
                own = np.repeat(np.arange(len(counts)), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(halves[:, 0].copy()),
                        pa.array(halves[:, 1].copy()),
                        pa.array(np.concatenate(ids), pa.int64()),
                        pa.array(np.concatenate(starts), pa.int64()),
                        pa.array(np.concatenate(sizes), pa.int32()),
                        *(rows[c].take(pa.array(own)) for c in ("version", "total")),
                    ],
                    ["one", "two", "doc_id", "start", "size", "version", "total"],
                )


def repeated_spans(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, start, end, first_doc_id, n_chunks): spans that stand earlier elsewhere.

    Places are code points, end exclusive. ``first_doc_id`` holds the first occurrence of
    the span's first chunk.
    """
    return _repeated(documents, min_chars).drop("version")


def version(text: Column) -> Column:
    return F.xxhash64(text)


def _repeated(documents: DataFrame, min_chars: int) -> DataFrame:
    """The spans, with the version of the text that they are places of."""
    texts = documents.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long"),
        "text",
        version(F.col("text")).alias("version"),
        F.length("text").alias("total"),
    )
    halves = texts.select("doc_id", "text").mapInArrow(lambda b: _chunks(b, False), "one long")
    twice = halves.groupBy("one").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one")
    schema = "one long, two long, doc_id long, start long, size int, version long, total int"
    chunks = texts.mapInArrow(lambda b: _chunks(b, True), schema)
    shared = written(chunks.join(twice, "one", "left_semi"), "shared-chunks")
    place = F.struct("doc_id", "version", "start")
    first = shared.groupBy("one", "two").agg(F.min(place).alias("first"))
    later = shared.join(first, ["one", "two"]).filter(place > F.col("first"))
    chunk = F.struct(
        "start",
        (F.col("start") + F.col("size")).alias("end"),
        F.col("first.doc_id").alias("first"),
    )
    own = later.groupBy("doc_id", "version", "total").agg(
        F.array_sort(F.collect_set(chunk)).alias("chunks")
    )
    schema = "doc_id long, start long, end long, first_doc_id long, n_chunks int, version long"
    return own.mapInArrow(lambda b: _spans(b, min_chars), schema)


def _spans(batches: Iterable[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring chunks as one span, if it is long or the whole text."""
    names = ["doc_id", "start", "end", "first_doc_id", "n_chunks", "version"]
    for batch in batches:
        out = []
        known = (batch[c].to_pylist() for c in ("doc_id", "version", "total", "chunks"))
        for doc_id, own, total, chunks in zip(*known, strict=True):
            for start, end, first, n in _merged((c["start"], c["end"], c["first"]) for c in chunks):
                if end - start >= min_chars or (start, end) == (0, total):
                    out.append((doc_id, start, end, first, n, own))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )


def _merged(places: Iterable[tuple[int, int, int]]) -> list[list[int]]:
    """Spans [start, end, first, n_chunks] of places in order."""
    out = []
    for start, end, first in places:
        if out and start <= out[-1][1]:
            out[-1][1], out[-1][3] = max(out[-1][1], end), out[-1][3] + 1
        else:
            out.append([start, end, first, 1])
    return out


def deduplicated(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All documents, their text without the repeated spans."""
    spans = _repeated(documents, min_chars).groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"))
    own = F.col("doc.text")
    same = (F.col("doc.doc_id") == F.col("doc_id")) & (version(own) == F.col("version"))
    joined = packed.join(spans, same, "left")
    # What stands between the spans: from each end to the next start.
    whole = F.array(F.length(own).cast("long"))
    starts = F.concat(F.transform("spans", lambda s: s["start"]), whole)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))

    def between(a: Column, b: Column) -> Column:
        length = F.greatest(b - a, F.lit(0)).cast("int")
        return F.substring(own, (a + 1).cast("int"), length)

    pieces = F.zip_with(ends, starts, between)
    text = F.when(F.col("spans").isNull(), own).otherwise(F.array_join(pieces, ""))
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(f"doc.`{c}`") for c in documents.columns]
    )
