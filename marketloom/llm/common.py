"""Helpers that the operators share: written tables, words, arrays in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.sources.tables import shared_folder

WORD = r"[\p{L}\p{N}]+"
SHINGLE_WORDS = 5


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.

    The files outlive lost executors, unlike a cached table.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda word: F.xxhash64(word))


def flat_lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column; a null list is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return offsets - offsets[0], values[offsets[0] : offsets[-1]]


def slices(batch: pa.RecordBatch, column: str, units: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold few units (bytes of text, list values), or one long row."""
    kind = batch.schema.field(column).type
    measure = pc.list_value_length if pa.types.is_list(kind) else pc.binary_length
    lengths = pc.fill_null(measure(batch[column]), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, length in enumerate(lengths):
        if i > start and held + length > units:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(length) + 16
    if start < batch.num_rows:
        yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """One hash for each run of ``size`` consecutive word hashes, by start position."""
    hashes = np.ascontiguousarray(hashes).view(np.uint64)
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return mix(total)
