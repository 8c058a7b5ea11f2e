"""Token ids in ORC files: run-length encoded, indexed, in document order.

Documents are dealt to files by doc_id range and sorted; each task writes its part once, so
a lost executor costs its own parts only. ORC stores the ids as run-length encoded integers
in stripes, with min/max rows indexes and Bloom filters on doc_id. Readers take stripes in
parallel and skip those whose metadata excludes the ids asked for.

A file row is (doc_id, part, part_offset, n_tokens, ids): ``part_offset`` counts the ids before
the document in its file, and ``offsets`` adds those of the files before.

Cases: null or empty text has the end id only; rows that repeat a doc_id are written each,
in the order of their texts; a null doc_id comes first; an empty table gives files without
rows. Extra columns are not written.
"""

from __future__ import annotations

import codecs
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.llm.common import slices
from marketloom.sources.tables import shared_folder

TOKENIZER, END_ID = "byte_bpe_50k.json", 0
# Pieces of each kind that an encoder keeps, and bytes of text that it takes at a time.
CACHED_PIECES, SLICE = 500_000, 1_000_000
SCHEMA = "doc_id long, part int, part_offset long, n_tokens int, ids array<int>"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(64 << 20),
}


# How the byte-level tokenizer splits a text before merging; fixed by the vocabulary's files.
PRETOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Runs without spaces hold whole pretokens: spaces are split off here as they are there.
RUNS = r" ?\S+|\s+(?!\S)|\s+"
# Each is a pretoken by itself after a letter and before a space.
MARKS = tuple(".,;:!?")


class _Kept(dict):
    """Ids of pieces met so far. A full table takes no more: frequent pieces come early."""

    def keep(self, piece: str, ids: bytes) -> bytes:
        if len(piece) < 64 and len(self) < CACHED_PIECES:
            self[piece] = ids
        return ids


class _Pretokens(_Kept):
    """Ids of pretokens."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenize = tokenizer.model.tokenize
        # Bytes stand for themselves where they print, else for the next character from 256 on.
        printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = [b for b in range(256) if b not in printing]
        codes = {b: 256 + i for i, b in enumerate(others)}
        self.letters = "".join(chr(codes.get(b, b)) for b in range(256))
        self.space = self.letters[0x20]

    def __missing__(self, pretoken: str) -> bytes:
        return self.keep(pretoken, self.merged(pretoken))

    def merged(self, pretoken: str) -> bytes:
        if pretoken.isascii() and pretoken.isprintable():
            spelled = pretoken.replace(" ", self.space)
        else:
            spelled = codecs.charmap_decode(pretoken.encode(), "strict", self.letters)[0]
        return array("I", [token.id for token in self.tokenize(spelled)]).tobytes()


class _Runs(_Kept):
    """Ids of runs without spaces, each split into pretokens when it is met first.

    A run stands for itself after a space, or for itself alone if it begins with a line's end.
    """

    def __init__(self, pretokens: _Pretokens):
        super().__init__()
        import regex

        self.look, self.merged = pretokens.__getitem__, pretokens.merged
        self.split = regex.compile(PRETOKENS).findall

    def __missing__(self, run: str) -> bytes:
        # A word is kept here only, not with the pretokens as well.
        if run.isalpha():
            return self.keep(run, self.merged(f" {run}"))
        if run[-1:] in MARKS and run[:-1].isalpha():
            return self.keep(run, self[run[:-1]] + self.look(run[-1]))
        return self.keep(run, self.literal(run if run[:1] == "\n" else f" {run}"))

    def literal(self, text: str) -> bytes:
        return b"".join(map(self.look, self.split(text)))

    def found(self, run: str) -> bytes:
        """Ids of a match of ``RUNS``."""
        return self[run[1:]] if run[0] == " " and run[1:2] != "\n" else self.literal(run)


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    A text is split into runs without spaces, a run not met before into pretokens, and the
    library's model merges each pretoken it has not met before. Lines of words between single
    spaces are split at these, which gives the same runs. Texts with a special token, or with
    characters on whose class versions of Unicode differ, go through the library's whole pipeline
    instead; results are the same.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pretokens = _Pretokens(self.tokenizer)
        self.runs = _Runs(self.pretokens)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Characters that are settled, and those of them that are no space but " " and line ends.
        self.sure: set[str] = set()
        self.plain: set[str] = set()

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        return [self._encoded(text) for text in texts]

    def _encoded(self, text: str) -> bytes:
        characters = set(text)
        others = characters - self.sure
        if others:
            settled = set(filter(_settled, others))
            self.sure |= settled
            self.plain.update(c for c in settled if c in " \n" or not c.isspace())
            if settled != others:
                return self._whole(text)
        if any(mark in text for mark in self.special):
            return self._whole(text)
        if characters <= self.plain and not (
            "  " in text or " \n" in text or "\n\n" in text or text[-1:] == " "
        ):
            first, *rest = text.replace("\n", " \n").split(" ")
            return self.runs.literal(first) + b"".join(map(self.runs.__getitem__, rest))
        return b"".join(map(self.runs.found, re.findall(RUNS, text)))

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def _settled(character: str) -> bool:
    """Whether it is a letter, a number, a space or none of them since Unicode 3.2."""
    if character in "\x1c\x1d\x1e\x1f\x85\u180e\u200b\ufeff":
        return False
    old = unicodedata.ucd_3_2_0.category(character)
    new = unicodedata.category(character)
    return new != "Cn" and (old == new or not {old[0], new[0]} & set("LNZ"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One for each Python worker: tasks that follow in it find its pretokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def _encoded(batches: Iterable[pa.RecordBatch], path: str | None, end_id: int):
    encoder, part, offset = _encoder(path or tokenizer_path()), TaskContext.get().partitionId(), 0
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            ids = [i + end for i in encoder.encode([t or "" for t in rows["text"].to_pylist()])]
            lengths = np.array([len(i) // 4 for i in ids], np.int64)
            ends = np.cumsum(lengths)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]), pa.int32()), values
            )
            yield pa.RecordBatch.from_arrays(
                [
                    rows["doc_id"],
                    pa.array(np.full(len(ids), part), pa.int32()),
                    pa.array(offset + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int32()),
                    lists,
                ],
                ["doc_id", "part", "part_offset", "n_tokens", "ids"],
            )
            offset += int(lengths.sum())


def write_tokens(
    documents: DataFrame,
    path: str | None = None,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    partitions: int | None = None,
) -> str:
    """Tokenize ``documents`` (doc_id, text) into ORC files below ``path``; return the path.

    ``tokenizer`` is the file of the vocabulary; without it each task looks up the public one.
    The number of files is ``partitions``, or that of the session's shuffles.
    """
    spark = documents.sparkSession
    path = path or shared_folder(spark, "token-ids")
    files = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        documents.select("doc_id", "text")
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    encoded = ordered.mapInArrow(lambda b: _encoded(b, tokenizer, end_id), SCHEMA)
    encoded.write.options(**ORC_OPTIONS).orc(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of some documents; other files, stripes and row groups are skipped."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin(list(doc_ids)))


def offsets(tokens: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before.

    One row for each file passes the window and is broadcast; ``write_tokens`` sets how many.
    """
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("ids_in_part"))
    before = totals.select(
        F.col("part").alias("p"),
        (F.sum("ids_in_part").over(W.orderBy("part")) - F.col("ids_in_part")).alias("ids_before"),
    )
    joined = tokens.join(F.broadcast(before), F.col("part") == F.col("p"))
    return joined.withColumn("start", F.col("ids_before") + F.col("part_offset"))


def _checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        bounds = ids.offsets.to_numpy()
        raw = np.ascontiguousarray(ids.values.to_numpy(), "<u4")
        sums = [zlib.crc32(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["start"],
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(sums, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows read back from the files."""
    placed = offsets(tokens).select("doc_id", "start", "ids")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return placed.mapInArrow(_checksums, schema)


def tokenized(documents: DataFrame, **options) -> DataFrame:
    """Write ``documents`` as token files and return what the files hold, by ``checksums``."""
    path = write_tokens(documents, **options)
    return checksums(read_tokens(documents.sparkSession, path))
