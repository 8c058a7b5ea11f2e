"""Language identification by prediction by partial matching (PPM).

For each language a context tree of lower-case UTF-8 bytes counts which byte follows each
context of up to ``order`` bytes. A text's code length under a language is the sum of
-log2 p(byte | context): with the longest context, p is count / (total + kinds); a byte not
seen there costs an escape, kinds / (total + kinds), and is looked up in the next shorter
context, ending in 256 equal bytes. Counts are frozen after learning, so each code length
is exact and independent of other texts. The language with the shortest code wins; ties go
to the first by code point. ``score`` is its share of the likelihoods of all languages.

The trees are learned from a bounded sample: about ``sample`` documents of each language, and
about ``sample_bytes`` of text in all, an equal part for each language; those with the least hash
of their id, whole texts. The bounds keep the tables that the driver builds and every task holds
small, however long the texts and however many the languages; the counts are summed in Spark.

Cases: null text, or one without a letter, is ``und`` with score 0; without any learnable
document every text is ``und``; rows without lang are not learned from, nor those with null
doc_id, which are not held out either. Repeated rows are predicted each. Extra columns of any
name are ignored, or kept by ``identified``, which gives rows without lang the language found.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import free_name, slices, written

ORDER, SAMPLE, SAMPLE_BYTES = 4, 2000, 64_000_000
UNDETERMINED = "und"
# Bytes of text that a task holds at a time, and bytes that it scores at a time.
SLICE, CHUNK = 2_000_000, 200_000
LETTER = r"\p{L}"


def held_out(doc_id: Column) -> Column:
    """One of four documents, by the crc32 of its id, is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(LETTER), F.lit(False))


def _codes(data: np.ndarray, size: int) -> np.ndarray:
    """For each position the ``size`` bytes that end there, as one number; the first get fewer."""
    codes = np.zeros(len(data), np.uint64)
    for i in range(min(size, len(data))):
        codes[i:] |= data[: len(data) - i].astype(np.uint64) << np.uint64(8 * i)
    return codes


def _counts(batches: Iterable[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Counts of all byte strings of 1 to order + 1 bytes, per language and batch."""
    for rows in (part for batch in batches for part in slices(batch, "text", SLICE)):
        texts = defaultdict(list)
        for lang, text in zip(*(rows[c].to_pylist() for c in ("lang", "text")), strict=True):
            texts[lang].append(text.lower().encode())
        for lang, own in texts.items():
            for size in range(1, order + 2):
                codes = [_codes(np.frombuffer(t, np.uint8), size)[size - 1 :] for t in own]
                values, counts = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(values), pa.string()),
                        pa.array(np.full(len(values), size), pa.int32()),
                        pa.array(values.view(np.int64)),
                        pa.array(counts, pa.int64()),
                    ],
                    ["lang", "size", "gram", "n"],
                )


def learn(
    documents: DataFrame,
    order: int = ORDER,
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Learn from (doc_id, text, lang) of all rows given that have both; see the module."""
    known = documents.select("doc_id", "text", "lang").filter(
        "text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL"
    )
    sizes = known.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.greatest(F.lit(1), F.sum(F.octet_length("text"))).alias("n_bytes"),
    )
    sizes = written(sizes, "language-sizes")
    part = F.lit(float(sample_bytes)) / sizes.agg(F.count(F.lit(1))).scalar()
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"), part / F.col("n_bytes"))
    point = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(2**31)) / 2**31
    chosen = known.join(sizes, "lang").filter(point < share)
    schema = "lang string, size int, gram long, n long"
    counted = chosen.select("lang", "text").mapInArrow(lambda b: _counts(b, order), schema)
    grams = counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(grams["lang"].to_pylist()), key=lambda x: x.encode())
    frame = {c: grams[c].to_numpy() for c in ("size", "gram", "n")}
    which = np.array([languages.index(x) for x in grams["lang"].to_pylist()], int)
    return Model(languages, order, which, frame["size"], frame["gram"].view(np.uint64), frame["n"])


class Model:
    """Frozen trees of all languages as tables of code lengths in bits.

    For each size the byte strings that any language has seen are kept sorted: ``costs`` of
    the last byte given the others, escapes included, and ``escapes`` of leaving the string
    as a context. A string that no language has seen in full costs every language the escape
    from its context, if seen, and then what the next shorter string costs.
    """

    def __init__(self, languages, order, lang, size, gram, n):
        self.languages, self.order = languages, order
        k = len(languages)
        self.grams, self.costs, self.escapes = {}, {}, {}
        counts = {}
        for s in range(1, order + 2):
            mine = size == s
            values, at = np.unique(gram[mine], return_inverse=True)
            table = np.zeros((len(values), k))
            np.add.at(table, (at, lang[mine]), n[mine])
            self.grams[s], counts[s] = values, table
        # What leaving a context costs, by context size; the empty context is the last.
        for s in range(order + 1):
            context = self.grams[s + 1] >> np.uint64(8)
            owner = self.find(s, context) if s else np.zeros(len(context), int)
            rows = len(self.grams[s]) if s else 1
            total, kinds = np.zeros((rows, k)), np.zeros((rows, k))
            np.add.at(total, owner, counts[s + 1])
            np.add.at(kinds, owner, counts[s + 1] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
                seen = np.log2((total + kinds)[owner] / counts[s + 1])
            self.escapes[s] = escape
            shorter = self.cost(s, self.grams[s + 1] & np.uint64(2 ** (8 * s) - 1)) if s else 8.0
            self.costs[s + 1] = np.where(counts[s + 1] > 0, seen, escape[owner] + shorter)

    def find(self, size: int, codes: np.ndarray) -> np.ndarray:
        """Where the byte strings are among those of their size, or -1."""
        grams = self.grams[size]
        if not len(grams):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
        return np.where(grams[at] == codes, at, -1)

    def cost(self, size: int, codes: np.ndarray) -> np.ndarray:
        """Bits of the last byte after the others, for each language."""
        if size == 0:
            return np.full((len(codes), len(self.languages)), 8.0)
        at = self.find(size, codes)
        bits = np.zeros((len(codes), len(self.languages)))
        if len(self.costs[size]):
            bits = self.costs[size][at]
        missed = np.flatnonzero(at < 0)
        if len(missed):
            rest = codes[missed]
            if size == 1:
                escape = self.escapes[0][np.zeros(len(rest), int)]
            else:
                context = self.find(size - 1, rest >> np.uint64(8))
                escape = np.zeros((len(rest), len(self.languages)))
                if len(self.escapes[size - 1]):
                    escape = np.where(context[:, None] >= 0, self.escapes[size - 1][context], 0.0)
            shorter = self.cost(size - 1, rest & np.uint64(2 ** (8 * (size - 1)) - 1))
            bits[missed] = escape + shorter
        return bits

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        raw = [t.lower().encode() for t in texts]
        sizes = np.array([len(r) for r in raw])
        total = np.zeros((len(texts), len(self.languages)))
        data, ends = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes)
        for start in range(0, len(data), CHUNK):
            stop, before = min(start + CHUNK, len(data)), max(0, start - self.order)
            codes = _codes(data[before:stop], self.order + 1)[start - before :]
            place = np.arange(start, stop)
            row = np.searchsorted(ends, place, "right")
            position = place - (ends - sizes)[row]
            # At a text's beginning the context is as long as what precedes.
            for depth in range(self.order + 1):
                at = position == depth if depth < self.order else position >= depth
                here = np.flatnonzero(at)
                own = codes[here] & np.uint64(2 ** (8 * (depth + 1)) - 1)
                bits = self.cost(depth + 1, own)
                for k in range(len(self.languages)):
                    total[:, k] += np.bincount(row[here], bits[:, k], len(raw))
        return total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        lengths = self.lengths(texts)
        best = lengths.argmin(axis=1)
        share = np.exp2(lengths.min(axis=1, keepdims=True) - lengths).sum(axis=1)
        return [self.languages[b] for b in best], 1 / share


def _predicted(
    batches: Iterable[pa.RecordBatch], model: Model, letters: str, added: Sequence[str]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", SLICE):
            names, scores = [UNDETERMINED] * rows.num_rows, np.zeros(rows.num_rows)
            asked = np.flatnonzero(rows[letters].to_numpy(zero_copy_only=False))
            if len(asked) and model.languages:
                texts = rows["text"].take(pa.array(asked)).to_pylist()
                found, scores[asked] = model.predict(texts)
                for i, name in zip(asked, found, strict=True):
                    names[i] = name
            kept = rows.drop_columns([letters])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*kept.schema.names, *added],
            )


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` and last the language found and its score; reads the column text only."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    letters, *added = (free_name(documents, c) for c in ("letters", "lang_pred", "score"))
    schema = documents.select(
        "*", *[F.lit(x).alias(c) for x, c in zip(("", 0.0), added, strict=True)]
    ).schema
    return documents.withColumn(letters, has_letter(F.col("text"))).mapInArrow(
        lambda b: _predicted(b, shared.value, letters, added), schema
    )


def language_of(documents: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of documents (doc_id, text, lang)."""
    model = learn(documents.filter(~held_out(F.col("doc_id"))), order, sample)
    scored = predicted(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )


def identified(documents: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> DataFrame:
    """The documents that have a language, with all their columns; a null lang becomes that found.

    Where no language could be learned, the documents with a letter.
    """
    model = learn(documents.filter(~held_out(F.col("doc_id"))), order, sample)
    if not model.languages:
        return documents.filter(has_letter(F.col("text")))
    scored = predicted(documents, model)
    found = scored.columns[-2]
    kept = scored.filter(F.col(f"`{found}`") != UNDETERMINED)
    kept = kept.withColumn("lang", F.coalesce("lang", F.col(f"`{found}`")))
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])
