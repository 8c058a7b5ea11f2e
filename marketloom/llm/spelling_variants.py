"""Spelling variants: words one edit apart, and the frequent form that each of them leads to.

Words are counted over all documents, then arranged by how often letters of each of ``GROUPS``
groups occur in them. One inserted, deleted or replaced code point raises one of these counts by one
at most and lowers one by one at most. A trie holds the count vectors, one group a level; a
depth-first search walks it with whole blocks of words, spends a surplus and a deficit of one
each, and compares the words of the leaves it reaches, code point by code point.

The trie is split where it is shallow: a shard holds the words of one length that agree in the
first counts, and every word visits the shards that its budget reaches. The number of these counts
grows with the vocabulary. A shard that still holds more than ``SHARD_WORDS`` is searched in
blocks, each of its words against each block of visitors, so that no task holds it whole.
Every pair of near words meets in one task, once: the shorter or lesser word visits.

Forms double in frequency at least, so chains of forms are short; roots are found by jumping
along them, twice as far each round.

Cases: null text has no words; a null doc_id is spelled as nothing in the checksum; words of any
length are kept whole; repeated rows count each; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import written

LETTERS = "A-Za-zÀ-ÿ"
LEAST_CHARS, LEAST_COUNT, DAMAGE = 5, 3, 97
GROUPS, MOST_PREFIX = 12, 4
SHARD_WORDS, VISITORS = 48_000, 192_000
# Pairs of words whose code points are compared at a time, and words that walk the trie together.
COMPARED, BLOCK = 200_000, 32_768

GROUP_OF = np.arange(256) % GROUPS


def words(documents: DataFrame) -> DataFrame:
    """(word, n): damaged runs of letters with their numbers of occurrences.

    Runs are lower-cased in A-Z only; a checksum of document and run decides which ones lose
    a code point.
    """
    runs = F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(f"([{LETTERS}]{{{LEAST_CHARS},}})"), F.lit(1)
    )
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    each = documents.select("doc_id", F.explode(runs).alias("_run")).select(
        "doc_id", F.translate("_run", upper, upper.lower()).alias("_run")
    )
    place = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("_run"))
    each = each.withColumn("_h", F.crc32(place.cast("binary")))
    at = F.pmod("_h", F.length("_run")).cast("int")
    cut = F.concat(
        F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run"))
    )
    word = F.when(F.col("_h") % DAMAGE == 0, cut).otherwise(F.col("_run"))
    counted = each.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.length("word") >= LEAST_CHARS) & (F.col("n") >= LEAST_COUNT))


def _count(group: int) -> Column:
    """How many letters of a group a word has."""
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100)) if c % GROUPS == group]
    return F.length("word") - F.length(F.translate("word", "".join(letters), ""))


def _key(prefix: int, deltas: tuple[int, ...] | None = None) -> Column:
    """The shard of a word, or the one that lies as far away as ``deltas`` say."""
    deltas = deltas or (0,) * (prefix + 1)
    parts = [F.col("_length"), *[F.col(f"_count{g}") for g in range(prefix)]]
    return F.concat_ws(",", *[(p + d).cast("string") for p, d in zip(parts, deltas, strict=True)])


def reachable(prefix: int) -> list[tuple[int, ...]]:
    """Differences in length and first counts of a word that is one edit away and not shorter."""
    found = []
    for counts in product((-1, 0, 1), repeat=prefix):
        surplus, deficit = counts.count(1), counts.count(-1)
        if surplus <= 1 and deficit <= 1:
            # The rest of the budget may be spent on other groups.
            found += [(length, *counts) for length in (0, 1) if length <= 1 - deficit]
    return found


class Trie:
    """Count vectors of one shard's words, a group a level."""

    def __init__(self, vectors: np.ndarray):
        order = np.lexsort(vectors.T[::-1])
        self.base = int(vectors.max(initial=0)) + 3
        self.children: list[np.ndarray] = []
        node = np.zeros(len(vectors), np.int64)
        for level in range(vectors.shape[1]):
            keys, node = np.unique(node * self.base + vectors[:, level] + 1, return_inverse=True)
            self.children.append(keys)
        self.members = order
        leaves = node[order]
        self.starts = np.searchsorted(leaves, np.arange(leaves.max(initial=-1) + 2))

    def search(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(vector, leaf) pairs within a surplus and a deficit of one, in blocks, depth first."""
        none = np.zeros(len(vectors), np.int64)
        stack = [(0, np.arange(len(vectors)), none, none, none)]
        while stack:
            level, who, node, surplus, deficit = stack.pop()
            if level == len(self.children):
                yield who, node
                continue
            keys = self.children[level]
            for delta in (-1, 0, 1):
                more, less = surplus + (delta == 1), deficit + (delta == -1)
                wanted = node * self.base + vectors[who, level] + delta + 1
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                there = (keys[at] == wanted) & (more <= 1) & (less <= 1)
                if there.any():
                    stack.append((level + 1, who[there], at[there], more[there], less[there]))


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Count vectors of words of one length, given as rows of code points."""
    n = len(codes)
    cells = np.arange(n)[:, None] * GROUPS + GROUP_OF[codes]
    return np.bincount(cells.ravel(), minlength=n * GROUPS).reshape(n, GROUPS)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one code point that is replaced, or added in ``long``."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    width = short.shape[1]
    differ = np.hstack([short != long[:, :-1], np.ones((len(short), 1), bool)])
    shifted = np.hstack([np.ones((len(short), 1), bool), short != long[:, 1:]])
    return differ.argmax(axis=1) >= width - shifted[:, ::-1].argmax(axis=1)


def _codes(values: list[str]) -> np.ndarray:
    joined = "".join(values).encode("latin-1")
    return np.frombuffer(joined, np.uint8).reshape(len(values), -1)


def near_pairs(members: list[str], visitors: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes (visitor, member) of near words; members have one length, visitors one length."""
    theirs, ours = _codes(visitors), _codes(members)
    trie, counts = Trie(letter_counts(ours)), letter_counts(theirs)
    for start in range(0, len(visitors), BLOCK):
        for who, leaf in trie.search(counts[start : start + BLOCK]):
            sizes = trie.starts[leaf + 1] - trie.starts[leaf]
            ends = np.cumsum(sizes)
            for low in range(0, int(ends[-1]), COMPARED):
                pair = np.arange(low, min(low + COMPARED, int(ends[-1])))
                row = np.searchsorted(ends, pair, side="right")
                inside = pair - (ends[row] - sizes[row])
                member = trie.members[trie.starts[leaf[row]] + inside]
                visitor = who[row] + start
                near = one_edit(theirs[visitor], ours[member])
                yield visitor[near], member[near]


PAIR = "word string, near string, near_n long"


def _searched(table: pa.Table) -> pa.Table:
    """Near pairs, both ways, of a block of a shard and a block of its visitors."""
    values, n = table["word"].to_pylist(), table["n"].to_pylist()
    visits = table["visits"].to_pylist()
    members = [i for i, visit in enumerate(visits) if not visit]
    found: list[tuple] = []
    by_length: dict[int, list[int]] = {}
    for i, visit in enumerate(visits):
        if visit:
            by_length.setdefault(len(values[i]), []).append(i)
    for visitors in by_length.values() if members else ():
        ours, theirs = [values[i] for i in members], [values[i] for i in visitors]
        for x, y in near_pairs(ours, theirs):
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                one, two = visitors[i], members[j]
                if len(values[one]) < len(values[two]) or values[one] < values[two]:
                    found.append((values[one], values[two], n[two]))
                    found.append((values[two], values[one], n[one]))
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    kinds = [pa.string(), pa.string(), pa.int64()]
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "near", "near_n"]
    )


def _largest(placed: DataFrame, prefix: int) -> int:
    sizes = placed.groupBy(_key(prefix).alias("shard")).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]


def near_words(
    counted: DataFrame, shard_words: int = SHARD_WORDS, visitors: int = VISITORS
) -> DataFrame:
    """(word, near, near_n): every word with every word one edit away."""
    counts = {f"_count{g}": _count(g) for g in range(MOST_PREFIX)}
    placed = counted.withColumn("_length", F.length("word")).withColumns(counts)
    prefix = next(
        (p for p in range(1, MOST_PREFIX) if _largest(placed, p) <= shard_words), MOST_PREFIX
    )
    members = placed.select("word", "n", _key(prefix).alias("shard"))
    shards = F.array(*[_key(prefix, deltas) for deltas in reachable(prefix)])
    visiting = placed.select("word", "n", F.explode(shards).alias("shard"))
    held = members.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    visits = visiting.groupBy("shard").agg(F.count(F.lit(1)).alias("visits"))
    blocks = held.join(visits, "shard").select(
        "shard",
        F.ceil(F.col("held") / shard_words).cast("int").alias("a_blocks"),
        F.ceil(F.col("visits") / visitors).cast("int").alias("b_blocks"),
    )

    def dealt(rows: DataFrame, own: str, other: str, visit: bool) -> DataFrame:
        """A row goes to one block of its side, once for each block of the other side."""
        block = F.pmod(F.xxhash64("word"), F.col(f"{own}_blocks")).alias(own)
        copies = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(other)
        return rows.join(blocks, "shard").select(
            "word", "n", F.lit(visit).alias("visits"), "shard", block.cast("int"), copies
        )

    both = dealt(members, "a", "b", False).unionByName(dealt(visiting, "b", "a", True))
    return both.groupBy("shard", "a", "b").applyInArrow(_searched, PAIR)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): where each chain of forms ends."""
    reached = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = reached.join(further, "root", "left")
        moved = joined.select(
            "word",
            F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("_moved"),
        )
        moved = written(moved, "variant-roots")
        if moved.filter("_moved").isEmpty():
            return moved.select("word", "root")
        reached = moved.select("word", "root")


def variants(documents: DataFrame, **options) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the documents."""
    counted = written(words(documents), "variant-words")
    best = near_words(counted, **options).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    frequent = -F.col("best.less") >= 2 * F.col("n")
    formed = counted.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    formed = written(formed, "variant-forms")
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
