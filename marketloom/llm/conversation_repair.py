"""Repair of the turn structure of conversations, with an audit of every edit.

Rows are taken by turn (nulls first); equal turns by role, then by the first characters of their
texts, then by a digest of them. The first fault of a row counts:

* blank: no character but spaces;
* duplicate: its role and text stood in an earlier row;
* truncated: the last character that is no space is none of ``.!?``.

Every row is kept (K, cost 0), given the role user or assistant (R, 2) or deleted (D, 3); blank and
duplicate rows must be deleted; an empty turn of a user or an assistant may be inserted anywhere
(I, 2); a truncated row that stays costs 1 more. The result reads ``(s?(ua)+)?`` in initials of roles.
Of the cheapest edits the audit with the least letters in ASCII order is taken.

The method is a forward search over rows and the four states of the pattern. The prefixes of
edits of all states share their nodes: a node holds its letter, a rolling hash of the prefix and
its ancestors at the powers of two that divide its depth. Equal costs are decided by the longest
common prefix of two nodes, found in ancestors by their hashes; equal hashes count as
equal prefixes only after a comparison. Given the state, a letter decides the edit, so one of two
equally cheap prefixes of a state never begins the other, and the least prefix stays the least.

Only initials, faults and digests pass the search; texts are shuffled once, behind their
conversation's audit, and hashed as they stream by. One conversation is one audit and one digest, so
it is one task's work, whatever its length, but its texts are never held together.

Cases: a null role or text is one space; a null conv_id is one conversation; a conversation
without rows has zeros, an empty audit and the digest of the empty string; a role that begins
with neither s, u nor a cannot be kept; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANK, DUPLICATE, CUT = 1, 2, 3
# Code points of a text that decide between rows of equal turn and role before its digest does.
TIE_CHARS = 32
NONE, SYSTEM, USER, ASSISTANT = range(4)
# The state after an inserted turn; a kept row needs a state that its initial may follow.
AFTER_INSERT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {
    "s": {NONE: SYSTEM},
    "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Prefixes:
    """Strings that share their beginnings: a node is its parent's string and one letter."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letter, self.depth, self.hash = bytearray(b"\0"), array("q", [0]), array("q", [0])
        # Ancestors 1, 2, 4 ... letters up, as far as the distance divides the depth.
        self.first, self.ancestors = array("q", [0]), array("q")

    def add(self, node: int, letter: str) -> int:
        depth = self.depth[node] + 1
        self.letter.append(ord(letter))
        self.depth.append(depth)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % self.modulus)
        self.first.append(len(self.ancestors))
        up, distance = node, 1
        self.ancestors.append(up)
        while depth % (2 * distance) == 0:
            up = self._up(up, distance)
            distance *= 2
            self.ancestors.append(up)
        return len(self.letter) - 1

    def _up(self, node: int, distance: int) -> int:
        """The ancestor a power of two up; the distance divides the node's depth."""
        return self.ancestors[self.first[node] + distance.bit_length() - 1]

    def at(self, node: int, depth: int) -> int:
        """The prefix of that length."""
        while (here := self.depth[node]) > depth:
            most = 1 << ((here - depth).bit_length() - 1)
            node = self._up(node, min(here & -here, most))
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth hold one string; equal hashes are verified."""
        if x == y or self.hash[x] != self.hash[y]:
            return x == y
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self._up(x, 1), self._up(y, 1)
        return True

    def common(self, x: int, y: int) -> int:
        """The length of the longest common prefix."""
        depth = min(self.depth[x], self.depth[y])
        x, y = self.at(x, depth), self.at(y, depth)
        if self.same(x, y):
            return depth
        step = depth & -depth
        # Up in growing steps while the strings differ, then down in shrinking ones.
        while not self.same(a := self._up(x, step), b := self._up(y, step)):
            x, y, depth = a, b, depth - step
            step = depth & -depth
        while step > 1:
            step //= 2
            a, b = self._up(x, step), self._up(y, step)
            if not self.same(a, b):
                x, y, depth = a, b, depth - step
        return depth - 1

    def less(self, x: int, after_x: str, y: int, after_y: str) -> bool:
        """Whether x and its next letters come before y and its next letters."""
        if x == y:
            return after_x < after_y
        length = self.common(x, y)
        one, two = (
            chr(self.letter[self.at(node, length + 1)]) if self.depth[node] > length else after
            for node, after in ((x, after_x), (y, after_y))
        )
        if one == two:
            return self.depth[x] + len(after_x) < self.depth[y] + len(after_y)
        return one < two

    def text(self, node: int) -> str:
        letters = bytearray()
        while self.depth[node]:
            letters.append(self.letter[node])
            node = self._up(node, 1)
        return letters[::-1].decode()


class Audit:
    """The cheapest edits of the rows seen so far, by the state that they end in."""

    def __init__(self, modulus: int = MODULUS):
        self.prefixes = Prefixes(modulus)
        self.best: dict[int, tuple[int, int]] = {NONE: (0, 0)}
        self._insert()

    def _offer(self, offers: dict, state: int, cost: int, node: int, letter: str) -> None:
        held = offers.get(state)
        if (
            held is None
            or cost < held[0]
            or (cost == held[0] and self.prefixes.less(node, letter, held[1], held[2]))
        ):
            offers[state] = (cost, node, letter)

    def _made(self, offer: tuple) -> tuple[int, int]:
        cost, node, letter = offer
        return cost, self.prefixes.add(node, letter) if letter else node

    def _insert(self) -> None:
        """Reach states by inserted turns; the cheapest states are final first."""
        offers = {state: (*held, "") for state, held in self.best.items()}
        final: dict[int, tuple[int, int]] = {}
        while len(final) < len(offers):
            state = min((s for s in offers if s not in final), key=lambda s: offers[s][0])
            cost, node = final[state] = self._made(offers[state])
            if AFTER_INSERT[state] not in final:
                self._offer(offers, AFTER_INSERT[state], cost + INSERT, node, "I")
        self.best = final

    def row(self, initial: str, fault: int) -> None:
        offers: dict[int, tuple[int, int, str]] = {}
        extra = TRUNCATED if fault == CUT else 0
        kept = KEPT.get(initial, {})
        for state, (cost, node) in self.best.items():
            self._offer(offers, state, cost + DELETE, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            if state in kept:
                self._offer(offers, kept[state], cost + extra, node, "K")
            self._offer(offers, AFTER_INSERT[state], cost + REROLE + extra, node, "R")
        self.best = {state: self._made(offer) for state, offer in offers.items()}
        self._insert()

    def result(self) -> tuple[int, str]:
        ends = {}
        for state in (NONE, ASSISTANT):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(ends, 0, cost, node, "")
        cost, node, _ = ends[0]
        return cost, self.prefixes.text(node)


def _spaces(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, dropped): rows damaged by the checksum of their place."""
    place = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    )
    kind = F.crc32(place.cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _spaces("role").alias("_role"),
        _spaces("text").alias("_text"),
        kind.alias("_kind"),
    )
    kind = F.col("_kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("_text", "[.!?]", ""))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("_role")).alias("role"),
        text.otherwise(F.col("_text")).alias("text"),
        F.explode(F.sequence(F.lit(0), F.when(kind == 3, 1).otherwise(0))).alias("copy"),
        (kind == 0).alias("dropped"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """Add ``start`` and ``digest``, by which rows of equal turn and role are ordered."""
    return rows.withColumns(
        {
            "start": F.substring("text", 1, TIE_CHARS),
            "digest": F.unhex(F.sha2(F.concat(F.col("role"), F.lit(":"), F.col("text")), 256)),
        }
    )


FIELDS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), *map(F.col, ("role", "start", "digest", "copy"))]


def _narrow(rows: DataFrame) -> DataFrame:
    """What the search needs of each row: no text. Sorted by conversation and place."""
    last = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    narrow = placed(rows).select(
        "conv_id",
        "turn",
        "role",
        "start",
        "digest",
        "copy",
        "dropped",
        F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(0).alias("_own"),
    )
    # One shuffle: equal rows of a conversation are in its partition.
    earlier = F.row_number().over(
        W.partitionBy("conv_id", "digest").orderBy("dropped", *_order())
    )
    fault = F.when((F.col("_own") != BLANK) & (earlier > 1), DUPLICATE).otherwise(F.col("_own"))
    return (
        narrow.repartition("conv_id")
        .withColumn("fault", fault)
        .sortWithinPartitions("conv_id", *_order())
        .select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "dropped")
    )


class _Conversation:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.audit = conv_id, Audit()
        self.faults = [0, 0, 0, 0]
        self.least = self.turn = None
        self.turns = self.illegal = 0
        self.initial: str | None = None

    def row(self, turn: int | None, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.audit.row(initial, fault)

    def result(self) -> tuple:
        gaps = 0 if self.turn is None else self.turn - self.least + 1 - self.turns
        return self.conv_id, gaps, *self.faults[1:], self.illegal, *self.audit.result()


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = [*(field.split()[0] for field in FIELDS.split(", ")), "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
    return pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])


def _audited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        for conv_id, turn, initial, fault, dropped in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv_id)
            if not dropped:
                now.row(turn, initial, fault)
        if done:
            yield _table(done)
            done = []
    if now is not None:
        yield _table([now.result()])


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation."""
    return _narrow(rows).mapInArrow(_audited, FIELDS)


class _Rebuilt:
    """The repaired text of one conversation: its edits, applied to the rows as they come."""

    def __init__(self, row: tuple):
        self.row, self.edits, self.at = row, row[-1], 0
        self.state, self.digest, self.empty = NONE, hashlib.sha256(), True

    def _turn(self, role: str, text: str) -> None:
        line = f"{role}:{text}" if self.empty else f"\n{role}:{text}"
        self.digest.update(line.encode())
        self.empty = False

    def inserts(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self.state = AFTER_INSERT[self.state]
            self._turn("user" if self.state == USER else "assistant", "")
            self.at += 1

    def take(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[role[0]][self.state]
        elif edit == "R":
            self.state = AFTER_INSERT[self.state]
            role = "user" if self.state == USER else "assistant"
        if edit != "D":
            self._turn(role, text)

    def result(self) -> tuple:
        self.inserts()
        return *self.row, self.digest.hexdigest()


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = dict(zip(names, values, strict=True))
            if row["audit"] is not None:
                if now is not None:
                    done.append(now.result())
                now = _Rebuilt(values[:8])
            else:
                now.take(row["role"], row["text"])
        if done:
            yield _table(done)
            done = []
    if now is not None:
        yield _table([now.result()])


def repaired(rows: DataFrame) -> DataFrame:
    """``audits`` of rows (conv_id, turn, role, text, copy, dropped), with ``repaired_sha256``."""
    heads = audits(rows)
    texts = placed(rows.filter(~F.col("dropped")))
    both = heads.withColumn("_first", F.lit(0)).unionByName(
        texts.drop("dropped").withColumn("_first", F.lit(1)), allowMissingColumns=True
    )
    streamed = (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", "_first", *_order())
        .select(*heads.columns, "role", "text")
    )
    return streamed.mapInArrow(_repaired, f"{FIELDS}, repaired_sha256 string")
