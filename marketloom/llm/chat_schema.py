"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record is a VARIANT of any layout. Its fingerprint is the hash of its nested field paths,
written as its schema without types, so nulls and numbers for strings do not change it.
The fingerprint selects one of the declared layouts, which says where turns, roles and texts
are; all become canonical (turn, role, text). A conversation is then written as

    <|role|>text<|end|><|role|>text<|end|>...

with ``\\`` before every ``\\`` and ``<`` of a text, and also before every ``|`` of a role. An
unescaped ``<`` or ``|`` is thus always the template's, and ``parsed`` restores every text.

Cases: null texts and roles are empty; an empty list of messages has no turns; a null record
or one of an unknown layout has layout null and no turns, and is not dropped: a conversation
without turns is an empty string, and ``unread`` lists its unknown fingerprints. Turns that
share a number are ordered by record position, role and text; null numbers come first.
Repeated rows are repeated turns. Rows with a null conv_id form one conversation. An empty
table gives no conversations. Other columns are ignored.
A conversation is one string and therefore one task's work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURNS = "array<struct<turn:bigint,role:string,text:string>>"
LOSS_ROLE = "assistant"
# A schema text names a type after each field; what remains without types are the paths.
SCALAR_TYPES = (
    r"(?:VOID|STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|DATE|TIMESTAMP(?:_NTZ)?|BINARY|VARIANT|UUID"
    r"|DECIMAL\([0-9]+,\s?[0-9]+\))"
)


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``paths`` are its nested field paths, fields in alphabetical order. Either ``items`` names
    a list with the fields ``role`` and ``text``, or ``parts`` lists (role, fields): one turn each, the fields
    that hold text joined by an empty line, and no turn where all are missing. A layout of
    single turns has neither; ``role``, ``text`` and ``turn`` are its fields.
    """

    name: str
    paths: str
    items: str | None = None
    role: str = "role"
    text: str = "content"
    turn: str | None = None
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: Mapping[str, str] = field(default_factory=dict)

    def turns(self, record: Column) -> Column:
        if self.items:
            shape = f"array<struct<`{self.role}`:string,`{self.text}`:string>>"
            items = F.try_variant_get(record, f"$.{self.items}", shape)
            found = F.transform(
                items,
                lambda x, i: F.struct(
                    i.cast("long").alias("turn"),
                    self._role(x[self.role]).alias("role"),
                    x[self.text].alias("text"),
                ),
            )
        elif self.parts:
            made = [
                F.struct(
                    F.lit(i).cast("long").alias("turn"),
                    F.lit(role).alias("role"),
                    F.concat_ws(
                        "\n\n",
                        *[F.nullif(self._text(record, name), F.lit("")) for name in names],
                    ).alias("text"),
                )
                for i, (role, names) in enumerate(self.parts)
            ]
            optional = self.parts[0][0] == "system"
            found = F.filter(
                F.array(*made), lambda t: (t["role"] != "system") | (t["text"] != "")
            ) if optional else F.array(*made)
        else:
            found = F.array(
                F.struct(
                    F.try_variant_get(record, f"$.{self.turn}", "bigint").alias("turn"),
                    self._role(self._text(record, self.role)).alias("role"),
                    self._text(record, self.text).alias("text"),
                )
            )
        return found.cast(TURNS)

    def _text(self, record: Column, name: str) -> Column:
        return F.try_variant_get(record, f"$.{name}", "string")

    def _role(self, role: Column) -> Column:
        if not self.roles:
            return role
        known = F.create_map(*[F.lit(x) for pair in self.roles.items() for x in pair])
        return F.coalesce(F.try_element_at(known, role), role)


SHARED = {"human": "user", "gpt": "assistant"}
LAYOUTS = (
    Layout("turn row", "OBJECT<role, text, turn>", text="text", turn="turn"),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", items="messages"),
    Layout("no messages", "OBJECT<messages: ARRAY<>>", items="messages"),
    Layout(
        "conversations",
        "OBJECT<conversations: ARRAY<OBJECT<from, value>>>",
        items="conversations",
        role="from",
        text="value",
        roles=SHARED,
    ),
    Layout(
        "prompt and completion",
        "OBJECT<completion, prompt>",
        parts=(("user", ("prompt",)), ("assistant", ("completion",))),
    ),
    Layout(
        "prompt and response",
        "OBJECT<prompt, response>",
        parts=(("user", ("prompt",)), ("assistant", ("response",))),
    ),
    Layout(
        "system, prompt and response",
        "OBJECT<prompt, response, system>",
        parts=(
            ("system", ("system",)),
            ("user", ("prompt",)),
            ("assistant", ("response",)),
        ),
    ),
    Layout(
        "instruction",
        "OBJECT<input, instruction, output>",
        parts=(("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Layout(
        "instruction alone",
        "OBJECT<instruction, output>",
        parts=(("user", ("instruction",)), ("assistant", ("output",))),
    ),
)


def paths(record: Column) -> Column:
    """The nested field paths of a record: its schema without types."""
    schema = F.schema_of_variant(record)
    bare = F.regexp_replace(schema, rf": {SCALAR_TYPES}(?=[,>]|$)", "")
    return F.regexp_replace(bare, rf"ARRAY<{SCALAR_TYPES}>", "ARRAY<>")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(paths(record))


def canonical_turns(
    records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS
) -> DataFrame:
    """Add ``layout`` (null if none is declared for the fingerprint) and ``turns``."""
    mark, value = F.col("__fingerprint"), F.col(f"`{record}`")
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        chosen = mark == F.xxhash64(F.lit(layout.paths))
        name = F.when(chosen, layout.name).otherwise(name)
        turns = F.when(chosen, layout.turns(value)).otherwise(turns)
    marked = records.withColumn("__fingerprint", F.when(value.isNotNull(), fingerprint(value)))
    return marked.withColumns({"layout": name, "turns": turns}).drop("__fingerprint")


def escaped(text: Column, also: str = "") -> Column:
    for mark in ("\\", "<", *also):
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, layout, unread) of rows (conv_id, turn, position, role,
    text, layout, unread); a row without position holds no turn and adds no text.

    ``loss_spans`` are the code points, end exclusive, of the assistant's texts. Where a turn
    begins is a running sum over its conversation, before anything is collected.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    keys = ["turn", "position", "role", "text"]
    head = F.concat(F.lit("<|"), escaped(role, "|"), F.lit("|>"))
    held = F.col("position").isNotNull()
    pieces = turns.select(
        "conv_id",
        *keys,
        "layout",
        "unread",
        F.when(held, head).otherwise("").alias("head"),
        F.when(held, escaped(text)).otherwise("").alias("body"),
        F.when(held, F.lit("<|end|>")).otherwise("").alias("tail"),
    ).withColumn("size", F.length("head") + F.length("body") + F.length("tail"))
    ahead = W.partitionBy("conv_id").orderBy(*keys)
    before = F.coalesce(
        F.sum("size").over(ahead.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    number = F.row_number().over(ahead)
    placed = pieces.withColumns({"number": number, "begin": before + F.length("head")})
    piece = F.struct(
        "number",
        F.concat("head", "body", "tail").alias("piece"),
        (F.col("role") == LOSS_ROLE).alias("masked"),
        F.col("begin").alias("start"),
        (F.col("begin") + F.length("body")).alias("end"),
    )
    ordered = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(piece)).alias("p"),
        F.min("layout").alias("layout"),
        F.array_sort(F.collect_set("unread")).alias("unread"),
    )
    spans = F.transform(
        F.filter("p", lambda x: x["masked"]),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")),
    )
    return ordered.select(
        "conv_id",
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        "layout",
        "unread",
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    turn = r"(?s)<\|((?:[^\\|]++|\\.)*+)\|>((?:[^\\<]++|\\.)*+)<\|end\|>"
    roles, texts = (F.regexp_extract_all(text, F.lit(turn), F.lit(i)) for i in (1, 2))
    return F.zip_with(
        roles,
        texts,
        lambda r, t: F.struct(unescaped(r).alias("role"), unescaped(t).alias("text")),
    )


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    under = F.transform(
        spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))
    )
    return F.array_join(under, "")


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from nothing but the formatted output."""
    whole = F.transform(
        F.col("t"), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))
    )
    read = conversations.withColumns(
        {
            "t": parsed(F.col("formatted")),
            "loss": loss_text(F.col("formatted"), F.col("loss_spans")),
        }
    )
    return read.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(whole, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def chat(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Format rows (conv_id, record) of any declared layouts, one string per conversation.

    Records of one conversation, such as rows of single turns, are put together; ``layout`` is
    the first by name of those read, null if none was. ``unread`` has the fingerprints of others.
    """
    turns = canonical_turns(records.select("conv_id", "record"), layouts=layouts)
    unread = F.when(
        F.col("layout").isNull() & F.col("record").isNotNull(), fingerprint(F.col("record"))
    )
    each = turns.select(
        "conv_id",
        "layout",
        unread.alias("unread"),
        F.posexplode_outer("turns").alias("position", "t"),
    )
    return formatted(
        each.select("conv_id", "position", "t.turn", "t.role", "t.text", "layout", "unread")
    )


def turn_records(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as records of single turns."""
    record = F.to_variant_object(
        F.struct(
            F.col("role").cast("string").alias("role"),
            F.col("text").cast("string").alias("text"),
            F.col("turn").cast("long").alias("turn"),
        )
    )
    return conversations.select(F.col("conv_id").cast("long"), record.alias("record"))
