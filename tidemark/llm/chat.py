"""Chat formatting of heterogeneous records, chosen by a fingerprint of their schema.

Records come as rows of one turn each, or as JSON texts in many layouts. The
fingerprint of a record is a digest of its sorted nested field paths, an
array's element written ``name[]``; fields that no layout knows do not count.
It selects the declarative mapping of `LAYOUTS` that yields canonical turns, an
array of (role, text).

The template writes a turn as ``### role: text</turn>`` and a line feed. Inside
roles and texts a backslash is doubled, ``#`` becomes ``\\#``, ``</turn>`` becomes
``<\\/turn>``, and in roles ``: `` becomes ``:\\ ``; so no control string occurs
inside, and the steps in reverse give the text back. Spans in code points mark
the assistant's texts for the loss.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN_START = "### "
ROLE_END = ": "
TURN_END = "</turn>\n"
# What is written for what; undone in reverse order.
ESCAPES = [("\\", "\\\\"), ("#", "\\#"), ("</turn>", "<\\/turn>")]
ROLE_ESCAPES = [*ESCAPES, (": ", ":\\ ")]

SPANS = "array<struct<start: int, length: int>>"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Fields:
    """One turn per field: (role, field); a missing or empty second part is left out."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def paths(self) -> list[str]:
        return [name for _, names in self.turns for name in names]


@dataclass(frozen=True)
class Listed:
    """A list of objects with a role and a text, roles renamed where `names` says so."""

    field: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> list[str]:
        return [f"{self.field}[].{self.role}", f"{self.field}[].{self.text}"]


@dataclass(frozen=True)
class Rows:
    """A row per turn."""

    conversation: str
    turn: str
    role: str
    text: str

    @property
    def paths(self) -> list[str]:
        return [self.conversation, self.turn, self.role, self.text]


LAYOUTS: list[Fields | Listed | Rows] = [
    Rows("conv_id", "turn", "role", "text"),
    Listed("messages", "role", "content"),
    Listed("conversations", "from", "value", (("human", "user"), ("gpt", "assistant"))),
    Fields((("user", ("prompt",)), ("assistant", ("response",)))),
    Fields((("user", ("prompt",)), ("assistant", ("completion",)))),
    Fields((("user", ("question",)), ("assistant", ("answer",)))),
    Fields((("user", ("instruction", "input")), ("assistant", ("output",)))),
    Fields((("user", ("instruction",)), ("assistant", ("output",)))),
    Fields((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
]
KNOWN_PATHS = sorted({path for layout in LAYOUTS for path in layout.paths})


def fingerprint(paths: list[str]) -> str:
    return sha256("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(schema: T.StructType) -> list[str]:
    """The known nested field paths of a frame."""
    found = []
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            found += [f"{field.name}[].{name}" for name in kind.elementType.names]
        else:
            found.append(field.name)
    return [path for path in found if path in KNOWN_PATHS]


def record_fingerprint(record: Column) -> Column:
    """The fingerprint of a JSON object; of no path for anything else."""
    fields = F.map_entries(F.from_json(record, "map<string,string>"))

    def paths(field: Column) -> Column:
        items = F.from_json(field["value"], "array<map<string,string>>")
        named = F.concat(field["key"], F.lit("[]."))
        keys = F.flatten(F.transform(items, F.map_keys))
        inner = F.transform(F.array_distinct(keys), lambda k: F.concat(named, k))
        listed = F.ltrim(field["value"]).startswith("[")
        return F.when(listed, F.coalesce(inner, F.array(field["key"]))).otherwise(
            F.array(field["key"])
        )

    every = F.coalesce(F.flatten(F.transform(fields, paths)), F.array().cast("array<string>"))
    ours = F.array(*map(F.lit, KNOWN_PATHS))
    return F.sha2(F.array_join(F.array_sort(F.array_intersect(every, ours)), "\n"), 256)


def _from_record(layout: Fields | Listed, record: Column) -> Column:
    if isinstance(layout, Listed):
        field = F.from_json(record, "map<string,string>")[layout.field]
        listed = F.from_json(field, "array<map<string,string>>")

        def turn(item: Column) -> Column:
            role = F.coalesce(item[layout.role], F.lit(""))
            for name, ours in layout.names:
                role = F.when(item[layout.role] == name, F.lit(ours)).otherwise(role)
            return F.struct(
                role.alias("role"), F.coalesce(item[layout.text], F.lit("")).alias("text")
            )

        return F.coalesce(F.transform(listed, turn), F.array().cast(TURNS)).cast(TURNS)
    fields = F.from_json(record, "map<string,string>")
    turns = []
    for role, names in layout.turns:
        parts = [F.nullif(F.coalesce(fields[n], F.lit("")), F.lit("")) for n in names[1:]]
        text = F.concat_ws("\n\n", F.coalesce(fields[names[0]], F.lit("")), *parts)
        turns.append(F.struct(F.lit(role).alias("role"), text.alias("text")))
    return F.array(*turns).cast(TURNS)


def record_turns(records: DataFrame, record: str) -> DataFrame:
    """Adds ``fingerprint`` and ``turns`` to rows with a JSON text in the column `record`.

    Null texts and roles are empty. ``turns`` is null where no layout has the
    fingerprint: a record that is null, no object, or of an unknown layout.
    """
    chosen = F.lit(None).cast(TURNS)
    for layout in LAYOUTS:
        if not isinstance(layout, Rows):
            chosen = F.when(
                F.col("fingerprint") == fingerprint(layout.paths),
                _from_record(layout, F.col(record)),
            ).otherwise(chosen)
    return records.withColumn("fingerprint", record_fingerprint(F.col(record))).withColumn(
        "turns", chosen
    )


def row_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, turns`` from rows of a turn each, whose fingerprint picks the mapping.

    Turns are ordered by number, then role and text; null numbers come first,
    null roles and texts are empty, a null id is a conversation, repeated rows
    are turns. A conversation becomes one row, so it has to fit one.
    """
    own = fingerprint(schema_paths(rows.schema))
    layout = next(
        (x for x in LAYOUTS if isinstance(x, Rows) and fingerprint(x.paths) == own), None
    )
    if layout is None:
        raise ValueError("no layout of rows has these columns")
    turn = F.struct(
        F.col(layout.turn).alias("turn"),
        F.coalesce(layout.role, F.lit("")).alias("role"),
        F.coalesce(layout.text, F.lit("")).alias("text"),
    )
    listed = F.sort_array(F.collect_list(turn))
    return (
        rows.groupBy(F.col(layout.conversation).alias("conv_id"))
        .agg(listed.alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: t.dropFields("turn")).alias("turns"))
    )


def escaped(text: Column, steps: list[tuple[str, str]] = ESCAPES) -> Column:
    return reduce(lambda t, step: F.replace(t, F.lit(step[0]), F.lit(step[1])), steps, text)


def unescaped(text: Column, steps: list[tuple[str, str]] = ESCAPES) -> Column:
    return reduce(lambda t, step: F.replace(t, F.lit(step[1]), F.lit(step[0])), steps[::-1], text)


def formatted(conversations: DataFrame, learned: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss``, an array of (start, length), to rows with ``turns``.

    A null array of turns has null results.
    """
    written = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(
                F.lit(TURN_START), escaped(t["role"], ROLE_ESCAPES), F.lit(ROLE_END)
            ).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == learned).alias("learned"),
        ),
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        size = F.length(t["body"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct(
            (start + size + len(TURN_END)).alias("at"),
            F.when(t["learned"], F.concat(state["spans"], span))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    joined = F.array_join(
        F.transform("_written", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END))), ""
    )
    return (
        conversations.withColumn("_written", written)
        .withColumn("formatted", joined)
        .withColumn("loss", F.aggregate("_written", begin, add, lambda state: state["spans"]))
        .drop("_written")
    )


def read_back(text: Column) -> Column:
    """The turns of a formatted conversation."""
    parts = F.split(text, TURN_END, -1)
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        cut = F.instr(part, ROLE_END)
        role = F.substring(part, F.lit(len(TURN_START) + 1), cut - len(TURN_START) - 1)
        body = F.substring(part, cut + len(ROLE_END), F.length(part))
        return F.struct(
            unescaped(role, ROLE_ESCAPES).alias("role"), unescaped(body).alias("text")
        )

    return F.transform(parts, turn)


def under_loss(text: Column, spans: Column) -> Column:
    """The texts that the spans mark, unescaped."""
    return F.transform(
        spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))
    )
