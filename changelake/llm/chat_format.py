"""Chat formatting: records of any layout become turns, and turns one text with a loss mask.

1. *Fingerprints.*  A record (JSON) is walked once; the set of its nested field paths, such
   as ``messages/*/role``, is hashed.  The fingerprint selects a *layout*: a declaration of
   where roles and texts lie.  A fingerprint seen for the first time in a task is matched to
   the layout whose paths it has all (the one that asks for most, then the first declared)
   and remembered, so extra fields do no harm.  Prompt, instruction, message and row layouts
   are declared below; further ones are data, not code.
2. *Turns.*  The layout gives canonical turns: role, text, position.
3. *Text.*  Turns of a conversation, brought together and in order, are written between the
   template's marks.  A mark inside a text gets a backslash behind its first character (one
   more where it has some already), which is undone on reading, so no text can end a turn.
   The mask holds the places of the assistants' texts, without marks.

A conversation is one text and goes through one task in order, a turn at a time; it is given
out in parts of about ``PART_CHARS`` characters, so that neither a task nor a row holds a long
one as a whole.

Defined results: null records, malformed JSON and unknown layouts give one row without layout
and turn, and no conversation; null texts and roles are empty; a record without turns gives a
conversation without turns; null keys are one conversation; turns of equal order come by role
and text, and repeated rows stay; an empty table gives an empty result; only the named columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa

from changelake.llm.shipping import ship
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_CHARS = 1 << 20
REMEMBERED = 4096  # fingerprints of a task


@dataclass(frozen=True)
class Each:
    """A turn for each member of a list."""

    items: str
    role: str
    text: str


@dataclass(frozen=True)
class Said:
    """One turn of a fixed role; several paths are joined by an empty line, empty ones left out."""

    role: str
    texts: tuple[str, ...]
    optional: bool = False  # no turn where all texts are empty


@dataclass(frozen=True)
class Row:
    """The record is a turn itself."""

    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    name: str
    needs: tuple[str, ...]
    turns: tuple[Each | Said | Row, ...]
    roles: tuple[tuple[str, str], ...] = ()


# Other names of the roles.
OTHER_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))

# The common layouts of instruction and chat data.
LAYOUTS = (
    Layout("row", ("role", "text"), (Row("role", "text"),)),
    Layout("messages", ("messages/*/role", "messages/*/content"), (Each("messages", "role", "content"),), OTHER_ROLES),
    Layout("message_parts", ("messages/*/role", "messages/*/content/*/text"), (Each("messages", "role", "content/*/text"),), OTHER_ROLES),
    Layout("from_value", ("conversations/*/from", "conversations/*/value"), (Each("conversations", "from", "value"),), OTHER_ROLES),
    Layout(
        "from_value_with_system",
        ("system", "conversations/*/from", "conversations/*/value"),
        (Said("system", ("system",), optional=True), Each("conversations", "from", "value")),
        OTHER_ROLES,
    ),
    Layout("instruction", ("instruction", "output"), (Said("user", ("instruction",)), Said("assistant", ("output",)))),
    Layout("instruction_input", ("instruction", "input", "output"), (Said("user", ("instruction", "input")), Said("assistant", ("output",)))),
    Layout("prompt_completion", ("prompt", "completion"), (Said("user", ("prompt",)), Said("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), (Said("user", ("prompt",)), Said("assistant", ("response",)))),
    Layout("question_answer", ("question", "answer"), (Said("user", ("question",)), Said("assistant", ("answer",)))),
)


def paths_of(record: object) -> frozenset[str]:
    """Nested field paths of a JSON value; lists are ``*``, and ``~ / *`` in names are written ``~0 ~1 ~2``."""
    found, open_ = set(), [("", record)]
    while open_:
        path, value = open_.pop()
        if isinstance(value, dict) and value:
            lead = path + "/" if path else ""
            open_ += [(lead + name.replace("~", "~0").replace("/", "~1").replace("*", "~2"), v) for name, v in value.items()]
        elif isinstance(value, list) and value:
            open_ += [(path + "/*" if path else "*", v) for v in value]
        else:
            found.add(path)
    return frozenset(found)


def fingerprint(paths: frozenset[str]) -> int:
    """A signed 64-bit hash of a set of paths."""
    return int.from_bytes(hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _at(value: object, path: str) -> list[object]:
    """What lies at a path, several values below a list."""
    found = [value]
    for name in path.split("/"):
        if name == "*":
            found = [x for v in found if isinstance(v, list) for x in v]
        else:
            found = [v[name] for v in found if isinstance(v, dict) and name in v]
    return found


def _text(value: object, path: str) -> str:
    said = [v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False) for v in _at(value, path)]
    return "\n".join(said) if len(said) > 1 else (said[0] if said else "")


class Layouts:
    """Chooses a layout by fingerprint and applies it."""

    def __init__(self, layouts: tuple[Layout, ...]):
        self.layouts = layouts
        self.known: dict[int, Layout | None] = {}

    def of(self, paths: frozenset[str]) -> tuple[int, Layout | None]:
        mark = fingerprint(paths)
        if mark not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            fitting = [x for x in self.layouts if paths.issuperset(x.needs)]
            self.known[mark] = max(fitting, key=lambda x: len(x.needs), default=None)  # the first of equals
        return mark, self.known[mark]

    def turns(self, record: object, layout: Layout) -> list[tuple[str, str]]:
        names, out = dict(layout.roles), []
        for form in layout.turns:
            if isinstance(form, Row):
                out.append((_text(record, form.role), _text(record, form.text)))
            elif isinstance(form, Said):
                said = [t for p in form.texts if (t := _text(record, p))]
                if said or not form.optional:
                    out.append((form.role, "\n\n".join(said)))
            else:
                for item in (x for v in _at(record, form.items) if isinstance(v, list) for x in v):
                    role = _text(item, form.role)
                    out.append((names.get(role, role), _text(item, form.text)))
        return out


def as_records(*columns: str) -> Column:
    """The columns of a row as a JSON record, nulls included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def canonical(df: DataFrame, record: str, key: str, order: str | None = None, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """One row per turn: ``key, order, position, role, text, layout, fingerprint``.

    Records of one key are parts of one conversation, in the order of the column ``order``.
    Records without a turn give one row whose ``position`` is null.
    """
    ship(df.sparkSession)
    kinds = [df.schema[key].dataType, T.LongType(), T.IntegerType(), T.StringType(), T.StringType(), T.StringType(), T.LongType()]
    names = ["key", "order", "position", "role", "text", "layout", "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Layouts(layouts)
        for batch in batches:
            taken: list[int] = []
            rows: list[tuple] = []
            for i, body in enumerate(batch.column(2).to_pylist()):
                mark = layout = None
                turns: list[tuple[str, str]] = []
                try:
                    value = json.loads(body) if body is not None else None
                    mark, layout = chosen.of(paths_of(value))
                    turns = chosen.turns(value, layout) if layout else []
                except (ValueError, RecursionError):  # not JSON
                    pass
                name = layout.name if layout else None
                for position, (role, text) in enumerate(turns):
                    rows.append((position, role, text, name, mark))
                if not turns:
                    rows.append((None, None, None, name, mark))
                taken += [i] * max(1, len(turns))
            at = pa.array(taken, pa.int64())
            columns = zip(*rows) if rows else [()] * 5
            types = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64()]
            made = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *made], names)

    number = F.lit(0) if order is None else F.col(order)
    rows = df.select(F.col(key).alias("key"), number.cast("long").alias("order"), F.col(record).cast("string").alias("record"))
    return rows.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in zip(names, kinds)]))


# The template's marks.  Each begins with [ or <, which no mark has elsewhere.
BEGIN = "<s>"
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("[OUT] ", " </s>")}
OTHER = ("[ROLE]", "[/ROLE] ", " [/TURN]")
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|OUT\]|/?ROLE\]|/TURN\])")
_ESCAPED = re.compile(CONTROL.pattern.replace(r"(\\*)", r"\\(\\*)"))


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn between its marks, and where its text begins and ends."""
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
    said = escape(text)
    return before + said + after, len(before), len(before) + len(said)


def read_turns(part: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of one formatted part."""
    at = len(BEGIN) if part.startswith(BEGIN) else 0
    while at < len(part):
        for role, (before, after) in MARKS.items():  # noqa: B007
            if part.startswith(before, at):
                break
        else:
            name = part.index(OTHER[1], at)
            role, before, after = unescape(part[at + len(OTHER[0]) : name]), part[at : name + len(OTHER[1])], OTHER[2]
        end = part.index(after, at + len(before))
        yield role, unescape(part[at + len(before) : end])
        at = end + len(after)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_turns(turns: DataFrame) -> DataFrame:
    """Per conversation its text in parts: ``key, part, text, loss`` (places of code points in the part).

    Parts of a conversation follow one another in one partition.
    """
    ship(turns.sparkSession)
    kind = turns.schema["key"].dataType
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("part int, text string, loss array<struct<start:bigint,end:bigint>>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        key, part, pieces, spans, size, begun = None, 0, [], [], 0, False

        def close() -> None:
            made.append((key, part, "".join(pieces), [{"start": a, "end": b} for a, b in spans]))

        for batch in batches:
            type_ = batch.schema.field("key").type

            def out() -> pa.RecordBatch:
                columns = list(zip(*made)) if made else [()] * 4
                kinds = [type_, pa.int32(), pa.string(), _SPANS]
                return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["key", "part", "text", "loss"])

            for new, position, role, text in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("key", "position", "role", "text"))):
                if not begun or new != key:
                    if begun:
                        close()
                    key, part, pieces, spans, size, begun = new, 0, [BEGIN], [], len(BEGIN), True
                elif size >= PART_CHARS:
                    close()
                    part, pieces, spans, size = part + 1, [], [], 0
                if position is not None:
                    piece, start, end = write_turn(role or "", text or "")
                    if role == "assistant":
                        spans.append((size + start, size + end))
                    pieces.append(piece)
                    size += len(piece)
            yield out()
            made.clear()
        if begun:
            close()
            yield out()

    dealt = turns.filter("layout is not null").repartition("key").sortWithinPartitions("key", "order", "position", "role", "text")
    return dealt.mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per turn of ``format_turns``'s result ``key, part, number, role, text``, texts without escapes."""
    ship(formatted.sparkSession)
    schema = T.StructType([formatted.schema["key"], *T.StructType.fromDDL("part int, number int, role string, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, turns = [], []
            for i, part in enumerate(batch.column(2).to_pylist()):
                found = [(n, *turn) for n, turn in enumerate(read_turns(part))]
                turns += found
                taken += [i] * len(found)
            at = pa.array(taken, pa.int64())
            columns = list(zip(*turns)) if turns else [()] * 3
            made = [pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *made], ["key", "part", "number", "role", "text"])

    return formatted.select("key", "part", "text").mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read from its parts: ``key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Takes the rows as ``format_turns`` leaves them: parts in order, in one partition.
    """
    ship(formatted.sparkSession)
    schema = T.StructType([
        formatted.schema["key"], *T.StructType.fromDDL("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        key, begun = None, False
        turns, n_turns, loss, loss_chars, chars = hashlib.sha256(), 0, hashlib.sha256(), 0, 0
        for batch in batches:
            type_ = batch.schema.field("key").type

            def out() -> pa.RecordBatch:
                columns = list(zip(*made)) if made else [()] * 6
                kinds = [type_, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], schema.names)

            for new, part, text, spans in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("key", "part", "text", "loss"))):
                if part == 0:
                    if begun:
                        made.append((key, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    key, begun = new, True
                    turns, n_turns, loss, loss_chars, chars = hashlib.sha256(), 0, hashlib.sha256(), 0, 0
                for role, said in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                for span in spans:
                    said = unescape(text[span["start"] : span["end"]])
                    loss.update(said.encode())
                    loss_chars += len(said)
                chars += len(text)
            yield out()
            made.clear()
        if begun:
            made.append((key, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            yield out()

    return formatted.mapInArrow(run, schema)
