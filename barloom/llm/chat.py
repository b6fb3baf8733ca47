"""Chat formatting by schema fingerprints.

A record's fingerprint is a hash of its nested field paths. It selects a declarative mapping, which
says where the turns of that layout lie; so prompt/response pairs, instructions and message lists
all become the same turns. A template then writes each turn between control strings, and control
strings inside texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from barloom.llm.common import narrow
from barloom.session import ship_package

# --- layouts -------------------------------------------------------------------------------------


def paths(value: Any, at: str = "") -> set[str]:
    """Nested field paths; the elements of a list share the path `[]`. Fields that are null or empty lists don't count."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else set()
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value)) if value else set()
    return set() if value is None else {at}


def fingerprint(field_paths: set[str] | list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(field_paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where turns lie: a list of messages, or single fields with the role that each stands for."""

    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    messages: str | None = None
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()  # (role, fields joined by a blank line)

    def layouts(self) -> Iterator[str]:
        """Fingerprints of all combinations with optional fields."""
        for k in range(1 << len(self.optional)):
            yield fingerprint([*self.required, *(p for i, p in enumerate(self.optional) if k >> i & 1)])


#: The public layouts that are known.
MAPPINGS = (
    Mapping(("conv_id", "turn", "role"), ("text",), role="role", text="text"),
    Mapping(("messages[].role",), ("messages[].content", "id"), messages="messages", role="role", text="content"),
    Mapping(("conversations[].from",), ("conversations[].value", "id"), messages="conversations", role="from", text="value"),
    Mapping(("prompt",), ("response", "system", "id"), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("prompt", "completion"), ("system", "id"), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping(("instruction",), ("input", "output", "system", "id"), fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("question", "answer"), ("system", "id"), fields=(("system", ("system",)), ("user", ("question",)), ("assistant", ("answer",)))),
)
#: Other names of roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


@dataclass
class Registry:
    """Fingerprints and their mappings; users add layouts of their own."""

    known: dict[str, Mapping] = field(default_factory=dict)

    def add(self, mapping: Mapping) -> None:
        for f in mapping.layouts():
            self.known.setdefault(f, mapping)

    def turns(self, record: dict) -> list[tuple[str, str]] | None:
        """Canonical turns (role, text) of a record; None if its layout isn't known. A null text is empty."""
        mapping = self.known.get(fingerprint(paths(record)))
        if mapping is None:
            return None
        if mapping.fields:
            return [
                (role, "\n\n".join(str(record[f]) for f in names if record.get(f) not in (None, "")))
                for role, names in mapping.fields
                if any(record.get(f) is not None for f in names)
            ]
        own = [record] if mapping.messages is None else record[mapping.messages]
        return [(canonical_role(m.get(mapping.role)), m.get(mapping.text) or "") for m in own if m]


def canonical_role(role: Any) -> str:
    return ROLES.get(str(role), str(role)) if role is not None else ""


def registry() -> Registry:
    out = Registry()
    for m in MAPPINGS:
        out.add(m)
    return out


# --- template ------------------------------------------------------------------------------------

#: Control strings of common templates, which no text may contain as they are.
CONTROLS = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(\\\\*){re.escape(c[1:])}" for c in CONTROLS))
_ESCAPED = re.compile("|".join(f"{re.escape(c[0])}(\\\\+){re.escape(c[1:])}" for c in CONTROLS))


def escape(text: str) -> str:
    """One backslash more after the first character of each control string, or of what looks like an escaped one."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def unescaped(text: Column) -> Column:
    """unescape as a column."""
    pattern = "|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS)
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, pattern, "")).otherwise(text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and from where to where it counts for the loss (only an assistant's text does)."""
    head = f"<|turn|>{escape(role)}<|text|>"
    body = escape(text)
    out = f"{head}{body}<|end|>"
    return (out, len(head), len(head) + len(body)) if role == "assistant" else (out, 0, 0)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted conversation, as they were."""
    for part in formatted.split("<|end|>")[:-1]:
        role, text = part.removeprefix("<|turn|>").split("<|text|>")
        yield unescape(role), unescape(text)


# --- operators -----------------------------------------------------------------------------------


def canonical_turns(records: DataFrame, id_col: str = "conv_id", json_col: str = "record", order_col: str | None = None, extra: Registry | None = None) -> DataFrame:
    """Turns of JSON records of any known layout: conv_id, part (order_col, else 0), nth, role, text, layout.

    A record of an unknown layout, or that isn't a JSON object, gives one row with role and text
    null. One record's turns stay together; records are never gathered.
    """
    known = extra or registry()
    cols = {"conv_id": id_col, "record": json_col} | ({"part": order_col} if order_col else {})
    rows = narrow(records, **cols)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            part = batch.column(2).to_pylist() if order_col else [0] * batch.num_rows
            for conv, raw, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), part, strict=True):
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                layout = fingerprint(paths(record)) if isinstance(record, dict) else None
                turns = known.turns(record) if layout else None
                if turns is None:
                    out.append((conv, p, 0, None, None, layout))
                else:
                    out += [(conv, p, k, role, text, layout) for k, (role, text) in enumerate(turns)]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["conv_id", "part", "nth", "role", "text", "layout"])

    ship_package(records.sparkSession)
    return rows.mapInArrow(convert, "conv_id long, part long, nth int, role string, text string, layout string")


def formatted_turns(turns: DataFrame) -> DataFrame:
    """conv_id, part, nth, formatted, loss_from, loss_to of each turn: concatenated in order they are the conversation's text.

    Rows whose role is null, which stand for records of an unknown layout, have no turn: canonical_turns has them.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            made = [write_turn(r, t) for r, t in zip(get("role").to_pylist(), get("text").to_pylist(), strict=True)]
            text, lo, hi = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [get("conv_id"), get("part"), get("nth"), pa.array(list(text), pa.string()), pa.array(list(lo), pa.int64()), pa.array(list(hi), pa.int64())],
                ["conv_id", "part", "nth", "formatted", "loss_from", "loss_to"],
            )

    ship_package(turns.sparkSession)
    return turns.where("role IS NOT NULL").mapInArrow(write, "conv_id long, part long, nth int, formatted string, loss_from long, loss_to long")


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from the output, per conversation: see the columns below.

    A conversation's turns stream through one task in order, and only running digests are held.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, state = None, None

        def close() -> None:
            if state is not None:
                done.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) if done else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
            for c, text, lo, hi in zip(get("conv_id"), get("formatted"), get("loss_from"), get("loss_to"), strict=True):
                if state is None or c != conv:
                    close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                masked = unescape(text[lo:hi])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(text)
            if done:
                yield flush()
                done.clear()
        close()
        if done:
            yield flush()

    ship_package(formatted.sparkSession)
    # Ties go by role and text as they were: escaping changes the order of strings.
    role = F.expr("substring(formatted, 9, instr(formatted, '<|text|>') - 9)")
    text = F.expr("substring(formatted, instr(formatted, '<|text|>') + 8, length(formatted) - instr(formatted, '<|text|>') - 14)")
    dealt = formatted.repartition("conv_id")
    ordered = dealt.withColumns({"_role": unescaped(role), "_text": unescaped(text)}).sortWithinPartitions("conv_id", "part", "nth", "_role", "_text").drop("_role", "_text")
    return ordered.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def schema_paths(kind: DataType, at: str = "") -> set[str]:
    """paths of a record that has all fields of a schema."""
    if isinstance(kind, StructType):
        return set().union(*(schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields))
    return schema_paths(kind.elementType, f"{at}[]") if isinstance(kind, ArrayType) else {at}


def table_turns(records: DataFrame, id_col: str, order_col: str | None = None, extra: Registry | None = None) -> DataFrame:
    """canonical_turns of a table whose columns are the records' fields: conv_id, part, nth, role, text.

    All rows have one layout, so one fingerprint selects the mapping and the turns are column expressions. A layout that
    isn't known raises ValueError. Turns that a row doesn't have (all fields null) are left out; a null text is empty.
    """
    known = extra or registry()
    mapping = known.known.get(fingerprint(schema_paths(records.schema)))
    if mapping is None:
        raise ValueError(f"no mapping for the layout {sorted(schema_paths(records.schema))}")
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    column = lambda c: F.col(f"`{c}`")
    own_role = lambda r: F.coalesce(names[r], r, F.lit(""))
    turn = lambda role, text: F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    if mapping.fields:
        have = {f.name for f in records.schema.fields}
        own = []
        for role, fields in mapping.fields:
            parts = [column(f).cast("string") for f in fields if f in have]
            if parts:
                said = F.concat_ws("\n\n", *(F.when(p != "", p) for p in parts))
                own.append(F.when(F.coalesce(*parts).isNotNull(), turn(F.lit(role), said)))
        turns = F.filter(F.array(*own), lambda t: t.isNotNull())
    elif mapping.messages is None:
        turns = F.array(turn(own_role(column(mapping.role)), column(mapping.text) if mapping.text in records.columns else F.lit(None)))
    else:
        has_text = mapping.text in records.schema[mapping.messages].dataType.elementType.names
        said = lambda m: turn(own_role(m[mapping.role]), m[mapping.text] if has_text else F.lit(None))
        turns = F.transform(F.filter(column(mapping.messages), lambda m: m.isNotNull()), said)
    part = F.coalesce(column(order_col).cast("long"), F.lit(0)) if order_col else F.lit(0)
    rows = records.select(column(id_col).alias("conv_id"), part.cast("long").alias("part"), F.posexplode(turns).alias("nth", "t"))
    return rows.select("conv_id", "part", "nth", "t.role", "t.text")


def format_conversations(turn_rows: DataFrame) -> DataFrame:
    """formatted_turns of a table with one row per turn (conv_id, turn, role, text).

    Each row is a record of its own; their common layout is fingerprinted like any other. Turns with the
    same number go by role and text; a null number comes first, a null text or role is empty.
    Repeated rows are repeated turns. Very long texts are escaped whole. Other columns are ignored; an
    empty table gives none.
    """
    rows = narrow(turn_rows, conv_id="conv_id", turn="turn", role="role", text="text")
    order = F.coalesce("turn", F.lit(-(1 << 63)))
    return formatted_turns(table_turns(rows.withColumn("turn", order), "conv_id", "turn"))
