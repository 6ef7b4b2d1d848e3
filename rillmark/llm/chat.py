"""Conversations of many layouts as one marked-up text, with a mask of what a model learns from.

A layout is known by its fingerprint: a hash of the sorted paths of its fields, read off a frame's schema or off each record. Each known layout
has a declarative mapping to turns; records of a layout without one are returned apart, a frame without one is an error. A turn is written as ``<|im_start|>role``, a line break, the
text and ``<|im_end|>`` with a line break. Inside roles and texts every ``<|`` gets a backslash between its two characters (one
more if it has some already), so that neither can hold a marker, and reading takes it away again.

Defined cases: a null role or text is empty; turns are ordered by turn, role and text, nulls first, so repeated turns are kept in a
fixed order; records that do not parse, or have a field of an unexpected kind, are returned as unmatched; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from .common import map_frames, staged

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def paths_of(value, at: str = "") -> set[str]:
    """Paths of all leaves of a parsed record; elements of a list share one path."""
    if isinstance(value, dict):
        return set().union(*(paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else {at + "{}"}
    if isinstance(value, list):
        return set().union(*(paths_of(v, at + "[]") for v in value)) if value else {at + "[]"}
    return {at}


# Layouts: the paths of their fields, and where turns come from. Either ``each`` names a list and the role and text of its elements,
# or ``turns`` lists fixed roles with the fields whose non-empty values, joined by a line break, are the text.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
LAYOUTS = [
    {"paths": ["messages[].content", "messages[].role"], "each": ("messages", "role", "content")},
    {"paths": ["conversations[].from", "conversations[].value"], "each": ("conversations", "from", "value")},
    {"paths": ["conversation.turns[].speaker", "conversation.turns[].text"], "each": ("conversation.turns", "speaker", "text")},
    {"paths": ["prompt", "response"], "turns": [("user", ["prompt"]), ("assistant", ["response"])]},
    {"paths": ["prompt", "completion"], "turns": [("user", ["prompt"]), ("assistant", ["completion"])]},
    {"paths": ["question", "answer"], "turns": [("user", ["question"]), ("assistant", ["answer"])]},
    {"paths": ["system", "prompt", "response"], "turns": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    {"paths": ["instruction", "output"], "turns": [("user", ["instruction"]), ("assistant", ["output"])]},
    {"paths": ["instruction", "input", "output"], "turns": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
]
MAPPINGS = {fingerprint(x["paths"]): x for x in LAYOUTS}
# Tables with a row per turn: conversation, place, role and text.
TABLES = [
    {"paths": ["conv_id", "turn", "role", "text"], "rows": ("conv_id", "turn", "role", "text")},
    {"paths": ["conversation_id", "turn_id", "from", "value"], "rows": ("conversation_id", "turn_id", "from", "value")},
    {"paths": ["thread_id", "position", "author", "content"], "rows": ("thread_id", "position", "author", "content")},
]
FRAMES = {fingerprint(x["paths"]): x for x in TABLES + LAYOUTS}


def schema_paths(kind: DataType, at: str = "") -> set[str]:
    """Paths of all leaves of a schema, named as those of a record."""
    if isinstance(kind, StructType):
        return set().union(*(schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields))
    return schema_paths(kind.elementType, at + "[]") if isinstance(kind, ArrayType) else {at}


def layout_of(schema: StructType) -> dict:
    """The mapping for a frame: that of all its paths, or else that of the most paths of which the frame has every one."""
    paths = schema_paths(schema)
    if (whole := fingerprint(paths)) in FRAMES:
        return FRAMES[whole]
    parts = sorted((x for x in FRAMES.values() if paths.issuperset(x["paths"])), key=lambda x: -len(x["paths"]))
    if not parts or len(parts) > 1 and len(parts[0]["paths"]) == len(parts[1]["paths"]):
        raise ValueError(f"{'several layouts fit' if parts else 'no layout fits'} the fields {sorted(paths)}")
    return FRAMES[fingerprint(parts[0]["paths"])]


def from_frame(df: DataFrame, id: str = "conv_id") -> DataFrame:
    """Turns (conv_id, turn, role, text) of a frame with a row per turn or per conversation, by the layout its schema has.

    Rows of one conversation each are named by ``id``; a missing list of turns is an empty one, and fields of no layout are left aside.
    """
    mapping = layout_of(df.schema)
    if "rows" in mapping:
        conv, turn, role, text = map(F.col, mapping["rows"])
        return df.select(conv.alias("conv_id"), turn.alias("turn"), known_role(role).alias("role"), text.alias("text"))
    if "each" in mapping:
        where, role, text = mapping["each"]
        turns = F.transform(where, lambda x: F.struct(known_role(x[role]).alias("role"), x[text].alias("text")))
    else:
        said = [F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *(F.nullif(F.col(f), F.lit("")) for f in fields)).alias("text")) for role, fields in mapping["turns"]]
        turns = F.filter(F.array(*said), lambda x: (x["role"] != "system") | (x["text"] != ""))
    return df.select(F.col(id).alias("conv_id"), F.posexplode(turns).alias("turn", "said")).select("conv_id", F.col("turn").cast("long").alias("turn"), "said.role", "said.text")


def known_role(role: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return F.coalesce(names[role], role)


def turns_of(record: dict, mapping: dict) -> list[tuple[str, str]]:
    if "each" in mapping:
        where, role, text = mapping["each"]
        for key in where.split("."):
            record = record[key]
        return [(ROLES.get(x[role], x[role]) or "", x[text] or "") for x in record]
    turns = [(role, "\n".join(v for f in fields if (v := record[f]))) for role, fields in mapping["turns"]]
    return [t for t in turns if t[0] != "system" or t[1]]


def from_records(df: DataFrame, id: str, record: str) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, turn, role, text) of JSON records, and the records of no known layout with their fingerprint (null: no JSON object)."""

    def read(batches):
        for pdf in batches:
            out = []
            for key, text in zip(pdf["id"], pdf["record"]):
                print_, turns = None, None
                try:
                    value = json.loads(text)
                    if isinstance(value, dict):
                        print_ = fingerprint(paths_of(value))
                        if print_ in MAPPINGS:
                            turns = turns_of(value, MAPPINGS[print_])
                            turns = [{"turn": i, "role": r, "text": t} for i, (r, t) in enumerate(turns)] if all(isinstance(x, str) for t in turns for x in t) else None
                except (ValueError, TypeError):
                    pass
                out.append((key, print_, turns))
            yield pd.DataFrame(out, columns=["conv_id", "layout", "turns"], dtype=object)

    rows = df.select(F.col(id).alias("id"), F.col(record).alias("record"))
    kind = rows.schema["id"].dataType.simpleString()
    mapped = map_frames(rows, read, f"conv_id {kind}, layout string, turns array<struct<turn:bigint,role:string,text:string>>")
    return mapped.where("turns is not null").select("conv_id", F.inline("turns")), mapped.where("turns is null").select("conv_id", "layout")


def escape(x: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", x)


def unescape(x: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", x)


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn, in order within a conversation by (turn, role, said): ``formatted`` text, and the learned part of it as
    ``mask_start`` and ``mask_end`` in code points (equal: nothing). A conversation's text is its rows' texts joined without gap."""

    def run(batches):
        for pdf in batches:
            formatted, starts, ends = [], [], []
            for role, text in zip(pdf["role"], pdf["text"]):
                head = START + escape(role or "").replace("\\", "\\\\").replace("\n", "\\n") + "\n"
                body = escape(text or "")
                formatted.append(head + body + END + "\n")
                starts.append(len(head))
                ends.append(len(head) + len(body) * (role == LEARNED))
            yield pdf[["conv_id", "turn"]].assign(formatted=formatted, mask_start=starts, mask_end=ends)

    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return map_frames(rows, run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, turn long, formatted string, mask_start long, mask_end long")


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text of any number of turns."""
    turns = []
    for part in formatted.split(START)[1:]:
        head, _, rest = part.partition("\n")
        body = rest[: rest.rindex(END)]
        role = re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), head, flags=re.S)
        turns.append((unescape(role), unescape(body)))
    return turns


def summaries(written: DataFrame) -> DataFrame:
    """Per conversation the digests of what is read back from ``format_turns``.

    Reading and unescaping is done row by row before the rows are dealt out; in a conversation's order only the digests are carried on,
    so a conversation of any length needs no more memory than one batch of rows.
    """

    def read(batches):
        for pdf in batches:
            whole, learned = [], []
            for x, start, end in zip(pdf["formatted"], pdf["mask_start"], pdf["mask_end"]):
                ((role, text),) = parse_turns(x)
                whole.append(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                learned.append(unescape(x[start:end]).encode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "turn": pdf["turn"], "whole": whole, "learned": learned, "chars": pdf["formatted"].str.len()})

    def fold(batches):
        key, state = None, None
        for pdf in batches:
            out = []
            for conv, whole, learned, chars in zip(pdf["conv_id"], pdf["whole"], pdf["learned"], pdf["chars"]):
                conv = None if pd.isna(conv) else conv
                if state is None or conv != key:
                    if state is not None:
                        out.append(closed(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(whole)
                state[2] += len(bytes(learned).decode("utf-8", "surrogatepass"))
                state[3].update(learned)
                state[4] += chars
            if out:
                yield pd.DataFrame(out, columns=columns, dtype=object)
        if state is not None:
            yield pd.DataFrame([closed(key, state)], columns=columns, dtype=object)

    def closed(key, s):
        return key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = written.schema["conv_id"].dataType.simpleString()
    back = map_frames(written, read, f"conv_id {kind}, turn long, whole binary, learned binary, chars long")
    dealt = back.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "whole")
    return map_frames(dealt, fold, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def write(turns: DataFrame) -> DataFrame:
    """The formatted turns as a written table."""
    return staged(format_turns(turns), "chat")
