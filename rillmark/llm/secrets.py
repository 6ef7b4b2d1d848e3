"""Secrets found by fixed shapes and by reading assignments.

The text is read as source or configuration: wherever an assignment sign stands, the name to its left and the literal to
its right make a pair. Literals and names joined by ``+`` are folded, and a name on the right stands for the literal it was given
before, so a literal is judged by every name it reaches; a name that was given none adds nothing to a sum. Its score adds how telling the name is and how random the literal.

Defined cases: a null text counts as empty and has no spans; rows are independent of each other, so repeated rows and null
ids give one result row each; ids, and all columns of ``redact`` but the text, pass through unchanged; other columns of the input are kept out of the result of ``find_secrets``; a sum that would be longer than the text itself,
as of a name added to itself over and over, is not followed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The shapes of the base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "literal")

# What a name must contain, in parts, to make its literal a secret, and how telling it is.
NAMES = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 2.5, "secret": 3, "token": 2.5, "apikey": 3, "api_key": 3, "access_key": 3,
    "private_key": 3, "client_secret": 3, "credential": 2.5, "credentials": 2.5, "auth": 2, "authorization": 2, "bearer": 2.5,
    "signature": 1.5, "salt": 1.5, "encryption_key": 3, "connection_string": 2,
}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|example.*|placeholder|your[_-].*|none|null|true|false|undefined|todo|test)$|^\$[({]|^<[^>]*>$|^%\(")

SIGN = re.compile(r":=|=>|[=:]")
NAME_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*")
# A literal without quotes ends before an assignment sign that another one follows: each sign reads its own part of a run.
LITERAL = re.compile(r"""[\x20\t]*(?:[bBrRuUfF]{0,2}"((?:[^"\\\n]|\\.)*)"|[bBrRuUfF]{0,2}'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|((?:[A-Za-z0-9+/_.~@!#$%^&*-]|=+(?![A-Za-z0-9+/_.=~@!#$%^&*-]))+))""")
PLUS = re.compile(r"""[\x20\t]*\+[\x20\t]*(?=["'`])""")
JOIN = re.compile(r"[\x20\t]*\+[\x20\t]*")
OPERAND = re.compile(r"[\x20\t]*([A-Za-z_][A-Za-z0-9_.]*)(?![A-Za-z0-9_.(\[])")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*$")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def sensitivity(name: str) -> float:
    """How telling a name is; 0 for names that say nothing."""
    last = name.rsplit(".", 1)[-1]
    parts = [p.lower() for p in PARTS.findall(last)]
    joined = parts + ["_".join(p) for p in zip(parts, parts[1:])]
    return max((NAMES.get(p, 0) for p in joined), default=0)


def randomness(value: str) -> float:
    """Shannon entropy per character, in bits."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in map(value.count, set(value))) if n else 0.0


def score(name: str, value: str) -> float:
    told = sensitivity(name)
    if not told or len(value) < 8 or PLACEHOLDER.search(value) or any(c.isspace() for c in value):
        return 0.0
    kinds = sum(bool(re.search(k, value)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return told + max(0.0, randomness(value) - 2.5) + 0.5 * (kinds - 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches of each shape that do not overlap within a kind; those that are too short are dropped."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


def name_before(text: str, end: int) -> str | None:
    """The name that stands before an assignment sign, in quotes or brackets or not, however long it is and however far off."""

    def back(at, signs):
        while at and text[at - 1] in signs:
            at -= 1
        return at

    at = back(end - text.endswith("\n", 0, end), " \t")
    if text.endswith("]", 0, at):
        at = back(at - 1, " ")
    at -= text.endswith(('"', "'"), 0, at)
    name = NAME.search(text, back(at, NAME_SIGNS), at)
    return name.group() if name else None


Known = dict[str, tuple[str, list[tuple[int, int]]]]


def folded(text: str, at: int) -> tuple[str, list[tuple[int, int]], bool]:
    """The literal at a place, with further quoted ones joined to it, where its pieces stand, and whether it is quoted."""
    value, pieces, quoted = "", [], False
    while m := LITERAL.match(text, at):
        group = m.lastindex
        if not m.group(group):
            break
        value += m.group(group)
        pieces.append(m.span(group))
        quoted = group < 4
        more = PLUS.match(text, m.end()) if quoted else None
        if not more:
            break
        at = more.end()
    return value, pieces, quoted


def summed(text: str, at: int, known: Known) -> tuple[str, list[tuple[int, int]]] | None:
    """The literals of a sum in which names stand, those of known names included; None if there is no such sum."""
    values, pieces, names, size = [], {}, 0, 0
    while True:
        m = LITERAL.match(text, at)
        if m and m.lastindex < 4:
            value, own, end = m.group(m.lastindex), [m.span(m.lastindex)] if m.group(m.lastindex) else [], m.end()
        elif m := OPERAND.match(text, at):
            (value, own), end = known.get(m.group(1), ("", [])), m.end()
            names += 1
        else:
            break
        size += len(value)
        if size > len(text):
            return None
        values.append(value)
        pieces.update(dict.fromkeys(own))
        more = JOIN.match(text, end)
        if not more:
            break
        at = more.end()
    return ("".join(values), list(pieces)) if names and len(values) > 1 and pieces else None


def pairs(text: str, known: Known) -> Iterator[tuple[str, str, list[tuple[int, int]]]]:
    """Names with the literal given to them and where its pieces stand: the first one by itself, and then, if there are names in a sum, all of it.

    ``known`` tells the literals of names; it is read where a name is met.
    """
    for sign in SIGN.finditer(text):
        left = name_before(text, sign.start())
        if not left:
            continue
        value, pieces, quoted = folded(text, sign.end())
        whole = summed(text, sign.end(), known)
        if value:
            if not quoted and IDENTIFIER.match(value) and value in known:
                value, pieces = known[value]
            yield left, value, pieces
        if whole:
            yield left, *whole


def literal_spans(text: str, least: float) -> list[tuple[int, int, str]]:
    """Literals that reach a telling name, directly or through other names."""
    if "=" not in text and ":" not in text:
        return []
    known: Known = {}
    found = set()
    for name, value, pieces in pairs(text, known):
        known[name] = (value, pieces)
        if score(name, value) >= least:
            found.update(pieces)
    return [(s, e, KINDS[3]) for s, e in sorted(found)]


def find_secrets(df: DataFrame, id: str = "doc_id", text: str = "text", least: float = 4.5) -> DataFrame:
    """One row per input row: the id and ``spans`` (kind, start, end in code points, end exclusive), ordered by start, then kind.

    ``least`` is the score from which the literal of an assignment counts as a secret. Spans of the base shapes are always kept.
    """

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches):
        for batch in batches:
            spans = []
            for x in batch.column(1).to_pylist():
                x = "" if x is None else x
                both = base_spans(x) + literal_spans(x, least)
                both.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                spans.append([{"kind": k, "start": s, "end": e} for s, e, k in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["id", "spans"])

    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return found.withColumnRenamed("id", id)


def redact(df: DataFrame, text: str = "text", least: float = 4.5, mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every secret replaced by ``mark``; overlapping spans are replaced once. A null text stays null."""
    names = df.columns

    def clean(x: str) -> str:
        out, end = [], 0
        for s, e, _ in sorted(base_spans(x) + literal_spans(x, least)):
            if e <= end:
                continue
            if s >= end:
                out += [x[end:s], mark]
            end = e
        return "".join([*out, x[end:]]) if out else x

    def scan(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = pa.array([None if x is None else clean(x) for x in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    return df.mapInArrow(scan, df.schema).select(*(F.col(f"`{n}`") for n in names))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``find_secrets``."""

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
