"""Personal data found by labelers that vote, with a classifier learnt from their agreement.

Four base shapes (mail address, IP address, card number, telephone number) are found by fixed rules and always kept. Wider shapes propose further
candidates of five families: mail addresses written out (``ann at mail dot org``), telephone numbers without a plus sign, card numbers,
bank accounts and names of persons. Six labelers look at every candidate, base ones too, and vote for it, against it, or abstain:

    shape     the base rule of its family, or digits too few or too many
    check     check digits, a known top-level domain, a trunk or country prefix
    gazetteer issuer digits, given names, known hosts, countries
    cue       words before it that name such data, or other things (versions, orders, pages)
    edge      whether it stands alone or within something longer
    layout    grouping that such data has, or dates and amounts have

How often each vote is given to true and false candidates of a family is estimated by expectation-maximisation over the counts of vote patterns,
beginning from labelers that are right more often than not. The posterior of a candidate's pattern then labels it for a logistic classifier over
votes, lengths, separators and neighbouring characters; candidates the classifier accepts are added to the base spans.

All candidates train it, counted by their features, which are few and discrete. Only counts of patterns and the coefficients reach the driver:
both have a fixed size.

Defined cases: a null or empty text has no spans; ids of any type pass through unchanged, null ones too; repeated rows give a result each and count as often as they
occur; without candidates nothing is added; other columns are left out; all rules read a text once or a bounded number of times, however long it is.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "call", "number", "account", "person")
LABELERS = 6
FAMILY = {"email": 0, "phone": 1, "card": 2}
CONTEXT = 40  # characters on each side

# The base shapes. A look behind or a possessive mark only keeps a long text from being read over and over.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Wider shapes.
SPELLED = re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}\x20?(?:[\[({<]\x20?at\x20?[\])}>]|\x20at\x20|@)\x20?[\w-]{1,63}(?:\x20?(?:[\[({<]\x20?dot\x20?[\])}>]|\x20dot\x20|\.)\x20?[\w-]{1,63}){1,4}", re.I | re.A)
MARKED = re.compile(r"[\[({<]\x20?at\x20?[\])}>]|\x20dot\x20", re.I)
NUMBER = re.compile(r"\(?[0-9](?:[\x20()./-]{0,2}[0-9])++")
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
PERSON = re.compile(r"[A-ZÀ-ÖØ-Þ](?<![^\W_].)[a-zß-öø-ÿ]{1,20}\x20(?:[A-Z]\.\x20)?[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20}(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,20})?(?![^\W_])")

# What the gazetteers know.
DOMAINS = frozenset("com org net edu gov info biz io de fr es it uk eu ch at nl be pl us ca au".split())
HOSTS = frozenset("gmail yahoo outlook hotmail icloud proton gmx web mail example".split())
COUNTRIES = frozenset("AT BE CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LT LU LV MT NL NO PL PT RO SE SI SK".split())
GIVEN = frozenset(
    "Alice Anna Anne Antonio Barbara Carlos Carmen Charles Christine Claire Daniel David Elena Elizabeth Emma Eva François Frank Hans Isabel Jacques James Jan Jean Jennifer "
    "Johanna John Jorge José Juan Julia Karl Katharina Klaus Laura Linda Lucas Luis Maria María Marie Mark Mary Michael Miguel Monika Nicolas Olivia Patricia Paul Peter "
    "Pierre Richard Robert Sabine Sarah Sofia Stefan Susan Thomas Ursula William Wolfgang".split()
)
TITLES = ("mr", "mrs", "ms", "dr", "prof", "herr", "frau", "mme", "monsieur", "madame", "señor", "señora", "sr", "sra", "don", "doña")
CUES = {
    "address": ("mail", "e-mail", "email", "contact", "write", "reach", "kontakt", "correo", "courriel"),
    "call": ("tel", "phone", "call", "mobile", "cell", "fax", "telefon", "handy", "téléphone", "teléfono", "móvil", "whatsapp", "sms", "dial"),
    "number": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "account": ("iban", "account", "konto", "compte", "cuenta", "bank", "transfer"),
    "person": (*TITLES, "name", "signed", "author", "dear", "regards", "sincerely", "contact", "patient", "customer"),
}
AGAINST = ("version", "v", "isbn", "issn", "doi", "order", "invoice", "page", "pages", "section", "chapter", "license", "token", "id", "no", "nr", "total", "price", "usd", "eur", "year", "build", "serial", "sha", "hash")
PLACES = frozenset("street avenue road license public general foundation commons university institute company river county city north south east west new the".split())
PREFIXES = ("00", "0")

WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
DATE = re.compile(r"[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}|[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}")
CALL = re.compile(r"\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}[0-9]{2,8}){1,4}|\(?0[0-9]{2,4}\)?[\x20/-]?[0-9]{5,8}")
FOURS = re.compile(r"[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}")

# (kind, start, end)
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A match ends where the next one's local part may begin, and has exactly one ``@``: so each of these signs is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the four base shapes, by kind and then by start."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", s, e) for s, e in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m.group().split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return found


def word(c: str) -> bool:
    return c.isalnum() or c == "_"


def proposed(text: str, base: list[Span]) -> list[tuple[int, int, int, bool]]:
    """Candidates: family, start, end, whether a base span. Those that only overlap a base span are left out."""
    out = [(FAMILY[kind], s, e, True) for kind, s, e in base if kind in FAMILY]
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    ends = list(accumulate((e for _, e in taken), max))

    def free(s, e):
        i = bisect_left(starts, e)
        return not i or ends[i - 1] <= s

    if "@" in text or MARKED.search(text):
        out += [(0, *m.span(), False) for m in SPELLED.finditer(text) if (" at " not in m.group().lower() or "dot" in m.group().lower()) and free(*m.span())]
    if DIGIT.search(text):
        for m in NUMBER.finditer(text):
            n = sum(c in "0123456789" for c in m.group()) if m.end() - m.start() < 64 else 0
            if 7 <= n <= 19 and not word(text[m.start() - 1 : m.start()]) and not word(text[m.end() : m.end() + 1]) and free(*m.span()):
                out.append((2 if n >= 13 and not set(m.group()) & set("()./") else 1, *m.span(), False))
        out += [(3, *m.span(), False) for m in ACCOUNT.finditer(text) if free(*m.span())]
    out += [(4, *m.span(), False) for m in PERSON.finditer(text) if free(*m.span())]
    return out


def account_check(value: str) -> bool:
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def votes(text: str, family: int, start: int, end: int, base: bool) -> list[int]:
    """One vote a labeler: 1 for, -1 against, 0 none."""
    name, value = ADDED[family], text[start:end]
    digits = "".join(c for c in value if c in "0123456789")
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    shape = check = gazetteer = layout = 0
    if family == 0:
        parts = [p for p in re.split(r"[^\w-]+|\bdot\b", value.lower()) if p and p != "at"]
        shape = 1 if base else -1 if len(parts) < 3 else 0
        check = 1 if parts and parts[-1] in DOMAINS else -1
        gazetteer = 1 if HOSTS & {re.sub(r"\d+$", "", p) for p in parts[1:]} else 0
        layout = 1 if base or re.search(r"[\[({<]", value) else -1 if "@" not in value and " dot " not in value.lower() else 0
    elif family == 1:
        shape = 1 if base else -1 if not 7 <= len(digits) <= 15 else 0
        check = 1 if value.startswith(("+", "(")) or digits.startswith(PREFIXES) else -1 if len(set(digits)) < 3 else 0
        gazetteer = 1 if value.startswith(("+1", "+3", "+4", "0")) or "555" in digits else 0
        layout = -1 if DATE.fullmatch(value) or value.count(".") and not re.search(r"[\x20()/-]", value) else 1 if base or CALL.fullmatch(value) else -1
    elif family == 2:
        shape = 1 if base else 0
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[0] in "3456" else -1
        layout = 1 if FOURS.fullmatch(value) else 0
    elif family == 3:
        shape = 1 if 15 <= len(value.replace(" ", "")) <= 34 else -1
        check = 1 if account_check(value) else -1
        gazetteer = 1 if value[:2] in COUNTRIES else -1
        layout = 1 if re.fullmatch(r"\S{4}(?: \S{4})+(?: \S{1,3})?", value) else 0
    else:
        words = value.replace("-", " ").split(" ")
        shape = -1 if len(value) < 6 else 0
        gazetteer = 1 if words[0] in GIVEN else -1
        check = -1 if PLACES & {w.lower() for w in words} else 0
        layout = -1 if not before.strip() or before.rstrip(" ")[-1:] in ".!?\n" and not before.rstrip(" ").lower().endswith(tuple(f"{t}." for t in TITLES)) else 0
    last = [w.lower() for w in WORDS.findall(before)][-4:]
    cue = 1 if set(last) & set(CUES[name]) else -1 if last and last[-1] in AGAINST else 0
    edge = -1 if before[-1:].isalnum() or after[:1].isalnum() or before[-1:] in tuple("_/=#$") or after[:1] in tuple("_/=") else 1 if before[-1:] in tuple("(:<[") else 0
    return [shape, check, gazetteer, cue, edge, layout]


def kind_of(c: str) -> int:
    return 0 if not c or c in " \n\t" else 1 if c.isdigit() else 2 if c.isalpha() else 3


FEATURES = 1 + 2 * LABELERS + 8 + 6 + 4 + 4


def features(text: str, family: int, start: int, end: int, cast: list[int]) -> list[int]:
    """Numbers of the features that hold, in ascending order; every family has its own."""
    value = text[start:end]
    digits = sum(c in "0123456789" for c in value)
    signs = {c for c in value if not c.isalnum()}
    on = [0]
    on += [1 + 2 * j + (v > 0) for j, v in enumerate(cast) if v]
    at = 1 + 2 * LABELERS
    on.append(at + np.searchsorted([1, 4, 7, 10, 13, 16, 17], digits, side="right"))
    on.append(at + 8 + (0 if not signs else 5 if len(signs) > 1 else " -.(".find(min(signs)) + 1 if min(signs) in " -.(" else 5))
    on.append(at + 14 + kind_of(text[start - 1 : start] if start else ""))
    on.append(at + 18 + kind_of(text[end : end + 1]))
    return [family * FEATURES + int(i) for i in on]


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
FOUND = f"base {SPANS}, candidates array<struct<family:int,start:bigint,end:bigint,base:boolean,pattern:int,active:array<int>>>"


def scan(df: DataFrame, id: str, text: str) -> DataFrame:
    """Base spans and candidates, with votes and features, of every row."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    candidate = pa.struct([("family", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("pattern", pa.int32()), ("active", pa.list_(pa.int32()))])

    def find(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            spans, candidates = [], []
            for x in batch.column(1).to_pylist():
                x = x or ""
                base, rows = base_spans(x), []
                for family, s, e, own in proposed(x, base):
                    cast = votes(x, family, s, e, own)
                    pattern = sum((v + 1) * 3**j for j, v in enumerate(cast))
                    rows.append({"family": family, "start": s, "end": e, "base": own, "pattern": pattern, "active": features(x, family, s, e, cast)})
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
                candidates.append(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span)), pa.array(candidates, pa.list_(candidate))], ["id", "base", "candidates"])

    rows = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(find, f"id {rows.schema['id'].dataType.simpleString()}, {FOUND}")


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior that a candidate with a pattern is true, for each pattern of one family.

    A labeler that votes is right with one probability on true candidates and another on false ones; abstaining tells nothing. Ten pseudo-votes, three of
    four right, begin each estimate, and a labeler is never taken to be right less often than wrong: else data without any true candidate would turn votes around.
    """
    cast = patterns[:, None] // 3 ** np.arange(LABELERS) % 3 - 1
    right = np.full((2, LABELERS), 0.75)
    share = 0.5
    for _ in range(rounds):
        # Log odds that each vote adds: for a vote for, what it is worth on true against false candidates.
        odds = np.where(cast > 0, np.log(right[1] / (1 - right[0])), np.where(cast < 0, np.log((1 - right[1]) / right[0]), 0)).sum(axis=1)
        true = 1 / (1 + np.exp(np.clip(-odds + np.log((1 - share) / share), -500, 500)))
        for y, weight, good in ((0, counts * (1 - true), cast < 0), (1, counts * true, cast > 0)):
            right[y] = np.clip((weight @ good + 7.5) / (weight @ (cast != 0) + 10), 0.51, 0.99)
        share = float((counts @ true + 1) / (counts.sum() + 2))
    return true


def learn(found: DataFrame) -> list[float] | None:
    """Coefficients of the classifier, one a feature; None where there are no candidates."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    spark = found.sparkSession
    each = found.select(F.explode("candidates").alias("c")).groupBy("c.family", "c.pattern", "c.active").agg(F.count(F.lit(1)).alias("n"))
    each = staged(each, "pii-patterns")
    counted = each.groupBy("family", "pattern").agg(F.sum("n").alias("n")).orderBy("family", "pattern").collect()
    if not counted:
        return None
    table = np.array([tuple(r) for r in counted], np.int64)
    posterior = np.empty(len(table))
    for family in np.unique(table[:, 0]):
        own = table[:, 0] == family
        posterior[own] = reliabilities(table[own, 1], table[own, 2].astype(float))
    known = spark.createDataFrame([(int(f), int(p), float(x)) for (f, p, _), x in zip(table, posterior)], "family int, pattern int, true double")
    size = FEATURES * len(ADDED)
    vector = array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_contains("active", i).cast("double")))
    labels = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("true")).alias("weight")), F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("true"))).alias("weight"))))
    rows = each.join(known, ["family", "pattern"]).select(vector.alias("features"), labels.alias("x")).select("features", "x.label", "x.weight")
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, fitIntercept=False, standardization=False).fit(rows)
    return model.coefficients.toArray().tolist()


def find_personal_data(df: DataFrame, id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """One row per input row: the id, ``base`` spans by kind and start, and ``added`` spans likewise (kind, start, end in code points, end exclusive).

    ``least`` is the probability from which the classifier's candidates are added.
    """
    found = staged(scan(df, id, text), "pii-found")
    weights = learn(found)
    if weights is None:
        added = F.lit(None).cast(SPANS)
    else:
        weight, border = F.array(*map(F.lit, weights)), float(np.log(least / (1 - least)))
        good = F.filter("candidates", lambda c: ~c["base"] & (F.aggregate(c["active"], F.lit(0.0), lambda s, i: s + F.get(weight, i)) >= border))
        by_kind = F.array_sort(F.transform(good, lambda c: F.struct(c["family"].alias("family"), c["start"].alias("start"), c["end"].alias("end"))))
        added = F.transform(by_kind, lambda c: F.struct(F.get(F.array(*map(F.lit, ADDED)), c["family"]).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select(F.col("id").alias(id), "base", F.coalesce(added, F.array().cast(SPANS)).alias("added"))


def digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts and digests of the spans of ``find_personal_data``."""

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(id, *map(count, BASE), F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
