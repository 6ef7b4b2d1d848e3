"""Personal data: base shapes against plain expressions, added spans on texts whose spans are known."""

import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import ODD

from rillmark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The base rules as they are written."""
    digits = lambda x: re.sub("[^0-9]", "", x)

    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.B-@0123 4+()_é1299..@\n", max_size=60))
def test_base_spans_are_the_rules(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_on_shapes():
    for text in [
        "a@b@c.de.f@g.h", "x..y@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 000.01.0255.9", "4539 1488 0343 6467, 4539-1488-0343-6467 4539148803436468", "+1 (499) 555-6503 +49..5 +1+22 333 4444",
        "1 4539148803436467", "@a.b", "a@b", "é@b.c", "a@b.c@d.e", "+(12", "+1          2 3 4 5 6 7 8 9 0",
    ]:
        assert pii.base_spans(text) == plain(text), text


FORMS = {
    "address": ["{n} at {h} dot com", "{n} [at] {h} [dot] org", "{n}(at){h}.de"],
    "call": ["({d3}) {d3}-{d4}", "0{d3} {d3} {d4}", "030/{d4}{d3}"],
    "account": ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606"],
    "person": ["Anna Keller", "Peter Brandt", "Maria Lopez", "John Miller"],
}
CUE = {"address": "write to", "call": "phone", "account": "IBAN", "person": "signed"}
NOT = ["version 2.0.1 of 12.05.2021", "order 48213377 total 1,234,567.89", "Apache License", "isbn 978-3-16-148410-0", "in New York", "page 12345678", "the 10-12-14 games", "The Lake"]


def written(seed, n=400):
    """Texts and the spans in them: about one in three has something personal, the others things that look like it."""
    rng = random.Random(seed)
    fill = lambda: " ".join(rng.choice(["the", "river", "was", "cold", "and", "we", "walked", "on"]) for _ in range(rng.randint(3, 15)))
    rows = []
    for i in range(n):
        text, spans = fill() + " ", []
        if i % 3 == 0:
            kind = rng.choice(list(FORMS))
            d = lambda k: "".join(rng.choice("23456789") for _ in range(k))
            value = rng.choice(FORMS[kind]).format(n=rng.choice(["ann", "j.doe", "info7"]), h=rng.choice(["gmail", "web", "acme"]), d3=d(3), d4=d(4))
            text += CUE[kind] + " "
            spans.append((kind, len(text), len(text) + len(value)))
            text += value
        elif i % 3 == 1:
            text += rng.choice(NOT)
        else:
            text += f"mail k{i}@example.com or call +1 (499) 555-{1000 + i}"
        rows.append((i, text + " " + fill(), spans))
    return rows


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t, *_ in rows], "doc_id long, text string, base string, added string")
    return {r["doc_id"]: r for r in pii.find_personal_data(df, **more).collect()}


def test_added_spans_on_held_out_texts(spark):
    rows = written(11)
    got = found(spark, rows)
    want = {(i, *s) for i, _, spans in rows for s in spans}
    have = {(i, *s) for i, r in got.items() for s in r["added"]}
    assert len(want & have) >= 0.9 * len(want), sorted(want - have)[:10]
    assert len(have - want) <= 0.05 * len(have), sorted(have - want)[:10]
    assert all([tuple(s) for s in got[i]["base"]] == plain(t) for i, t, _ in rows)


def test_texts_without_personal_data_get_nothing(spark):
    rows = [(i, f"{x} and more of it {i % 5}") for i, x in enumerate(NOT * 60)]
    assert not any(r["added"] or r["base"] for r in found(spark, rows).values())


def test_odd_rows(spark):
    texts = ODD + ["a@b.cd", "a@b.cd"]
    rows = [((1 << 62) + 1, None), (None, "a@b.cd"), (None, None), *enumerate(texts)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, id int")
    out = [tuple(r) for r in pii.digest(pii.find_personal_data(df)).select("doc_id", "n_email", "spans").collect()]
    assert sorted(out, key=repr) == sorted([(i, int("@" in (t or "")), "email:0:6" if "@" in (t or "") else "") for i, t in rows], key=repr)
    assert pii.find_personal_data(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["1" * 1_000_000, "1." * 500_000, "a@" * 500_000, "a." * 500_000 + "@", "+1 " * 300_000, "Ab Cd " * 150_000, "a at b dot " * 90_000, "AB12 CDEF " * 100_000, "(1" * 400_000])
def test_long_texts_take_linear_time(text):
    start = time.time()
    base = pii.base_spans(text)
    for c in pii.proposed(text, base)[:2000]:
        pii.features(text, *c[:3], pii.votes(text, *c))
    assert time.time() - start < 10


def test_reliabilities_find_the_good_labelers():
    """Votes drawn with known accuracies: the posterior is as often right as that of one who knows the accuracies."""
    rng = np.random.default_rng(0)
    true = rng.random(20_000) < 0.3
    accuracy = [0.95, 0.85, 0.7, 0.6, 0.8, 0.75]
    cast = np.stack([np.where(rng.random(len(true)) < 0.4, 0, np.where(rng.random(len(true)) < a, 1, -1) * np.where(true, 1, -1)) for a in accuracy], axis=1)
    patterns, at, counts = np.unique((cast + 1) @ 3 ** np.arange(6), return_inverse=True, return_counts=True)
    posterior = pii.reliabilities(patterns, counts.astype(float))[at]
    known = cast @ np.log(np.array(accuracy) / (1 - np.array(accuracy))) + np.log(0.3 / 0.7) > 0
    assert ((posterior > 0.5) == true).mean() > (known == true).mean() - 0.005
    # All false, and votes that say so: nothing turns around.
    assert pii.reliabilities(np.array([0, 364 - 243]), np.array([9000.0, 1000.0])).max() < 0.5
