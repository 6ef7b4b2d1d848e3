import random

import numpy as np
import pytest

from helpers import ODD, SF, documents
from rillmark.llm import leaks

ITEMS = "item_id long, text string, doc_id long, score double"


def plain(item, part):
    """Smith-Waterman cell by cell."""
    h = [[0.0] * (len(part) + 1) for _ in range(len(item) + 1)]
    for i, x in enumerate(item, 1):
        for j, y in enumerate(part, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (leaks.MATCH if x == y else leaks.MISMATCH), h[i - 1][j] + leaks.GAP, h[i][j - 1] + leaks.GAP)
    return max(map(max, h))


def test_alignment_is_smith_waterman():
    draw = np.random.default_rng(2)
    for _ in range(20):
        lengths = draw.integers(1, 12, 5)
        item, part = np.zeros((5, 12), np.uint64), draw.integers(2, 6, (5, 15)).astype(np.uint64)
        for r, n in enumerate(lengths):
            item[r, :n] = draw.integers(2, 6, n)
        best, _ = leaks.align(item, lengths, part)
        assert best.tolist() == [plain(list(item[r, :n]), list(part[r])) for r, n in enumerate(lengths)]


def brute(docs, items, least=0.5):
    """Every item against every whole text."""
    return sorted(
        (str(i), k, round(s, 6))
        for i, t in docs for k, x in items
        if (w := leaks.words(x)) and (s := plain(w, leaks.words(t)) / len(w)) >= least
    )


def got(df):
    return sorted((str(r["doc_id"]), r["item_id"], round(r["score"], 6)) for r in df.collect())


@pytest.mark.parametrize("most", [1_000_000, 40])
def test_against_all_alignments(spark, most):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([15, 30, 50])))) for k in range(8)] + [(8, None), (9, ""), (10, "two words"), (11, "One!")]
    texts = list(ODD)
    for _ in range(60):
        own = draw.choices(vocabulary, k=draw.randrange(60))
        if draw.random() < 0.7:
            copy = draw.choice(items[:8])[1].split()
            share = draw.choice([0, 0.05, 0.1, 0.2])
            copy = [w for w in copy if draw.random() > share / 2]
            copy = [draw.choice(vocabulary) if draw.random() < share else w.upper() + draw.choice(["", ".", ", "]) for w in copy]
            at = draw.randrange(len(own) + 1)
            own = own[:at] + copy + own[at:]
        texts.append(" ".join(own))
    texts += ["some two, words", "one"]
    benchmark = spark.createDataFrame([(k, t, None, None) for k, t in items], ITEMS)
    rows = got(leaks.find_leaks(documents(spark, texts).repartition(3), benchmark, most=most))
    want = brute(list(enumerate(texts)), items)
    assert rows == [r for r in want if r in rows]  # nothing that a full search would not find, and the same scores
    assert len(rows) >= 0.97 * len(want)
    held = {r[0] for r in rows}
    kept = leaks.clean(documents(spark, texts), benchmark, most=most)
    assert {str(r["doc_id"]) for r in kept.collect()} == {str(i) for i in range(len(texts))} - held and "spans" in kept.columns


def test_empty_and_repeated(spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f", None, None), (1, "a b c d e x", None, None)], ITEMS)
    df = documents(spark, ["a b c d e f"])
    assert got(leaks.find_leaks(df.union(df), benchmark)) == [("0", 1, 1.0)] * 2
    assert leaks.find_leaks(df.limit(0), benchmark).count() == 0
    assert leaks.find_leaks(df, benchmark.limit(0)).count() == 0 and leaks.clean(df, benchmark.limit(0)).count() == 1


def test_given_documents(spark):
    """Exact copies of items are found; texts that share no run of five words with any item are left alone."""
    docs, benchmark = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = {(r[0], r[1]) for r in got(leaks.find_leaks(docs, benchmark))}
    items = [(r["item_id"], leaks.words(r["text"])) for r in benchmark.collect()]
    runs = {tuple(w[a : a + 5]) for _, w in items for a in range(len(w) - 4)}
    for r in docs.collect():
        own = leaks.words(r["text"])
        text = f" {' '.join(own)} "
        for k, w in items:
            if f" {' '.join(w)} " in text:
                assert (str(r["doc_id"]), k) in rows
        if not any(tuple(own[a : a + 5]) in runs for a in range(len(own) - 4)):
            assert not any(i == str(r["doc_id"]) for i, _ in rows)


def test_an_edited_copy_in_many_texts(spark):
    """The n-grams that the same edits leave in each copy are in 1,000 texts, the others in none."""
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(k, " ".join(draw.sample(vocabulary, 32))) for k in range(3)] + [(3, "one two three four five")]
    copies = [" ".join("new" if i % step == step - 1 else w for i, w in enumerate(items[k][1].split())) for k, step in ((0, 4), (1, 5), (3, 4))]
    texts = []
    for _ in range(1000):
        varied = " ".join(draw.choice(vocabulary) if draw.random() < 0.2 else w for w in items[2][1].split())
        texts.append(" ".join([*draw.choices(vocabulary, k=3), draw.choice([*copies, varied]), *draw.choices(vocabulary, k=3)]))
    benchmark = spark.createDataFrame([(k, t, None, None) for k, t in items], ITEMS)
    rows = got(leaks.find_leaks(documents(spark, texts).repartition(3), benchmark))
    assert rows == brute(list(enumerate(texts)), items) and {r[1] for r in rows} == {0, 1, 2, 3}
    assert leaks.clean(documents(spark, texts), benchmark).count() == 1000 - len({r[0] for r in rows})
