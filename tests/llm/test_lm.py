import math
import random
import time
import zlib
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import ODD, SF, documents, lower, words
from rillmark.llm import lm


def brute(rows, order, mass):
    """The same model from plain counts of tuples."""
    texts = [(i, ["<s>", *words(lower(t)), "</s>"], i is not None and zlib.crc32(str(i).encode()) % 5 == 1) for i, t in rows]
    counts = Counter()
    for _, x, held in texts:
        if not held:
            counts.update(tuple(x[a : a + k]) for k in range(1, order + 1) for a in range(len(x) - k + 1))
    single = {g[0]: c for g, c in counts.items() if len(g) == 1 and g[0] != "<s>"}
    total, size = sum(single.values()), len(single)

    def unigram(w):
        return (single.get(w, 0) + 0.5) / (total + 0.5 * (size + 1))

    def p(context, w):
        if not context:
            return unigram(w)
        c = counts[context]
        return (counts[(*context, w)] + mass * p(context[1:], w)) / (c + mass) if c else p(context[1:], w)

    out = []
    for i, x, held in texts:
        own = x[1:]
        model = sum(math.log10(p(tuple(x[max(0, a - order + 1) : a]), x[a])) for a in range(1, len(x)))
        out.append((str(i), held, len(own), sum(w in single for w in own), total, sum(math.log10(unigram(w)) for w in own), model))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in df.collect())


HELD = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 1"


@pytest.mark.parametrize("order", [1, 2, 3])
def test_odd_documents(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(lm, "RANGE_TOKENS", 3_000)
    df = documents(spark, ODD + ["a b", "B a b c", "a b c a b d"] * 3)
    df = df.union(df.limit(3)).union(df.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    for a, b in zip(got(lm.score(df, F.expr(HELD), order, 2.0)), brute(rows, order, 2.0), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_given_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_CHARS", 100_000)
    monkeypatch.setattr(lm, "RANGE_TOKENS", 20_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got(lm.score(docs, F.expr(HELD), 2, 20.0))
    for a, b in zip(rows, brute([(r["doc_id"], r["text"]) for r in docs.collect()], 2, 20.0), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    assert sum(r[6] for r in rows if r[1]) > sum(r[5] for r in rows if r[1])  # better than single tokens on texts not learnt from


def test_nothing_to_learn_from(spark):
    assert lm.score(documents(spark, ODD).limit(0), F.expr(HELD)).count() == 0
    (row,) = lm.score(documents(spark, ["a b"]), F.lit(True)).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0) and row["base_score"] == row["score"] == 0.0


def test_one_long_text_costs_no_more_than_many_short_ones():
    """A text is walked in steps that do not grow in number with its tokens."""
    draw = random.Random(5)
    words = [f"w{draw.randrange(3000)}" for _ in range(150_000)]

    def seconds(texts):
        rows = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "held_out": False, "trained": True, "block": 0})
        totals = lm.count_block(rows, 2, 1).assign(seen=0, summed=0)
        totals = pd.concat([lm.add_up(own.reset_index(drop=True)) for _, own in totals.groupby(["k", "range"])])
        begun = time.process_time()
        out = lm.score_block(rows, totals, 2, int(totals["seen"].sum()), int(totals["summed"].sum()), 1000.0)
        assert out["n_tokens"].sum() == len(words) + len(texts)
        return time.process_time() - begun

    short = [" ".join(words[at : at + 300]) for at in range(0, len(words), 300)]
    assert min(seconds([" ".join(words)]) for _ in range(2)) < 4 * max(seconds(short) for _ in range(2))
