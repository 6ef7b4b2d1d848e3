import random

import numpy as np
import pytest

from helpers import ODD, SF, documents, words
from rillmark.llm import repeats


def brute(rows, window):
    least = {}
    for i, t in rows:
        own = words(t)
        for a in range(len(own) - window + 1):
            if i is not None:
                w = tuple(own[a : a + window])
                least[w] = min(least.get(w, i), i)
    out = []
    for i, t in rows:
        own = words(t)
        gone = set()
        for a in range(len(own) - window + 1):
            if i is not None and least[tuple(own[a : a + window])] < i:
                gone.update(range(a, a + window))
        out.append((str(i), len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone)))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in df.collect())


@pytest.mark.parametrize("large, batch", [(256, 6000), (3, 7), (10**9, 2)])
def test_against_all_windows(spark, monkeypatch, large, batch):
    monkeypatch.setattr(repeats, "LARGE", large)
    monkeypatch.setattr(repeats, "BATCH", batch)
    draw = random.Random(large)
    vocabulary = [f"w{i}" for i in range(200)]
    passages = [draw.choices(vocabulary, k=k) for k in (19, 20, 21, 25, 60)] + [["la"] * 45]
    texts = list(ODD)
    for _ in range(40):
        parts = []
        for _ in range(draw.randrange(5)):
            parts += draw.choices(vocabulary, k=draw.randrange(30)) + (draw.choice(passages) if draw.random() < 0.6 else [])
        texts.append(" \n".join(parts))
    texts += texts[12:15]
    df = documents(spark, texts).repartition(3)
    assert got(repeats.remove_repeats(df, window=20)) == brute(list(enumerate(texts)), 20)


def test_repeated_ids_and_nulls(spark):
    a, b = " ".join(f"a{i}" for i in range(70)), " ".join(f"b{i}" for i in range(70))
    rows = [(1, a), (1, a), (1, b), (2, b + " " + a), (None, a), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(repeats.remove_repeats(df)) == brute(rows, 50)
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = got(repeats.remove_repeats(docs))
    assert rows == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 50)
    assert sum(r[2] for r in rows) > 0


def test_nodes_are_equal_prefixes():
    draw = np.random.default_rng(5)
    for depth in (1, 2, 7, 50):
        x = draw.integers(0, 2, 400)
        starts = np.arange(len(x) - depth + 1)
        node = repeats.node_of(x.astype(np.int64), starts, depth)
        by = {}
        for s, k in zip(starts, node):
            assert by.setdefault(k, tuple(x[s : s + depth])) == tuple(x[s : s + depth])
        assert len(by) == len({tuple(x[s : s + depth]) for s in starts})
