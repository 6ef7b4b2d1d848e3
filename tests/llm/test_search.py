"""Ranked search against a plain scoring of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, lower

from rillmark.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, k=10):
    """(item, rank, doc, score) by scoring all documents; ``docs`` and ``items`` are (id, text)."""
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            m = 25 + (75 * sum(b.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in TERM.findall(lower(text)) if t in b
            )
            found.append((-score, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(f for f in found if f[0])[:k], 1)]
    return sorted(out, key=repr)


def ranked(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, rank string, score int")
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    return sorted((tuple(r) for r in search.rank(d, q, **more).collect()), key=repr)


def corpus(n, words, seed=0):
    rng = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(words)]
    p = 1 / np.arange(1, words + 1)
    return [(i, " ".join(rng.choice(names, rng.integers(1, 60), p=p / p.sum()))) for i in range(n)]


@pytest.mark.parametrize("block", [search.BLOCK_TERMS, 500])
def test_equals_scoring_all(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK_TERMS", block)
    docs = corpus(400, 80)
    docs += [(1000 + i, docs[3][1]) for i in range(40)] + [(2000 + i, docs[7][1] + " W0, w1!") for i in range(20)]
    items = [(i, t) for i, t in corpus(12, 120, seed=5)] + [(50, "w0 w0 w0 W1"), (51, "nothing here"), (52, None), (53, docs[3][1])]
    assert ranked(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark):
    docs = list(enumerate(ODD)) + [(None, "a b c"), (None, "same text here"), (7, "same text here"), ((1 << 62) + 1, "a b c"), (30, "x " * 5)]
    items = [(1, "A same x"), (1, "a same x"), (None, "text"), ((1 << 62) + 1, "c b a"), (5, ""), (6, "Ünï é́")]
    assert ranked(spark, docs, items) == plain(docs, items)
    assert ranked(spark, docs, items, k=3) == plain(docs, items, k=3)
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == []


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "ITEM_TERMS", 5)
    docs, items = corpus(100, 30), corpus(9, 30, seed=3)
    assert ranked(spark, docs, items) == plain(docs, items)


def test_bounds_hold_and_branches_are_left_out():
    """Every node's bound is at least the score of each document below it, and a walk does not look at all leaves."""
    rng = np.random.default_rng(1)
    rows = [(d, r, int(rng.integers(1, 5))) for d in range(3000) for r in sorted(rng.choice(60, rng.integers(1, 12), replace=False, p=np.arange(60, 0, -1) / 1830))]
    doc, rank, tf = (np.array(x, np.int64) for x in zip(*rows))
    used, doc = np.unique(doc, return_inverse=True)
    m = rng.integers(25, 400, len(used))
    trie = search.Trie(used.astype(np.int64), m, doc, rank, tf)
    scratch, looked = np.zeros(60, np.int64), []
    value = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
    for ranks in ([0, 5, 59], [58, 59], [10], list(range(0, 60, 7))):
        weights = 10 + 50 * np.array(ranks)
        scores = np.bincount(doc, np.where(np.isin(rank, ranks), (10 + 50 * rank) * value, 0)).astype(np.int64)
        want = sorted(((int(s), int(i)) for s, i in zip(scores, used) if s), key=lambda x: (-x[0], x[1]))[:10]
        assert sorted(trie.best(np.array(ranks), weights, 10, scratch), key=lambda x: (-x[0], x[1])) == want
        assert not scratch.any()
    # Nodes nest, and leaves fill them.
    assert all(sum(trie.hi[c] - trie.lo[c] for c in kids) == trie.hi[n] - trie.lo[n] for n, kids in enumerate(trie.children) if kids)
