"""Collocations against a plain count of every phrase."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, lower

from rillmark.llm import phrases


def plain(rows, top=2000, least=30):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything; ``rows`` are (lang, text)."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for n in range(1, 5):
                counts.update((lang, *ws[i : i + n]) for i in range(len(ws) - n + 1))
    good = {g: a for g, a in counts.items() if len(g) > 2 and a >= least}
    out = []
    for lang in total:
        kept = []
        for g, a in good.items():
            if g[0] != lang:
                continue
            ws = g[1:]
            longer = [b for h, b in good.items() if h[0] == lang and len(h) > len(g) and any(h[i : i + len(ws)] == ws for i in range(1, len(h) - len(ws) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            cuts = [(2_000_000 * a // (counts[(lang, *ws[:k])] + counts[(lang, *ws[k:])]), k) for k in range(1, len(ws))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(ws).encode(), a, counts[(lang, *ws[:k])], counts[(lang, *ws[k:])]))
        out += [(lang, i, p.decode(), a, l, r, total[lang], -s) for i, (s, _, p, a, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(None, lang, t, "x", 1) for lang, t in rows], "doc_id long, lang string, text string, phrase string, f int")
    return sorted(tuple(r) for r in phrases.collocations(df, **more).collect())


def corpus(n=300, seed=0):
    rng = np.random.default_rng(seed)
    names = np.array(["The", "the", "of", "new", "york", "city", "hall", "é", "𝔘", "x.y", "a", "b", "c"])
    p = np.array([3, 9, 8, 5, 4, 3, 2, 2, 1, 1, 3, 2, 1], float)
    texts = [" ".join(rng.choice(names, 40, p=p / p.sum())) + rng.choice([". ", "\t", "\n", " new York city hall! "]) + "new york city hall" for _ in range(n)]
    return [(rng.choice(["en", "de", None]), t) for t in texts] + [("und", "new york city hall " * 40)]


@pytest.mark.parametrize("least, chunk", [(30, 1000), (3, 200), (30, phrases.CHUNK_WORDS)])
def test_equals_counting_all(spark, monkeypatch, least, chunk):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    rows = corpus() + [("en", t) for t in ODD]
    assert mined(spark, rows, least=least) == plain(rows, least=least)


def test_few_counters_and_small_bitmaps_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SPARE", 1)
    monkeypatch.setattr(phrases, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 500)
    monkeypatch.setattr(phrases, "PARTITION_MASS", 2000)
    rows = corpus(400, seed=2)
    assert mined(spark, rows, least=40, top=20) == plain(rows, least=40, top=20)


def test_odd_tables(spark):
    assert mined(spark, []) == [] and mined(spark, [(None, None), ("en", ""), ("", " , ")]) == []
    rows = [("en", None), (None, "a b " * 40), ("", "a b " * 40), ("en", "word" * 50_000 + " b " * 70_000)]
    assert mined(spark, rows) == plain(rows)


def test_summaries_keep_what_is_frequent():
    """Merged in any order, a hash of at least mass / (capacity + 1) more than it lost is there, and what it lost is bounded."""
    rng = np.random.default_rng(3)
    mass, least = 40_000, 200
    stream = np.concatenate([np.repeat(np.arange(20, dtype=np.uint64), 300), rng.integers(1000, 1 << 40, mass - 6000).astype(np.uint64)])
    rng.shuffle(stream)
    for size in (100, 5000):
        summary = phrases.Summary(mass // least + 1)
        for at in range(0, mass, size):
            summary.add(*np.unique(stream[at : at + size], return_counts=True))
        summary.merge()
        assert len(summary.h) <= summary.capacity
        held = dict(zip(summary.h.tolist(), summary.counts.tolist()))
        assert all(300 - mass // (summary.capacity + 1) <= held[x] <= 300 for x in range(20))


def test_steps_between_hashes_round_trip():
    for x in ([], [0], [5, (1 << 48) - 1], [1, 2, 1 << 33]):
        h = np.array(x, np.uint64)
        batches = list(phrases.by_partition(h, np.full(len(h), 300), 3))
        back = []
        for b in batches:
            for r in pa.Table.from_batches([b]).to_pylist():
                back += (np.uint64(r["first"]) + np.cumsum(np.append(np.uint64(0), phrases.wide(r["steps"], np.uint32)))).tolist()
                assert set(phrases.wide(r["counts"], np.uint8).tolist()) == {300}
        assert back == x


def test_rows_of_megabytes_pass_in_small_batches(spark, monkeypatch):
    """By Spark's own setting a batch holds 64 MB of them, and the writer 128 MB."""
    seen, staged, before = {}, phrases.staged, spark.conf.get(phrases.BATCH_SETTING, None)

    def spy(df, name, **options):
        seen[name] = (spark.conf.get(phrases.BATCH_SETTING), int(options.get("parquet.block.size", 1 << 27)))
        return staged(df, name, **options)

    monkeypatch.setattr(phrases, "staged", spy)
    assert mined(spark, [("en", "a b " * 40)])
    assert {s for s, _ in seen.values()} == {"8m"} and max(seen[n][1] for n in ("phrases-chunks", "phrases-grams")) <= 1 << 24
    assert spark.conf.get(phrases.BATCH_SETTING, None) == before
