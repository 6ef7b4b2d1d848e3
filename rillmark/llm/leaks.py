"""Passages of benchmark items in training texts: exact, edited or partly reworded copies.

Words are runs of letters and digits in lower case. The n-grams of the items are looked up in all texts, and each is a seed, however many texts have it:
an edited copy that stands in many texts makes the n-grams that the edits left as frequent as a common phrase. Where a seed is met, the passage
around it is aligned with the item (Smith-Waterman, word by word) if it has enough of the item's words at all, and the share of the item's words that
the best alignment scores is the item's score in that text. A copy that keeps no ``n`` words of an item in a row has no seed and is not found.

Items are taken in blocks of a bounded number of n-grams, each of which every task holds; all texts are read for each block. Defined cases: null texts
and texts without words hold nothing; items without words are in no text, items with fewer words than ``n`` are one shorter n-gram; of items that repeat an id each counts
for itself and, within a block, the best score is kept; every input row is searched by itself, so repeated rows and null ids give rows of their own; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, map_frames

LETTERS = re.compile(r"[^\W_]+")
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5


def words(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


class Items:
    """A block of items with the numbers of their words, and where each n-gram stands in which item.

    All words that are in no item have one number, which no word of an item has.
    """

    OTHER = 3

    def __init__(self, rows: list[tuple], n: int):
        self.n = n
        self.names = [i for i, _ in rows]
        self.numbers: dict[str, int] = {}
        for _, t in rows:
            for w in words(t):
                self.numbers.setdefault(w, len(self.numbers) + self.OTHER + 1)
        self.words = [self.read(t) for _, t in rows]
        keys, items, places = [], [], []
        for k, w in enumerate(self.words):
            own = gram_hashes(w, min(n, len(w))) if len(w) else np.empty(0, np.uint64)
            keys.append(own)
            items.append(np.full(len(own), k))
            places.append(np.arange(len(own)))
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.items, self.places = keys[order], np.concatenate(items)[order] if items else order, np.concatenate(places)[order] if items else order
        self.distinct = np.unique(self.keys)
        self.sizes = sorted({min(n, len(w)) for w in self.words if len(w)})

    def read(self, text: str | None) -> np.ndarray:
        number, other = self.numbers.get, self.OTHER
        return np.array([number(w, other) for w in words(text)], np.uint64)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a text, and keys, of its n-grams that an item has."""
        at, keys, among = [], [], self.distinct
        for size in self.sizes:
            own = gram_hashes(ids, size)
            if len(own) and len(among):
                k = np.searchsorted(among, own)
                k[k == len(among)] = 0
                found = np.flatnonzero(among[k] == own)
                at.append(found)
                keys.append(own[found])
        return (np.concatenate(at), np.concatenate(keys)) if at else (np.empty(0, np.int64), np.empty(0, np.uint64))


def passages(items: Items, ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, from, to): stretches of a text around seeds of an item that may be parts of one copy."""
    at, keys = items.hits(ids)
    by_item = defaultdict(list)
    for p, key in zip(at.tolist(), keys):
        a, b = np.searchsorted(items.keys, [key, key + np.uint64(1)]) if key != np.uint64(2**64 - 1) else (np.searchsorted(items.keys, key), len(items.keys))
        for k in range(a, b):
            by_item[int(items.items[k])].append(p - int(items.places[k]))
    out = []
    for item, starts in by_item.items():
        size = len(items.words[item])
        slack = max(5, size // 3)
        first = last = None
        for s in sorted(starts):
            if first is not None and s > last + slack:
                out.append((item, max(0, first - slack), min(len(ids), last + size + slack)))
                first = None
            first, last = s if first is None else first, s
        out.append((item, max(0, first - slack), min(len(ids), last + size + slack)))
    return out


def align(item: np.ndarray, lengths: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment scores of many item-passage pairs at once, and the passage's word where each ends.

    Rows of ``item`` and ``part`` are padded with different values that match nothing.
    """
    rows, width = part.shape
    slope = -GAP * np.arange(1, width + 1)
    before = np.zeros((rows, width + 1))
    best, end = np.zeros(rows), np.zeros(rows, np.int64)
    for i in range(item.shape[1]):
        alive = i < lengths
        step = np.where(part == item[:, i : i + 1], MATCH, MISMATCH)
        now = np.maximum(np.maximum(before[:, :-1] + step, before[:, 1:] + GAP), 0)
        now = np.maximum.accumulate(now + slope, axis=1) - slope  # gaps in the item
        now[~alive] = 0
        at = now.argmax(axis=1)
        top = now[np.arange(rows), at]
        better = top > best
        best[better], end[better] = top[better], at[better]
        before[:, 1:] = now
    return best, end


def groups(todo: list[tuple], most: int = 1_000_000) -> Iterator[list[tuple]]:
    """At most 256 pairs that are aligned at once, and of long passages fewer: about ``most`` cells."""
    group, width = [], 0
    for x in todo:
        width = max(width, len(x[4]))
        if group and (len(group) == 256 or (len(group) + 1) * width > most):
            yield group
            group, width = [], len(x[4])
        group.append(x)
    if group:
        yield group


def scores(items: Items, texts: list[np.ndarray], found: list[tuple[int, int, int, int]], least: float) -> list[tuple[int, int, float, int]]:
    """(text, item, score, end) of the passages that reach ``least``; at least that share of an item's words must be in the passage at all."""
    todo = []
    for text, item, a, b in found:
        own, part = items.words[item], texts[text][a:b]
        if np.isin(own, part).sum() >= least * len(own):
            todo.append((text, item, a, own, part))
    todo.sort(key=lambda x: (len(x[3]), len(x[4])))
    out = []
    for group in groups(todo):
        item = np.zeros((len(group), max(len(x[3]) for x in group)), np.uint64)
        part = np.ones((len(group), max(len(x[4]) for x in group)), np.uint64)
        for r, x in enumerate(group):
            item[r, : len(x[3])], part[r, : len(x[4])] = x[3], x[4]
        lengths = np.array([len(x[3]) for x in group])
        best, end = align(item, lengths, part)
        out += [(x[0], x[1], b / n, x[2] + int(e) + 1) for x, b, n, e in zip(group, best, lengths, end) if b >= least * n]
    return out


def search(items: Items, texts, least: float) -> list[list[tuple]]:
    """Per text the (item id, score, end) that it holds, the best of each item."""
    out: list[list[tuple]] = [[] for _ in texts]
    hashes, found, waiting = [], [], 0

    def flush():
        best = {}
        for text, item, score, end in scores(items, hashes, found, least):
            key = (text, items.names[item])
            best[key] = max(best.get(key, (0.0, 0)), (score, -end))
        for (text, name), (score, end) in best.items():
            out[text].append((name, score, -end))
        for x in range(len(hashes)):
            hashes[x] = None

    for x in texts:
        own = items.read(x)
        parts = passages(items, own)
        found += [(len(hashes), *p) for p in parts]
        hashes.append(own if parts else None)
        waiting += len(own) if parts else 0
        if waiting > 500_000:
            flush()
            found, waiting = [], 0
    flush()
    return out


def blocks(benchmark: DataFrame, n: int, most: int) -> Iterator[Items]:
    """The items in blocks of about ``most`` words, fetched one after the other."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        block.append((r["item_id"], r["text"]))
        size += len(words(r["text"]))
        if size > most:
            yield Items(block, n)
            block, size = [], 0
    if block:
        yield Items(block, n)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", n: int = 3, least: float = 0.5, most: int = 1_000_000) -> DataFrame:
    """A row per input row and item that it holds: the id, ``item_id``, ``score`` (at least ``least``, at most 1) and the number of the text's last word of it."""
    rows = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    kind, item = rows.schema["doc"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    out = f"doc {kind}, item_id {item}, score double, end_word long"

    def one(items: Items) -> DataFrame:
        def run(batches):
            for pdf in batches:
                found = search(items, list(pdf["text"]), least)
                yield pd.DataFrame([(doc, *hit) for doc, hits in zip(pdf["doc"], found) for hit in hits], columns=["doc", "item_id", "score", "end_word"], dtype=object)

        return map_frames(rows, run, out)

    parts = [one(items) for items in blocks(benchmark, n, most)]
    found = reduce(DataFrame.unionAll, parts) if parts else rows.sparkSession.createDataFrame([], out)
    return found.withColumnRenamed("doc", id)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 3, least: float = 0.5, most: int = 1_000_000) -> DataFrame:
    """The rows, with all their columns, that hold no item."""
    def one(kept: DataFrame, items: Items) -> DataFrame:
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array([not x for x in search(items, batch.column(text).to_pylist(), least)], pa.bool_()))

        return kept.mapInArrow(run, docs.schema)

    kept = docs
    for items in blocks(benchmark, n, most):
        kept = one(kept, items)
    return kept
