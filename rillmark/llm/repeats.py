"""Passages that repeat across documents, found in suffix trees of bounded size, and their removal.

Every run of ``window`` words holds a landmark, the run of ``SEED`` words with the least hash in it, so equal passages have equal landmarks.
A landmark seen in just one document repeats nowhere; for the others the words around it go where that landmark, a prefix that all
their suffixes have in common, sends them. A landmark with more than ``LARGE`` places would make too large a group: its suffixes are sent by a longer
prefix, the whole ``window`` words, and only their document and place go. In each group the suffixes are sorted, doubling the number
of words compared; those that agree in ``window`` words are the leaves below one node at that depth, and a leaf whose document is not
the least of its node is a repeat.

Landmarks, and long prefixes together with the landmark in them, are compared by 64-bit hashes; words in groups are compared themselves. Defined cases: a null text has no
words; a document without an id neither loses words nor takes any from others; rows that repeat an id are judged each by its own text, and never against rows
of the same id; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, WordIds, gram_hashes, map_frames, mixed, per_process, slices, staged

SEED = 12
LARGE = 256
BATCH = 6_000


def landmarks(ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each landmark, and the first and last of the windows that it is the leftmost least landmark of."""
    values = mixed(gram_hashes(ids, SEED))
    n = len(ids) - window + 1
    if n <= 0:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)
    at, width, wide = np.arange(len(values)), 1, window - SEED + 1
    least = values
    while width < wide:
        step = min(width, wide - width)
        a, b = least[: len(least) - step], least[step:]
        first = a <= b
        least, at = np.where(first, a, b), np.where(first, at[: len(at) - step], at[step:])
        width += step
    at = at[:n]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return values[at[first]], at[first], first, np.append(first[1:], n) - 1


def seeds(docs: DataFrame, window: int) -> DataFrame:
    def run(batches):
        ids = per_process("word ids", WordIds)
        for pdf in slices(batches):
            found = [landmarks(ids.of(WORD.findall(x or "")), window) for x in pdf["text"]]
            counts = [len(f[0]) for f in found]
            yield pd.DataFrame({
                "seed": np.concatenate([f[0].view(np.int64) for f in found]) if found else np.empty(0, np.int64), "doc": pdf["doc"].repeat(counts), "key": pdf["key"].repeat(counts),
                "place": np.concatenate([f[1] for f in found]).astype(np.int32) if found else np.empty(0, np.int32),
            })

    return docs.mapInPandas(run, f"seed long, doc {docs.schema['doc'].dataType.simpleString()}, key long, place int")


def suffixes(docs: DataFrame, window: int) -> DataFrame:
    """Of documents with ``places`` (place, large) of shared landmarks: the words around each, or, where the group would be large,
    a row per suffix with the hash of its whole prefix."""

    def run(batches):
        ids = per_process("word ids", WordIds)
        for pdf in batches:
            out = []
            for doc, key, text, places in zip(pdf["doc"], pdf["key"], pdf["text"], pdf["places"]):
                words = WORD.findall(text or "")
                hashes = ids.of(words)
                wanted = {p["place"]: p["large"] for p in places}
                whole = gram_hashes(hashes, window).view(np.int64) if any(wanted.values()) else None
                long: dict[tuple[int, int], list[int]] = {}
                for seed, place, first, last in zip(*landmarks(hashes, window)):
                    large = wanted.get(place)
                    if large is None:
                        continue
                    seed = int(seed.view(np.int64))
                    if large:
                        for s in range(first, last + 1):
                            long.setdefault((seed, int(whole[s])), []).append(s)
                    else:
                        out.append((seed, 0, doc, key, [int(first)], " ".join(words[first : last + window])))
                # A prefix that a document has at several places goes once.
                out += [(seed, prefix, doc, key, starts, None) for (seed, prefix), starts in long.items()]
                if len(out) >= BATCH:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    names = ["seed", "prefix", "doc", "key", "starts", "words"]
    return docs.mapInPandas(run, f"seed long, prefix long, doc {docs.schema['doc'].dataType.simpleString()}, key long, starts array<int>, words string")


def pair_ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].astype(np.int64)


def node_of(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Number of the node at ``depth`` below which each suffix is a leaf; the ``depth`` words from each start are all given."""
    ranks, width, taken, out = words, 1, 0, None
    powers = {1: ranks}
    while 2 * width <= depth:
        if len(ranks) > width:
            ranks = np.append(pair_ranks(ranks[:-width], ranks[width:]), np.zeros(width, np.int64))  # ends of the array belong to no whole prefix
        width *= 2
        powers[width] = ranks
    for width in sorted(powers, reverse=True):
        while depth - taken >= width:
            own = powers[width][starts + taken]
            out = own if out is None else pair_ranks(out, own)
            taken += width
    return out


def repeats(group: pd.DataFrame, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and offset of each suffix that repeats one of a document with a smaller id, for rows with words."""
    vocabulary: dict[str, int] = {}
    parts = [[vocabulary.setdefault(w, len(vocabulary)) for w in x.split(" ")] for x in group["words"]]
    lengths = np.array(list(map(len, parts)))
    firsts = np.cumsum(lengths) - lengths
    counts = lengths - window + 1
    row = np.repeat(np.arange(len(parts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    node = node_of(np.concatenate([np.array(p, np.int64) for p in parts]), firsts[row] + offset, window)
    order = pd.factorize(group["doc"], sort=True)[0][row]
    least = np.full(node.max() + 1, len(group), np.int64)
    np.minimum.at(least, node, order)
    again = order > least[node]
    return row[again], offset[again]


def found_repeats(parts: DataFrame, window: int) -> DataFrame:
    """Ranges (key, from, to) of words covered by repeats. Groups are read one after the other, in batches that end with a group."""

    def covered(key, starts):
        order = np.lexsort((starts, key))
        key, starts = key[order], starts[order]
        cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(starts) > window)) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]]) - 1
        return pd.DataFrame({"key": key[first], "from": starts[first], "to": starts[last] + window})

    def run(batches):
        waiting, n, large = [], 0, None
        for pdf in batches:
            whole = pdf[pdf["words"].isna()]
            if len(whole):
                # Rows of one prefix come by document, the least one first; it may have come with an earlier batch.
                group = pd.Series(list(zip(whole["seed"], whole["prefix"])))
                new = group.ne(group.shift())
                if large is not None and group.iloc[0] == large[0]:
                    new.iloc[0] = False
                least = whole["doc"].reset_index(drop=True).where(new)
                if not new.iloc[0]:
                    least.iloc[0] = large[1]
                least = least.ffill()
                large = (group.iloc[-1], least.iloc[-1])
                again = (whole["doc"].reset_index(drop=True) != least).to_numpy()
                if again.any():
                    starts = whole["starts"].to_numpy()[again]
                    yield covered(whole["key"].to_numpy()[again].repeat(list(map(len, starts))), np.concatenate(starts).astype(np.int64))
            pdf = pdf[pdf["words"].notna()]
            if not len(pdf):
                continue
            waiting.append(pdf)
            n += len(pdf)
            if n >= BATCH:
                pdf = pd.concat(waiting, ignore_index=True)
                ready = int(np.searchsorted(pdf["seed"], pdf["seed"].iloc[-1]))  # the last group may go on
                if ready:
                    yield from tree(pdf.iloc[:ready].reset_index(drop=True))
                waiting, n = [pdf.iloc[ready:]], len(pdf) - ready
        if n:
            yield from tree(pd.concat(waiting, ignore_index=True))

    def tree(group):
        row, offset = repeats(group, window)
        if len(row):
            first = group["starts"].map(lambda x: x[0]).to_numpy(np.int64)
            yield covered(group["key"].to_numpy()[row], first[row] + offset)

    dealt = parts.repartition("seed", "prefix").sortWithinPartitions("seed", "prefix", "doc")
    return dealt.mapInPandas(run, "key long, from long, to long")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """Per row the id, ``n_words``, ``n_removed`` and the ``kept`` text: words covered by a run of ``window`` words that a document
    with a smaller id has too are left out, the others joined by one space."""
    rows = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc", "text"))
    places = staged(seeds(rows.where("doc is not null"), window), "landmarks")
    shared = places.groupBy("seed").agg(F.min("doc").alias("x"), F.max("doc").alias("y"), F.count(F.lit(1)).alias("n")).where("x != y").select("seed", (F.col("n") > LARGE).alias("large"))
    # A struct built right before the join: places of a landmark that many documents have can be split at runtime.
    known = shared.select(F.struct("seed").alias("known"), "large")
    wanted = places.join(known, F.struct(places["seed"]) == F.col("known")).groupBy("key").agg(F.collect_set(F.struct("place", "large")).alias("places"))
    # The texts are dealt out by key here and once more below: one shuffle serves both.
    texts = rows.join(wanted, "key").select("doc", "key", "text", "places")
    ranges = found_repeats(suffixes(texts, window), window).groupBy("key").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))

    def cut(batches):
        for pdf in batches:
            out = []
            for doc, x, ranges in zip(pdf["doc"], pdf["text"], pdf["ranges"]):
                words = WORD.findall(x or "")
                gone = np.zeros(len(words), bool)
                for r in ranges if ranges is not None else ():
                    gone[r["from"] : r["to"]] = True
                kept = words if ranges is None else [w for w, g in zip(words, gone) if not g]
                out.append((doc, len(words), len(words) - len(kept), " ".join(kept)))
            yield pd.DataFrame(out, columns=["doc", "n_words", "n_removed", "kept"], dtype=object)

    whole = rows.join(ranges, "key", "left").select("doc", "text", "ranges")
    kind = rows.schema["doc"].dataType.simpleString()
    return map_frames(whole, cut, f"doc {kind}, n_words long, n_removed long, kept string").withColumnRenamed("doc", id)
