"""Scores of texts under a language model learnt from the corpus.

The model is a weighted backoff automaton. Its states are contexts seen in training, up to ``order - 1`` tokens long, down to the
empty one; an arc for a token has the smoothed probability of that token after the context. A state also has a failure arc
to the context that is one token shorter, taken at the cost of its backoff weight when there is no arc for the token; the empty state
has arcs for every known token and one for all others. With c(h) the count of a context and m the smoothing mass:

    p(w | h) = (c(h w) + m p(w | shorter h)) / (c(h) + m),   p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

so weights sum to one at every state. All n-grams are kept, those seen once too.

Texts are dealt into blocks of bounded size. A block sends its distinct n-grams, sorted and cut into hash ranges, to where the
counts of a range are added up, and gets the corpus totals back in the same order: the part of the automaton that its own texts can
reach. All texts of the block then go through it at once: all parts of an n-gram seen in training were seen there too, so the state before
a token is the longest context seen that ends there, whatever came earlier, and each token takes its arcs and failure arcs from that state.

Defined cases: a null or empty text is the end token alone; a row whose id is null is trained on; repeated rows count as often as they
occur; with no training rows only the unknown token has a probability; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, exact_pandas, lower_words, mixed, staged, word_hashes

# Not words: words hold no white space.
END, START = b"\n", b"\n\n"
BLOCK_CHARS = 12_000_000
RANGE_TOKENS = 3_000_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def encoded(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, each text led by the start and closed by the end token, and where each text starts."""
    parts, starts, at = [], [], 0
    for text in texts:
        own = word_hashes([START, *lower_words(text), END])
        parts.append(own)
        starts.append(at)
        at += len(own)
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), np.array(starts, np.int64)


def grams(ids: np.ndarray, starts: np.ndarray, order: int):
    """Per order the positions of n-grams' last tokens and the n-grams' keys; an n-gram lies within a text. The start token is a key of order 1."""
    place = np.arange(len(ids)) - np.repeat(starts, np.diff([*starts, len(ids)]))
    at, keys = np.arange(len(ids)), mixed(ids)
    yield at, keys
    for k in range(2, order + 1):
        longer = at[place[at] >= k - 1]
        before = np.zeros(len(ids), np.uint64)
        before[at] = keys
        at, keys = longer, mixed(before[longer - 1] * GOLDEN + ids[longer])
        yield at, keys


def tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, where each of them stands, and for every key the index of its like."""
    by_key = np.argsort(keys)
    keys = keys[by_key]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    which = np.empty(len(keys), np.int32)
    which[by_key] = np.cumsum(new, dtype=np.int32) - 1
    return keys[new], by_key[new], which


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def packed(x: np.ndarray) -> bytes:
    return zlib.compress(x.astype("<u8").tobytes(), 1)


def unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), "<u8")


def count_block(pdf: pd.DataFrame, order: int, ranges: int) -> pd.DataFrame:
    """The block's distinct n-grams with their counts in training texts, by order and range."""
    ids, starts = encoded(pdf["text"])
    trained = np.repeat(pdf["trained"].to_numpy(bool), np.diff([*starts, len(ids)]))
    out = []
    for k, (at, keys) in enumerate(grams(ids, starts, order), 1):
        own, _ = tally(keys)
        counts = np.zeros(len(own))
        learnt, times = tally(keys[trained[at]])
        counts[np.searchsorted(own, learnt)] = times
        part = range_of(own, ranges)
        cuts = np.searchsorted(part, np.arange(ranges + 1))
        out += [(pdf["block"].iloc[0], k, r, own[a:b].tobytes(), packed(counts[a:b])) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    return pd.DataFrame(out, columns=["block", "k", "range", "keys", "counts"])


def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """Totals of one range of one order, for each block in the order of its keys; number and sum of seen tokens on the first row."""
    keys = [np.frombuffer(x, "<u8") for x in pdf["keys"]]
    own, _, which = distinct(np.concatenate(keys))
    totals = np.bincount(which, np.concatenate([unpacked(x) for x in pdf["counts"]]), len(own)).astype(np.uint64)
    mine = totals[which]
    cuts = np.cumsum([0, *map(len, keys)])
    out = pdf[["block", "k", "range"]].assign(totals=[packed(mine[a:b]) for a, b in zip(cuts, cuts[1:])], seen=0, summed=0)
    if out["k"].iloc[0] == 1:
        words = totals[own != start_key()]
        out.loc[out.index[0], ["seen", "summed"]] = [int((words > 0).sum()), int(words.sum())]
    return out


def start_key() -> np.uint64:
    return mixed(word_hashes([START]))[0]


class Automaton:
    """States and arcs of one block, by order: log10 weights of arcs, backoff weights, what was seen in training, and which n-gram ends at each token."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, totals: list[np.ndarray], seen: int, summed: int, mass: float):
        z = summed + 0.5 * (seen + 1)
        self.unknown = math.log10(0.5 / z)
        self.starts, self.arcs, self.backoffs, self.known, self.ends = starts, [], [], [], []
        counts = p = None
        for k, (at, keys) in enumerate(grams(ids, starts, len(totals)), 1):
            _, some, which = distinct(keys)
            count = totals[k - 1].astype(np.float64)
            if k == 1:
                p = (count + 0.5) / z
            else:
                lower, context = self.ends[-1][at[some]], self.ends[-1][at[some] - 1]  # index of the shorter n-gram, and of the context, in order k - 1
                seen_context = counts[context]
                p = np.where(seen_context > 0, (count + mass * p[lower]) / (seen_context + mass), p[lower])
            counts = count
            self.arcs.append(np.log10(p))
            self.backoffs.append(np.log10(mass / (count + mass)))
            self.known.append(count > 0)
            ends = np.full(len(ids), -1, np.int32)
            ends[at] = which
            self.ends.append(ends)

    def longest(self) -> np.ndarray:
        """Per token the length of the longest n-gram seen in training that ends there."""
        out = np.zeros(len(self.ends[0]), np.int8)
        for k, (ends, known) in enumerate(zip(self.ends, self.known), 1):
            at = np.flatnonzero(ends >= 0)
            out[at[known[ends[at]]]] = k
        return out

    def walk(self, longest: np.ndarray) -> np.ndarray:
        """Log10 probability of each text, from its first token to its end token."""
        order, size = len(self.arcs), len(longest)
        at = np.delete(np.arange(size), self.starts)
        # A state is a context: its length (0: the empty one), and the token before, at which it ends.
        depth = np.minimum(longest[at - 1], order - 1)
        steps = np.zeros((size, order))
        for d in range(order - 1, -1, -1):
            took = longest[at] > d
            here = at[took & (depth == d)]
            steps[here, order - 1 - d] = self.arcs[d][self.ends[d][here]]
            failing = ~took & (depth == d)
            here = at[failing]
            steps[here, order - 1 - d] = self.backoffs[d - 1][self.ends[d - 1][here - 1]] if d else self.unknown
            depth[failing] -= 1
        lengths = np.diff([*self.starts, size])
        return np.bincount(np.repeat(np.arange(len(lengths)), lengths * order), steps.ravel(), len(lengths))


def score_block(docs: pd.DataFrame, totals: pd.DataFrame, order: int, seen: int, summed: int, mass: float) -> pd.DataFrame:
    ids, starts = encoded(docs["text"])
    totals = totals.sort_values(["k", "range"])
    by_order = [np.concatenate([unpacked(x) for x in totals.loc[totals["k"] == k, "totals"]]) if (totals["k"] == k).any() else np.empty(0) for k in range(1, order + 1)]
    automaton = Automaton(ids, starts, by_order, seen, summed, mass)
    longest = automaton.longest()
    score = automaton.walk(longest)
    known = longest > 0
    known[starts] = False
    unigram = automaton.arcs[0][automaton.ends[0]]
    unigram[starts] = 0
    return docs[["doc_id", "held_out"]].assign(
        n_tokens=np.diff([*starts, len(ids)]) - 1, n_known=np.add.reduceat(known.astype(np.int64), starts), train_tokens=summed,
        base_score=np.add.reduceat(unigram, starts), score=score,
    )


def score(docs: DataFrame, held_out: Column, order: int = 2, mass: float = 1000.0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the id, ``held_out``, counts of tokens, the unigram score and the model's score, learnt from rows not held out."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks, ranges = chars // BLOCK_CHARS + 1, chars // 6 // RANGE_TOKENS + 1
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    trained = dealt.select("block", "text", (~F.col("held_out")).alias("trained"))
    counted = trained.groupBy("block").applyInPandas(lambda pdf: count_block(pdf, order, ranges), "block long, k int, range long, keys binary, counts binary")
    totals = staged(counted.groupBy("k", "range").applyInPandas(add_up, "block long, k int, range long, totals binary, seen long, summed long"), "lm-totals")
    size = totals.agg(F.sum("seen").alias("seen"), F.sum("summed").alias("summed")).first()
    seen, summed = size["seen"] or 0, size["summed"] or 0

    def scored(own, totals):
        if not own.num_rows:
            return target.empty_table()
        return pa.Table.from_pandas(score_block(exact_pandas(own), totals.to_pandas(), order, seen, summed, mass), target, preserve_index=False)

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    target = arrow_schema(docs.sparkSession, out)
    return dealt.groupBy("block").cogroup(totals.select("block", "k", "range", "totals").groupBy("block")).applyInArrow(scored, out).withColumnRenamed("doc_id", id)
