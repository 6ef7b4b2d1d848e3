"""Ranked lexical search: the best documents for every item of a query set.

Terms are runs of letters, digits and non-ASCII characters. A document's score for an item adds, over the item's terms, a weight that falls
with the number of documents holding the term, times a saturating function of how often the document holds it and how long it is. All
numbers but the logarithm are 64-bit integers, so results are exact.

The documents are cut into blocks. Of each document a block keeps the terms that items ask for, most frequent first, and documents sorted by these
vectors make a trie in which documents with the same beginning share a path. A node of the trie is a range of neighbours. It knows the most
often that each term occurs in a document below it and the smallest length factor m below it, which bound every score below it from above.
An item walks the trie depth first, the better child first, and leaves out what cannot beat the best ``k`` found so far. A node of a few documents is not split
further: its documents are scored one by one. The best of all blocks are then ranked.

What limits the terms kept is a bitmap of fixed size over hashed terms of the items; terms that only share a hash with one fall out in the task.
Items, too, come in blocks of bounded size, and every block of documents meets every block of items; neither passes through the driver.

Defined cases: a null or empty text has no terms and is in no result, nor counted among the documents; a row whose id is null is counted, ranked, and comes after others of the
same score; repeated rows are ranked each by itself; an item without terms has no rows; items that are repeated, or share an id, get a ranking each; ids are integers
and pass through unchanged; no documents or no items give no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = re.compile("[A-Z]+")
FILTER_BITS = 1 << 24
# A task's share: terms kept of a block's documents, and terms of a block's items.
BLOCK_TERMS, ITEM_TERMS = 1_500_000, 200_000
# A node of so many documents is scored document by document.
LEAF = 16
NO_ID = (1 << 63) - 1


def terms(text: str | None) -> list[str]:
    text = text or ""
    return TERM.findall(text.lower() if text.isascii() else CAPITALS.sub(lambda m: m.group().lower(), text))


def term_rows(df: DataFrame, id: str, text: str, bits: bytes | None = None) -> DataFrame:
    """``id``, ``n_terms`` and the distinct ``terms`` with their number (``times``) of each row; only terms in the bitmap, if there is one."""

    class Kept(dict):
        def __missing__(self, term: str) -> bool:
            if len(self) >= 200_000:
                self.clear()
            at = zlib.crc32(term.encode()) % FILTER_BITS
            value = self[term] = bool(bits[at >> 3] >> (at & 7) & 1)
            return value

    def count(batches: Iterator[pa.RecordBatch]):
        kept = Kept()
        for batch in batches:
            size, names, times = [], [], []
            for x in batch.column(1).to_pylist():
                found = terms(x)
                counts = Counter(found)
                size.append(len(found))
                names.append([t for t in counts if kept[t]] if bits is not None else list(counts))
                times.append([counts[t] for t in names[-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))], ["id", "n_terms", "terms", "times"],
            )

    return df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(count, "id long, n_terms long, terms array<string>, times array<long>")


def term_filter(asked: DataFrame) -> bytes:
    """Bitmap of the hashed terms of the items: ``FILTER_BITS`` bits, whatever their number."""
    at = asked.select(F.explode("terms").alias("term")).select((F.crc32(F.col("term").cast("binary")) % FILTER_BITS + 1).alias("at"))
    pages = at.groupBy(F.bitmap_bucket_number("at").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for page, bits in pages.collect():
        # Pages and the numbers in them are counted from 1.
        start = (page - 1) * len(bits)
        out[start : start + len(bits)] = bits
    return bytes(out)


class Trie:
    """The documents of a block, sorted by their terms from frequent to rare, with the ranges of neighbours that share a path."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, doc: np.ndarray, rank: np.ndarray, tf: np.ndarray, leaf: int = LEAF):
        """``doc``, ``rank`` and ``tf`` have an entry for each document and term; every document has a term."""
        order = np.lexsort((rank, doc))
        doc, rank, tf = doc[order], rank[order], tf[order]
        sizes = np.bincount(doc, minlength=len(ids))
        ends = np.cumsum(sizes)
        raw = rank.astype(">u4").tobytes()
        paths = [raw[4 * (e - s) : 4 * e] for s, e in zip(sizes.tolist(), ends.tolist())]
        sort = np.array(sorted(range(len(ids)), key=paths.__getitem__), np.int64)
        starts = (ends - sizes)[sort]
        sizes = sizes[sort]
        self.ids, self.m = ids[sort], m[sort]
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(starts - self.at[:-1], sizes) + np.arange(self.at[-1])
        self.rank, self.tf = rank[take], tf[take]
        self.value = 1_000_000_000 * self.tf // (1000 * self.tf + 8 * np.repeat(self.m, sizes))
        self._nodes(leaf)
        self._bounds(sizes)

    def _shared(self) -> list[int]:
        """Number of first terms that each document shares with the next one."""
        sizes = np.diff(self.at)
        both = np.minimum(sizes[:-1], sizes[1:])
        begin = np.cumsum(both) - both
        step = np.arange(both.sum()) - np.repeat(begin, both)
        same = self.rank[np.repeat(self.at[:-2], both) + step] == self.rank[np.repeat(self.at[1:-1], both) + step]
        return np.minimum.reduceat(np.where(same, np.repeat(both, both), step), begin).tolist() if len(both) else []

    def _nodes(self, leaf: int) -> None:
        """Ranges of documents in the order of a walk: nodes of over ``leaf`` documents, and below them the leaves that fill them."""
        shared, n = self._shared(), len(self.ids)
        large, path = {(0, n)}, []
        for i in range(1, n + 1):
            here, lo = shared[i - 1] if i < n else -1, i - 1
            while path and path[-1][0] > here:
                lo = path.pop()[1]
                if i - lo > leaf:
                    large.add((lo, i))
            if not path or path[-1][0] < here:
                path.append((here, lo))
        self.lo, self.hi, self.children = [], [], []
        open_nodes: list[list[int]] = []

        def add(lo: int, hi: int) -> int:
            node = len(self.lo)
            self.lo.append(lo)
            self.hi.append(hi)
            self.children.append([])
            if open_nodes:
                self.children[open_nodes[-1][0]].append(node)
            return node

        def fill(to: int) -> None:
            for lo in range(open_nodes[-1][1], to, leaf):
                add(lo, min(lo + leaf, to))
            open_nodes[-1][1] = to

        def close() -> None:
            fill(self.hi[open_nodes[-1][0]])
            open_nodes.pop()

        for lo, hi in sorted(large, key=lambda x: (x[0], -x[1])):
            while open_nodes and self.hi[open_nodes[-1][0]] <= lo:
                close()
            if open_nodes:
                fill(lo)
                open_nodes[-1][1] = hi
            open_nodes.append([add(lo, hi), lo])
        while open_nodes:
            close()

    def _bounds(self, sizes: np.ndarray) -> None:
        """For leaves the most of each term; for nodes the leaves they span, the least m and the least id."""
        lo, hi = np.array(self.lo), np.array(self.hi)
        leaves = np.array([not c for c in self.children])
        first = lo[leaves]
        self.leaves = len(first)
        span = np.stack([np.searchsorted(first, lo), np.searchsorted(first, hi)], axis=1)
        self.span = span.ravel()
        pair = np.stack([lo, hi], axis=1).ravel()
        self.least_m = np.minimum.reduceat(np.append(self.m, NO_ID), pair)[::2]
        self.least_id = np.minimum.reduceat(np.append(self.ids, NO_ID), pair)[::2].tolist()
        leaf_of = np.repeat(np.searchsorted(first, np.arange(len(sizes)), side="right") - 1, sizes)
        key = self.rank.astype(np.int64) * self.leaves + leaf_of
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        self.most = np.maximum.reduceat(self.tf[order], new)
        self.most_rank, self.most_leaf = np.divmod(key[new], self.leaves)

    def best(self, ranks: np.ndarray, weights: np.ndarray, k: int, scratch: np.ndarray) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) for terms with weights; ``scratch`` is all zeros, one entry a term, before and after."""
        start, end = np.searchsorted(self.most_rank, ranks), np.searchsorted(self.most_rank, ranks, side="right")
        most = np.zeros((len(ranks), self.leaves + 1), np.int64)
        for i, (s, e) in enumerate(zip(start.tolist(), end.tolist())):
            most[i, self.most_leaf[s:e]] = self.most[s:e]
        most = np.maximum.reduceat(most, self.span, axis=1)[:, ::2]
        bound = (weights[:, None] * (1_000_000_000 * most // (1000 * most + 8 * self.least_m))).sum(axis=0).tolist()
        scratch[ranks] = weights
        found: list[tuple[int, int]] = []
        todo = [0]
        while todo:
            node = todo.pop()
            if not bound[node] or len(found) == k and (bound[node], -self.least_id[node]) <= found[0]:
                continue
            if self.children[node]:
                todo += sorted(self.children[node], key=bound.__getitem__)
                continue
            lo, hi = self.lo[node], self.hi[node]
            at = self.at[lo:hi]
            s, e = at[0], self.at[hi]
            scores = np.add.reduceat(scratch[self.rank[s:e]] * self.value[s:e], at - s)
            for i in np.flatnonzero(scores >= (found[0][0] if len(found) == k else 1)).tolist():
                entry = (int(scores[i]), -int(self.ids[lo + i]))
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
        scratch[ranks] = 0
        return [(score, -x) for score, x in found]


def search_block(docs: pa.Table, items: pa.Table, n_docs: int, all_terms: int, k: int) -> pa.Table:
    """The best documents of a block for every item of a block: ``item``, ``item_id``, ``doc_id``, ``score``."""
    out = {"item": [], "item_id": [], "doc_id": [], "score": []}
    wanted = items["wanted"].combine_chunks()
    parts = wanted.flatten()
    asked = dict(zip(parts.field("term").to_pylist(), parts.field("df").to_pylist()))
    names = pa.array(sorted(asked, key=lambda t: (-asked[t], t)), pa.string())
    lists = docs["terms"].combine_chunks()
    found = pc.index_in(lists.flatten(), value_set=names)
    keep = found.is_valid().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(docs)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[keep]
    used, doc = np.unique(doc, return_inverse=True)
    if len(used):
        ids = docs["id"].combine_chunks().take(pa.array(used))
        m = np.array([25 + 75 * n * n_docs // all_terms for n in docs["n_terms"].combine_chunks().take(pa.array(used)).to_pylist()], np.int64)
        tf = docs["times"].combine_chunks().flatten().to_numpy(zero_copy_only=False)[keep]
        trie = Trie(ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), m, doc, found.drop_null().to_numpy(zero_copy_only=False).astype(np.int64), tf.astype(np.int64))
        scratch = np.zeros(len(names), np.int64)
        ranks = pc.index_in(parts.field("term"), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
        weights = parts.field("weight").to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.list_value_length(wanted).to_numpy(zero_copy_only=False)).tolist()
        for start, end, item, item_id in zip([0, *ends], ends, items["item"].to_pylist(), items["item_id"].to_pylist()):
            best = trie.best(ranks[start:end], weights[start:end], k, scratch)
            out["item"] += [item] * len(best)
            out["item_id"] += [item_id] * len(best)
            out["doc_id"] += [None if x == NO_ID else x for _, x in best]
            out["score"] += [score for score, _ in best]
    return pa.table({name: pa.array(column, pa.int64()) for name, column in out.items()})


def rank(documents: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``k`` best documents with a score above 0 of each item, equal scores by ascending id."""
    asked = staged(term_rows(items, item, item_text).withColumn("item", F.monotonically_increasing_id()), "search-items")
    bits = term_filter(asked)
    vectors = staged(term_rows(documents, id, text, bits), "search-vectors")
    total = vectors.agg(F.count_if(F.col("n_terms") > 0).alias("docs"), F.sum("n_terms").alias("terms"), F.sum(F.size("terms")).alias("kept")).first()
    n_docs, all_terms = total["docs"], total["terms"] or 1
    pairs = asked.select("item", F.col("id").alias("item_id"), F.explode(F.arrays_zip("terms", "times")).alias("x")).select("item", "item_id", "x.terms", "x.times").withColumnRenamed("terms", "term")
    frequency = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    wanted = pairs.join(frequency, "term").select("item", "item_id", F.struct("term", "df", (F.col("times") * weight).alias("weight")).alias("x")).groupBy("item", "item_id").agg(F.collect_list("x").alias("wanted"))
    blocks = max(1, -(-(total["kept"] or 0) // BLOCK_TERMS))
    item_blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // ITEM_TERMS))
    left = vectors.where(F.size("terms") > 0).withColumn("block", F.monotonically_increasing_id() % blocks).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))))
    right = wanted.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(item_blocks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))

    def search(docs: pa.Table, items: pa.Table) -> pa.Table:
        return search_block(docs, items, n_docs, all_terms, k)

    best = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(search, "item long, item_id long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
