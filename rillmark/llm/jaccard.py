"""Join of texts whose word n-gram sets have a Jaccard similarity of at least a threshold, and the groups that the links make.

Prefix filtering under several global orders. For two sets to be similar enough, the first few tokens of each (its prefix) under
any one order of all tokens must share a token, whatever the order. The first order sorts tokens by their hash, except that
tokens found in many prefixes (``many`` or more) come last, by how often they were found; that keeps passages which many texts
share out of the prefixes. A prefix is first taken some tokens too long, so that in nearly all texts enough are left when
the frequent ones step back; the few texts for which that is not so are ordered over all their tokens. Tokens shared by fewer than
``many`` prefixes give their pairs; for the others each text is paired with the least text of the group, and once the links so far
have made components, pairs across components are looked for block by block.

Candidates must then pass a bound on how many tokens can be shared, from parity bitmaps of the sets, must share prefix tokens under two
further orders, and are last compared set by set. Equal sets are one member of the join from the start.

Tokens are 64-bit hashes of n-grams. Defined cases: a null text, or one without words, has the empty set and is linked with nothing; a text with fewer than
``n`` words has one token, its whole sequence; repeated rows of an id give a row each; a row without an id is linked with nothing and is
its own group, without an id; other columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, gram_hashes, lower_words, map_frames, mixed, slices, staged, word_hashes
from .graph import components

MANY = 32
BLOCK = 1024


def token_sets(texts, n: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its n-grams. The texts are hashed together; runs that go across two of them are left out."""
    ids = [word_hashes(lower_words(x)) for x in texts]
    lengths = np.array(list(map(len, ids)), np.int64)
    grams = gram_hashes(np.concatenate([*ids, np.empty(0, np.uint64)]), n).view(np.int64)
    ends = np.cumsum(lengths).tolist()
    sets = [np.sort(grams[end - k : end - n + 1]) if k >= n else gram_hashes(x, max(1, k)).view(np.int64) for x, k, end in zip(ids, lengths.tolist(), ends)]
    flat = np.concatenate([*sets, np.empty(0, np.int64)])
    sizes = np.array(list(map(len, sets)), np.int64)
    starts = np.cumsum(sizes) - sizes
    new = np.ones(len(flat), bool)
    np.not_equal(flat[1:], flat[:-1], out=new[1:])
    new[starts[sizes > 0]] = True
    flat, kept = flat[new], np.cumsum(np.concatenate([[0], new]))
    return [flat[a:b] for a, b in zip(kept[starts].tolist(), kept[starts + sizes].tolist())]


def token_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text."""
    return token_sets([text], n)[0]


def needed(size: np.ndarray | int, percent: int):
    """Tokens that a set of this size shares at least with any similar one."""
    return -(-percent * size // 100)


def prefix_length(size, percent: int):
    return size - needed(size, percent) + 1


def extended_length(size, percent: int):
    p = prefix_length(size, percent)
    return np.minimum(size, p + p // 2 + 8)


def bitmap(tokens: np.ndarray) -> bytes:
    """Parities of how many tokens fall in each of at least twice as many slots: their number, a power of two, is eight times the length."""
    slots = 64
    while slots < 2 * len(tokens):
        slots *= 2
    counts = np.bincount((tokens.view(np.uint64) >> np.uint64(13)) % np.uint64(slots), minlength=slots)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap with fewer slots: parities of slots that fall together are added."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def differ(a: bytes, b: bytes) -> int:
    """A lower bound on the number of tokens in just one of two sets."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def may_link(differing, a, b, percent: int):
    """Whether sets of sizes a and b of which so many tokens at least are in just one can be similar: shared = (a + b - differing) / 2."""
    return 100 * (a + b - differing) >= percent * (a + b + differing)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Both prefixes must share tokens under two further orders before the sets are compared."""
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        keys = [np.sort(mixed(x.view(np.uint64) ^ np.uint64(salt))) for x in (a, b)]
        short = [k[: prefix_length(len(k), percent)] for k in keys]
        if not len(np.intersect1d(*short, assume_unique=True)):
            return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """Per row the id, the set's size, a 128-bit digest of it and its bitmap."""

    def run(batches):
        forget()
        for pdf in slices(batches):
            sets = token_sets(pdf["text"], n)
            yield pd.DataFrame({"doc": pdf["doc"], "size": list(map(len, sets)), "sig": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "bits": [bitmap(s) for s in sets]})

    return map_frames(docs, run, f"doc {kind(docs)}, size long, sig binary, bits binary")


def kind(docs: DataFrame) -> str:
    return docs.schema["doc"].dataType.simpleString()


def set_tokens(docs: DataFrame, n: int, length) -> DataFrame:
    """A row per token of the first ``length(size)`` of each set in hash order, with its place there."""

    def run(batches):
        forget()
        for pdf in slices(batches):
            sets = token_sets(pdf["text"], n)
            sizes = np.array(list(map(len, sets)), np.int64)
            kept = length(sizes) * (sizes > 0)
            yield pd.DataFrame({
                "token": np.concatenate([s[:k] for s, k in zip(sets, kept)]), "doc": pdf["doc"].repeat(kept),
                "place": np.concatenate([np.arange(k) for k in kept]).astype(np.int32), "size": sizes.repeat(kept).astype(np.int32),
            })

    return docs.mapInPandas(run, f"token long, doc {kind(docs)}, place int, size int")


def prefixes(docs: DataFrame, classes: DataFrame, n: int, percent: int, many: int) -> DataFrame:
    """Rows (token, doc, size) of the prefixes under the first order, for one text of each class; tokens no other text can share may be left out."""
    found = set_tokens(docs, n, lambda size: extended_length(size, percent))
    by_token = Window.partitionBy("token")
    # How many texts have the token; equal sets count as often as they occur, which makes a token frequent a little earlier.
    counted = staged(found.withColumn("times", F.count(F.lit(1)).over(by_token)), "tokens")
    own = classes.select("doc")
    hot = staged(counted.where(F.col("times") >= many), "frequent-tokens")
    # Places that frequent tokens take among the first of a text.
    gaps = hot.groupBy("doc", "size").agg(F.sort_array(F.collect_set("place")).alias("gaps"))
    length = prefix_length_column(percent)
    spare = F.least(F.col("size"), length + F.floor(length / 2) + 8) - length
    open_docs = staged(gaps.where(F.size("gaps") > spare).select("doc").join(own, "doc", "left_semi"), "open-texts")

    # Texts with enough other tokens: those of the first ``length`` that are left.
    back = gaps.where(F.size("gaps") <= spare).select("doc", "gaps")
    cold = counted.where(F.col("times") < many).join(open_docs, "doc", "left_anti").join(back, "doc", "left")
    rank = F.col("place") - F.coalesce(F.size(F.filter("gaps", lambda g: g < F.col("place"))), F.lit(0))
    # Texts of which frequent tokens leave too few: order all tokens.
    whole = set_tokens(docs.join(open_docs, "doc", "left_semi"), n, lambda size: size)
    times = hot.groupBy("token").agg(F.max("times").alias("times"))
    ordered = whole.join(times, "token", "left").withColumn("rank", F.row_number().over(Window.partitionBy("doc").orderBy(F.coalesce("times", F.lit(0)), "token")))
    rest = staged(ordered.where(F.col("rank") <= length).select("token", "doc", "size"), "open-prefixes")

    kept = cold.where(rank < length).select("token", "doc", "size", "times").join(own, "doc", "left_semi")
    shared = kept.where("times > 1").drop("times")
    alone = kept.where("times = 1").drop("times").join(rest.select("token").distinct(), "token", "left_semi")
    return shared.unionByName(alone).unionByName(rest)


def prefix_length_column(percent: int):
    size = F.col("size").cast("long")
    return size - F.ceil(percent * size / 100) + 1


def near_sizes(a: str, b: str, percent: int):
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the bitmaps do not rule out."""
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("doc").alias(side), F.col("size").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def run(batches):
        for pdf in batches:
            apart = np.array([differ(x, y) for x, y in zip(pdf["bits_a"], pdf["bits_b"])], np.int64)
            yield pdf.loc[may_link(apart, pdf["size_a"], pdf["size_b"], percent).to_numpy(bool), ["a", "b"]] if len(pdf) else pdf[["a", "b"]]

    types = classes.schema["doc"].dataType.simpleString()
    return pairs.mapInPandas(run, f"a {types}, b {types}")


def verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs whose sets are similar. Only texts that are in a pair are turned into sets again."""
    wanted = staged(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct(), "paired-texts")

    def sets(batches):
        for pdf in slices(batches):
            yield pd.DataFrame({"doc": pdf["doc"], "tokens": [x.tobytes() for x in token_sets(pdf["text"], n)]})

    kept = staged(docs.join(wanted, "doc", "left_semi").mapInPandas(sets, f"doc {kind(docs)}, tokens binary").dropDuplicates(["doc"]), "sets")
    both = pairs.join(kept.select(F.col("doc").alias("a"), F.col("tokens").alias("tokens_a")), "a").join(kept.select(F.col("doc").alias("b"), F.col("tokens").alias("tokens_b")), "b")

    def run(batches):
        for pdf in batches:
            good = [similar(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), percent) for x, y in zip(pdf["tokens_a"], pdf["tokens_b"])]
            yield pdf.loc[np.array(good, bool), ["a", "b"]]

    return staged(both.mapInPandas(run, f"a {kind(docs)}, b {kind(docs)}"), "links")


def across(hot: DataFrame, joined: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Possible pairs across components within the large groups, block against block.

    ``hot`` has the rows (token, doc, members) of large groups. A group of one component has nothing left to find.
    """
    rows = hot.join(joined.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    apart = rows.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("token")
    rows = rows.join(apart, "token", "left_semi").join(classes.select("doc", "size", "bits"), "doc")
    blocks = F.ceil(F.col("members") / BLOCK)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "component", "size", "bits")

    def run(pdf):
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        pdf = pdf.sort_values("size", kind="stable")
        left, right = pdf[pdf["own"] == i], pdf[pdf["own"] == j]
        out = []
        for width, wide in right.groupby(right["bits"].map(len)):
            y = np.stack([np.frombuffer(x, np.uint64) for x in wide["bits"]])
            sizes, comps, ids = wide["size"].to_numpy(), wide["component"].to_numpy(), wide["doc"].to_numpy()
            for doc, comp, size, bits in zip(left["doc"], left["component"], left["size"], left["bits"]):
                lo, hi = np.searchsorted(sizes, [needed(size, percent), 100 * size // percent + 1])
                if lo == hi:
                    continue
                small = min(width, len(bits)) // 8
                x = folded(np.frombuffer(bits, np.uint64), small)
                other = y[lo:hi] if small == width // 8 else np.bitwise_xor.reduce(y[lo:hi].reshape(hi - lo, -1, small), axis=1)
                differing = np.bitwise_count(other ^ x).sum(axis=1, dtype=np.int64)
                good = may_link(differing, size, sizes[lo:hi], percent) & (comps[lo:hi] != comp)
                if i == j:
                    good &= ids[lo:hi] > doc
                out += [(min(doc, o), max(doc, o)) for o in ids[lo:hi][good]]
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"])

    types = classes.schema["doc"].dataType.simpleString()
    return rows.groupBy("token", "i", "j").applyInPandas(run, f"a {types}, b {types}").distinct()


def join(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85, many: int = MANY) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between one text of each class of equal sets, and per row its id, set size, class and component.

    Links between texts that are in one component already may be left out where a token is shared by ``many`` texts or more.
    """
    rows = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    all_rows = staged(sketches(rows, n), "sketches")
    named = all_rows.where("doc is not null and size > 0")
    firsts = named.groupBy("sig", "size").agg(F.min("doc").alias("class"))
    classes = staged(named.join(firsts, ["sig", "size"]).where("doc = class").select("doc", "size", "bits").dropDuplicates(["doc"]), "classes")

    found = prefixes(rows.where("doc is not null"), classes, n, percent, many).distinct()
    by_token = Window.partitionBy("token")
    grouped = found.withColumn("members", F.count(F.lit(1)).over(by_token)).withColumn("least", F.min("doc").over(by_token)).where("members > 1")
    grouped = staged(grouped, "prefixes")
    few = grouped.where(F.col("members") < many).select("token", "doc", "size")
    a, b = few.select("token", F.col("doc").alias("a"), F.col("size").alias("size_a")), few.select("token", F.col("doc").alias("b"), F.col("size").alias("size_b"))
    small = a.join(b, "token").where(F.col("a") < F.col("b")).where(near_sizes("size_a", "size_b", percent)).select("a", "b")
    hot = grouped.where(F.col("members") >= many)
    led = hot.where("doc != least").select(F.col("least").alias("a"), F.col("doc").alias("b"))
    links = verified(staged(possible(small.union(led).distinct(), classes, percent), "possible"), rows.where("doc is not null"), n, percent)
    joined = components(links)
    more = staged(across(hot.select("token", "doc", "members"), joined, classes, percent), "possible")
    if not more.isEmpty():
        links = links.union(verified(more, rows.where("doc is not null"), n, percent))
        joined = components(links)

    placed = all_rows.select("doc", "size", "sig").join(firsts, ["sig", "size"], "left")
    # Without an id, or without words: a group of its own.
    placed = placed.withColumn("class", F.when(F.col("doc").isNotNull() & (F.col("size") > 0), F.col("class")).otherwise(F.col("doc")))
    out = placed.join(joined.withColumnRenamed("node", "class"), "class", "left")
    return links, out.select(F.col("doc").alias(id), F.col("size").alias("n_shingles"), "class", F.coalesce("component", "class").alias("component_id"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """The rows, with all their columns, of the smallest id of each component. Of rows that are equal in id and text one stays; rows without an id all do."""
    placed = join(docs, id, text, n, percent)[1]
    gone = staged(placed.where(F.col(id) != F.col("component_id")).select(id).distinct(), "near-copies")
    kept = docs.join(gone, id, "left_anti").select(docs.columns)
    return kept.where(F.col(id).isNull()).unionByName(kept.where(F.col(id).isNotNull()).dropDuplicates([id, text]))
