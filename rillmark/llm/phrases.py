"""Phrases of two to four words that occur together often, per language.

A phrase of the corpus counts where its words stand next to each other within a piece (a stretch without ``.,;:!?`` or a line end). Which
phrases occur at least ``least`` times is found with Misra-Gries summaries. N-grams are dealt into partitions by hash; a partition's summary
holds more counters than its mass (its n-gram occurrences) divided by ``least``, so no n-gram that frequent can fall out, and by
the same bound what is left is judged: an n-gram stays if its counter and the most it can have lost reach ``least``. Chunks of texts send
each partition the n-grams they hold, counted, and a partition merges these summaries as they come; it holds one summary and as much again that waits,
whatever its mass. Words and pairs are summarised first; runs of three and four words only where every pair in them stayed.

A second pass over the texts counts what stayed, exactly and by its words, and drops what does not reach ``least``. Between passes what
stayed is known as a bitmap of bounded size; a bit that is set by chance costs a count and changes no result. All passes read the texts as numbers of words,
in chunks that were written once.

A candidate of ``a`` occurrences is cut in two at each place; ``l`` and ``r`` are the occurrences of the parts, and the score is the least of
floor(2000000 a / (l + r)). A candidate whose words stand within a longer candidate that occurs at least 80 % as often is left out.

Defined cases: a null text is empty; a null language is ``und``; rows are not told apart, so null ids and other columns play no part, and repeated rows count as
often as they occur; an empty table gives no rows; all counts are exact, and products are taken in decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import gram_hashes, mixed, staged

# Where pieces end.
BREAK = "[.,;:!?\n-\r]"
LONGEST = 4
NOT_GIVEN = "und"
CHUNK_WORDS = 1_000_000
CHUNKS = pa.schema([("lang", pa.string()), ("names", pa.string()), ("words", pa.binary())])
# Bits of an n-gram's hash. N-grams that share one are counted together in summaries, never in the second pass.
HASH_BITS = 48
# N-gram occurrences of a partition, and how many times more counters than needed its summary has.
PARTITION_MASS, SPARE = 4_000_000, 4
# Bits for each n-gram that stayed, and at most in all.
BITS_EACH, MOST_BITS = 16, 1 << 28
# Rows are megabytes: what a task passes to Python at once (by Spark's setting 64 MB, held several times over), and what its writer holds back.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"
HELD_BYTES = str(16 << 20)
GRAMS = "partition long, mass long, first long, steps binary, counts binary"


def hashed(names: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(x.encode()) for x in names), np.uint64, len(names))


class Chunk:
    """Words of many texts of one language, one after the other; 0 stands where a piece ends, other numbers for ``names``."""

    def __init__(self, lang: str, names: str, words: bytes):
        self.lang, self.names, self.words = lang, ["", *names.split("\n")], np.frombuffer(words, np.int32)
        self.hashes = mixed(hashed(self.names) ^ hashed([lang]))
        self.inside = {1: self.words > 0}
        for n in range(2, LONGEST + 1):
            self.inside[n] = self.inside[n - 1][:-1] & self.inside[1][n - 1 :]

    def grams(self, n: int) -> np.ndarray:
        """Hashes of the runs of ``n`` words that start at each place."""
        return gram_hashes(self.hashes[self.words], n) >> np.uint64(64 - HASH_BITS)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk(*(batch.column(c)[i].as_py() for c in range(3)))


def split(texts: pa.Array) -> pa.Array:
    """Words of texts one after the other, with a line end where a piece or a text ends; some words are empty."""
    t = pc.replace_substring(pc.ascii_lower(texts), "\t", " ")
    t = pc.binary_join_element_wise(pc.replace_substring_regex(t, BREAK, " \n "), "", " \n ")
    return pc.split_pattern(t, " ").flatten()


def numbered(lang: str, parts: list[pa.Array]) -> pa.RecordBatch | None:
    """One row of the table of chunks."""
    coded = pa.concat_arrays(parts).dictionary_encode()
    names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    # Line ends become 0, empty words go, and the others are numbered from 1.
    number = np.cumsum([x not in ("", "\n") for x in names]).astype(np.int32)
    number[[i for i, x in enumerate(names) if x == "\n"]] = 0
    number[[i for i, x in enumerate(names) if x == ""]] = -1
    at = number[at]
    return pa.RecordBatch.from_pydict({"lang": [lang], "names": ["\n".join(x for x in names if x not in ("", "\n"))], "words": [at[at >= 0].tobytes()]}, CHUNKS)


def in_chunks(texts: DataFrame) -> DataFrame:
    """All texts as chunks of about ``CHUNK_WORDS`` words of one language."""

    def encode(batches):
        waiting: dict[str, list[pa.Array]] = {}
        size = 0
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                langs, text = pc.fill_null(part.column(0), NOT_GIVEN), pc.fill_null(part.column(1), "")
                for lang in pc.unique(langs).to_pylist():
                    words = split(text.filter(pc.equal(langs, lang)))
                    waiting.setdefault(lang, []).append(words)
                    size += len(words)
                if size >= CHUNK_WORDS:
                    yield from (numbered(*x) for x in waiting.items())
                    waiting, size = {}, 0
        yield from (numbered(*x) for x in waiting.items())

    # Rows of megabytes: the writer has to look at the size of a page after each, not after a hundred.
    one = {"parquet.page.size.row.check.min": "1", "parquet.block.size": HELD_BYTES}
    return staged(texts.mapInArrow(encode, "lang string, names string, words binary"), "phrases-chunks", **one)


class Bitmap:
    """A set of hashes; it may hold others by chance."""

    def __init__(self, data: bytes):
        self.bits = np.frombuffer(data, np.uint8)
        self.mask = np.uint64(8 * len(data) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for at in (h & self.mask, (h >> np.uint64(20)) & self.mask):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def bitmap(hashes: DataFrame) -> bytes:
    """Bitmap of a column ``hash``: a power of two of bits, no more than ``MOST_BITS``."""
    bits = min(MOST_BITS, 1 << max(15, (BITS_EACH * hashes.count()).bit_length()))
    probes = F.array(F.col("hash"), F.shiftrightunsigned("hash", 20))
    # The numbering of Spark's bitmaps begins at 1.
    at = hashes.select(F.explode(probes).alias("h")).select((F.col("h").bitwiseAND(F.lit(bits - 1)) + 1).alias("at"))
    pages = at.groupBy(F.bitmap_bucket_number("at").alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = bytearray(bits // 8)
    for page, part in pages.toLocalIterator():
        out[(page - 1) * len(part) : page * len(part)] = part
    return bytes(out)


def narrow(x: np.ndarray, kind: type) -> bytes:
    """Numbers in the bytes of a type if they all fit, else in eight bytes each; the first byte tells."""
    small = not len(x) or x.max() <= np.iinfo(kind).max
    return bytes([int(small)]) + x.astype(kind if small else np.uint64).tobytes()


def wide(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(x, kind if x[0] else np.uint64, offset=1).astype(np.uint64)


def summed(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, with the sum of their counts."""
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
    return h[new], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


class Summary:
    """Misra-Gries counters of one partition. What a hash has lost is at most mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.h, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, h: np.ndarray, counts: np.ndarray) -> None:
        """Take a chunk's part. Parts wait until they are as large as the summary: each is sorted in a bounded number of times."""
        self.waiting.append((h, counts))
        self.size += len(h)
        if self.size > self.capacity:
            self.merge()

    def merge(self) -> None:
        waiting, self.waiting, self.size = [(self.h, self.counts), *self.waiting], [], 0
        self.h, self.counts = summed(*(np.concatenate(x) for x in zip(*waiting)))
        if len(self.h) > self.capacity:
            most = np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1]
            stay = self.counts > most
            self.h, self.counts = self.h[stay], self.counts[stay] - most


def capacity_of(mass: int, least: int) -> int:
    return SPARE * (mass // least + 1)


def by_partition(h: np.ndarray, counts: np.ndarray, partitions: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``GRAMS`` for sorted hashes. Partitions are ranges of hashes, so those of one stand together."""
    part = ((h >> np.uint64(HASH_BITS - 32)) * np.uint64(partitions) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    steps = np.diff(h, prepend=h[:1])
    ends = np.append(starts[1:], len(part))
    for i in range(0, len(starts), 10_000):
        s, e = starts[i : i + 10_000], ends[i : i + 10_000]
        yield pa.RecordBatch.from_pydict({
            "partition": pa.array(part[s]), "mass": pa.array([int(counts[a:b].sum()) for a, b in zip(s, e)], pa.int64()), "first": pa.array(h[s].view(np.int64)),
            "steps": pa.array([narrow(steps[a + 1 : b], np.uint32) for a, b in zip(s, e)], pa.binary()),
            "counts": pa.array([narrow(counts[a:b], np.uint8) for a, b in zip(s, e)], pa.binary()),
        })


def stayed(encoded: DataFrame, lengths: tuple[int, ...], least: int, partitions: int, pairs: bytes | None = None) -> DataFrame:
    """Hashes of n-grams of some lengths that may occur ``least`` times: all of those that do, and some that come near.

    With ``pairs``, a bitmap of pairs, only n-grams whose pairs are all in it take part.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(pairs) if pairs is not None else None

    def count(batches):
        known = Bitmap(shared.value) if shared is not None else None
        for chunk in chunks(batches):
            pair = known.has(chunk.grams(2)) if known is not None else None
            for n in lengths:
                inside = chunk.inside[n]
                if known is not None:
                    inside = inside.copy()
                    for i in range(n - 1):
                        inside &= pair[i : i + len(inside)]
                yield from by_partition(*np.unique(chunk.grams(n)[inside], return_counts=True), partitions)

    def merge(batches):
        summary, at, lost = None, None, 0

        def given():
            summary.merge()
            close = summary.counts >= least - lost
            return pa.RecordBatch.from_pydict({"hash": pa.array(summary.h[close].view(np.int64))})

        for batch in batches:
            for row in range(batch.num_rows):
                partition, mass, first, steps, counts = (batch.column(c)[row].as_py() for c in range(5))
                if partition != at:
                    if summary is not None:
                        yield given()
                    at, summary = partition, Summary(capacity_of(mass, least))
                    lost = mass // (summary.capacity + 1)
                steps, counts = wide(steps, np.uint32), wide(counts, np.uint8)
                summary.add(np.uint64(first) + np.cumsum(np.append(np.uint64(0), steps)), counts.astype(np.int64))
        if summary is not None:
            yield given()

    grams = staged(encoded.mapInArrow(count, GRAMS), "phrases-grams", **{"parquet.block.size": HELD_BYTES})
    mass = grams.groupBy("partition").agg(F.sum("mass").alias("whole"))
    rows = grams.join(mass, "partition").select("partition", F.col("whole").alias("mass"), "first", "steps", "counts")
    # A partition's rows stand together in one task: the capacity holds for all of its mass.
    rows = rows.repartition(partitions, "partition").sortWithinPartitions("partition")
    return staged(rows.mapInArrow(merge, "hash long"), "phrases-stayed")


def exact(encoded: DataFrame, least: int, kept: bytes) -> DataFrame:
    """``lang``, ``phrase``, ``words`` (how many) and ``f`` for all phrases and words that occur ``least`` times, and ``f`` of all words under a null phrase."""
    shared = encoded.sparkSession.sparkContext.broadcast(kept)

    def count(batches):
        known = Bitmap(shared.value)
        for chunk in chunks(batches):
            phrases, words, f = [None], [0], [int(chunk.inside[1].sum())]
            for n in range(1, LONGEST + 1):
                place = np.flatnonzero(chunk.inside[n])
                place = place[known.has(chunk.grams(n)[place])]
                # Equal keys are equal words: each step numbers what was met so far and adds one word.
                key = chunk.words[place].astype(np.int64)
                for i in range(1, n):
                    key = np.unique(key, return_inverse=True)[1] * len(chunk.names) + chunk.words[place + i]
                _, first, counts = np.unique(key, return_index=True, return_counts=True)
                place = place[first]
                phrases += [" ".join(x) for x in zip(*([chunk.names[w] for w in chunk.words[place + i]] for i in range(n)))]
                words += [n] * len(place)
                f += counts.tolist()
            yield pa.RecordBatch.from_pydict(
                {"lang": [chunk.lang] * len(f), "phrase": phrases, "words": words, "f": f},
                pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())]),
            )

    counted = encoded.mapInArrow(count, "lang string, phrase string, words int, f long")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("phrase").isNull() | (F.col("f") >= least))


def scored(counts: DataFrame) -> DataFrame:
    """Phrases with ``a``, and ``l``, ``r`` and ``score`` of their lowest-scoring cut, the shortest first part on ties."""
    phrases = counts.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("ws"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ws") - 1))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("ws", F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice("ws", F.col("k") + 1, F.size("ws") - F.col("k")), " ").alias("rest"),
    )
    part = counts.where("words between 1 and 3").select(F.struct("lang", "phrase").alias("part"), "f")
    cuts = cuts.withColumn("part", F.struct("lang", F.col("first").alias("phrase"))).join(part, "part").withColumnRenamed("f", "l").drop("part")
    cuts = cuts.withColumn("part", F.struct("lang", F.col("rest").alias("phrase"))).join(part, "part").withColumnRenamed("f", "r")
    score = F.expr("(2000000BD * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def within_longer(counts: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` and ``longer``: the occurrences of the most frequent longer candidate that a phrase's words stand in."""
    long = counts.where("words > 2").select("lang", F.split("phrase", " ").alias("ws"), "words", "f")
    size = long.withColumn("n", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = size.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1)))
    return inner.select("lang", F.array_join(F.slice("ws", F.col("i"), F.col("n")), " ").alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def counts_of(texts: DataFrame, least: int) -> DataFrame:
    """What ``exact`` gives, staged."""
    encoded = in_chunks(texts)
    # Words and the pairs they begin.
    mass = 2 * (encoded.agg(F.sum(F.length("words"))).first()[0] or 0) // 4
    partitions = max(1, -(-mass // PARTITION_MASS))
    short = stayed(encoded, (1, 2), least, partitions)
    long = stayed(encoded, (3, 4), least, partitions, bitmap(short))
    return staged(exact(encoded, least, bitmap(short.union(long))), "phrases-counts")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Stages that run inside pass no more than ``BATCH_BYTES`` to Python at once, unless one row is larger."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)


def collocations(df: DataFrame, top: int = 2000, least: int = 30, lang: str = "lang", text: str = "text") -> DataFrame:
    """The ``top`` phrases of each language by score, then occurrences, then bytes: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n`` (words of the language), ``score``."""
    texts = df.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    # All that runs in Python is done when this ends.
    with small_batches(df.sparkSession):
        counts = counts_of(texts, least)
    total = counts.where("phrase is null").select("lang", F.col("f").alias("n"))
    found = scored(counts).join(within_longer(counts), ["lang", "phrase"], "left")
    found = found.where("longer is null or 100BD * cast(longer as decimal(20,0)) < 80BD * cast(a as decimal(20,0))")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
