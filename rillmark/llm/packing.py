"""Documents packed into training sequences of several lengths.

Full windows of the longest length are cut off each document first. What remains of a document is one piece, routed to the
shortest tier that holds it. Pieces are then combined by length alone: the counts of the at most ``longest`` lengths are all
that the driver sees, and a layout (a list of lengths that share a sequence, and how often it is used) is made from them. Long
tiers are filled first, with shorter pieces in their gaps; a layout of a shorter tier is used only if it fills its tier to the
last token, all else goes to sequences of the longest tier. A piece finds its place by its number among pieces of its length.

Defined cases: a null or empty text is the end token alone; repeated rows are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, forget, map_frames, per_process, staged

TIERS = (256, 512, 1024, 2048)
END = 1
SEPARATORS = re.compile(r"[\x1C-\x1F]")


class Encoder:
    """Little-endian ids of texts, word by word. White space separates tokens of this vocabulary, so a text's ids are its words' ids.

    Ids of words seen are kept in two generations of at most ``most`` words: when the young one is full it becomes the old one,
    and words met again move back. A comma or full stop after letters is a token of its own.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.model, self.most = Tokenizer.from_file(path), most
        self.young, self.old = {}, {}
        self.last = np.zeros(max(self.model.get_vocab().values()) + 1, bool)
        self.last[[i for x, i in self.model.get_vocab().items() if x.endswith("</w>")]] = True
        self.ends = {x: self.packed(self.model.encode(x, add_special_tokens=False).ids) for x in ",."}

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, words: set[str]) -> None:
        """Give every word an entry in the young generation."""
        if len(self.young) + 2 * len(words) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        plain, ended, other = [], [], []
        for w in words.difference(young):
            if (known := old.get(w)) is not None:
                young[w] = known
            elif w.isalpha():
                plain.append(w)
            elif w[-1] in ",." and w[:-1].isalpha():
                ended.append(w)
            else:
                other.append(w)
        self.encode(plain)
        stems = {w[:-1] for w in ended}.difference(young)
        young.update((w, old[w]) for w in stems if w in old)
        self.encode([w for w in stems if w not in young])
        for w in ended:
            young[w] = young[w[:-1]] + self.ends[w[-1]]
        for w, e in zip(other, self.model.encode_batch_fast(other, add_special_tokens=False)):
            young[w] = self.packed(e.ids)

    def encode(self, words: list[str]) -> None:
        """Words of letters only, many at a time: each is one run of tokens, of which the last is marked as a word's end."""
        for at in range(0, len(words), 1000):
            own = words[at : at + 1000]
            (together,) = self.model.encode_batch_fast([" ".join(own)], add_special_tokens=False)
            ids = np.array(together.ids, "<u4")
            cuts = [0, *(4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()]
            if len(cuts) != len(own) + 1:  # a letter that becomes several words
                self.young.update((w, self.packed(self.model.encode(w, add_special_tokens=False).ids)) for w in own)
                continue
            ids = ids.tobytes()
            self.young.update((w, ids[a:b]) for w, a, b in zip(own, cuts, cuts[1:]))

    def __call__(self, texts: Iterable[str | None], most: int = 100_000) -> Iterator[bytes]:
        """Ids of each text; words are learnt for up to ``most`` words of consecutive texts at once, long texts in parts."""
        waiting, n = [], 0
        for text in texts:
            text = text or ""
            # Letters are lower-cased by the tokenizer too, but names of its special tokens are looked for before that.
            lower = text.isascii() and "<|" not in text
            # Among ASCII characters, ``split`` knows four more kinds of white space than ``WORD``.
            words = text.lower().split() if lower and not SEPARATORS.search(text) else WORD.findall(text.lower() if lower else text)
            if n + len(words) > most:
                yield from self.known(waiting)
                waiting, n = [], 0
            if len(words) > most:
                yield b"".join(x for at in range(0, len(words), most) for x in self.known([words[at : at + most]]))
            else:
                waiting.append(words)
                n += len(words)
        yield from self.known(waiting)

    def known(self, texts: list[list[str]]) -> list[bytes]:
        self.learn(set().union(*texts))
        ids = self.young.__getitem__
        return [b"".join(map(ids, words)) for words in texts]


def pieces(df: DataFrame, tokenizer: str, longest: int = TIERS[-1]) -> DataFrame:
    """A row per piece (doc_id, start, length, ids_crc32, doc_tokens), numbered (``rank``) within its task's (``part``) pieces of that length."""
    end = np.array([END], "<u4").tobytes()

    def cut(batches):
        encode = per_process(("encoder", tokenizer), lambda: Encoder(tokenizer))
        part, seen = TaskContext.get().partitionId(), np.zeros(longest + 1, np.int64)
        for pdf in batches:
            rows = []
            for doc, ids in zip(pdf["doc_id"], encode(list(pdf["text"]))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, longest):
                    own = ids[4 * start : 4 * (start + longest)]
                    n = len(own) // 4
                    rows.append((doc, start, n, zlib.crc32(own), total, part, seen[n]))
                    seen[n] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"], dtype=object)

    kind = df.schema["doc_id"].dataType.simpleString()
    return map_frames(df.select("doc_id", "text"), cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part long, rank long")


def layouts(counts: dict[int, int], tiers: tuple[int, ...] = TIERS) -> list[tuple[list[int], int]]:
    """Which lengths share a sequence, and how many such sequences there are; every piece is used once.

    The work grows with the number of lengths, not of pieces: each step uses up a length or leaves less of it than one layout needs.
    """
    left, longest, out = dict(counts), tiers[-1], []

    def filled(first: int, room: int) -> tuple[list[int], int]:
        used, need = [first], {first: 1}
        while room:
            own = next((x for x in range(min(room, longest), 0, -1) if left.get(x, 0) > need.get(x, 0)), 0)
            if not own:
                break
            used.append(own)
            need[own] = need.get(own, 0) + 1
            room -= own
        return used, min(left[x] // n for x, n in need.items())

    def use(lengths: list[int], times: int) -> None:
        out.append((lengths, times))
        for x in lengths:
            left[x] -= times

    for tier in tiers:  # whole windows
        if left.get(tier):
            use([tier], left[tier])
    for tier in reversed(tiers):  # long windows first, gaps filled from shorter tiers; kept if they fill the tier exactly
        for first in range(tier - 1, tier // 2, -1):
            while left.get(first, 0) > 0:
                lengths, times = filled(first, tier - first)
                if sum(lengths) != tier:
                    break
                use(lengths, times)
    for first in range(longest, 0, -1):  # what is left
        while left.get(first, 0) > 0:
            use(*filled(first, longest - first))
    return out


def pack(df: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = 1 << 20) -> DataFrame:
    """One row per piece with its sequence, the offset there, the sequence's tier and its step group.

    A step group holds as many sequences of one tier as make ``step_tokens`` tokens, so all full groups are of equal size.
    """
    cut = staged(pieces(df, tokenizer, tiers[-1]), "pieces")
    per_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = per_part.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most tiers[-1] rows

    firsts, slots, bases, base, used = {}, {}, [], 0, {}
    per_tier: dict[int, int] = {}
    for k, (lengths, times) in enumerate(layouts(counts, tiers)):
        total, offset = sum(lengths), 0
        tier = total if total in tiers else tiers[-1]
        bases.append((base, tier, per_tier.get(tier, 0)))
        base += times
        per_tier[tier] = per_tier.get(tier, 0) + times
        for length in lengths:
            firsts.setdefault(length, []).append(used.get(length, 0))
            slots.setdefault(length, []).append((k, offset))
            used[length] = used.get(length, 0) + times
            offset += length
    firsts = {x: np.array(v, np.int64) for x, v in firsts.items()}
    slots = {x: np.array(v, np.int64) for x, v in slots.items()}
    places = np.array(bases, np.int64).reshape(-1, 3)

    def place(batches):
        forget()  # a worker that waits for its next task would go on holding the words' ids
        for pdf in batches:
            number = (pdf["rank"] + pdf["before"]).to_numpy()
            lengths = pdf["length"].to_numpy()
            sequence, offset, tier, group = (np.zeros(len(pdf), np.int64) for _ in range(4))
            for length in np.unique(lengths):
                own = lengths == length
                at = np.searchsorted(firsts[length], number[own], "right") - 1
                layout, offset[own] = slots[length][at].T
                nth = number[own] - firsts[length][at]
                base, tier[own], before_in_tier = places[layout].T
                sequence[own] = base + nth
                group[own] = (before_in_tier + nth) // (step_tokens // tier[own])
            yield pdf[names].assign(sequence_id=sequence, offset=offset, tier=tier, step_group=group)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kind = cut.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_group long"
    return map_frames(cut.join(before, ["length", "part"]), place, out)
