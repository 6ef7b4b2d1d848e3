"""Quality of documents by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0). How often a rule gives each vote to good and to bad documents is estimated by
expectation-maximisation, without labels: the data are the counts of the vote patterns, at most 3 to the number of rules, however
many documents there are. A document's posterior probability then weighs all votes at once, so a single rule seldom decides.

Defined cases: a null or empty text has no words and fails the base rule; every input row is judged by itself, so repeated rows and null
ids change nothing; with no rows there is nothing to estimate and the start values stand; other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

SPACE = " \t\n\u000b\u000c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ODD_ENDS = list("#*$%&|<>!")
SENTENCE_ENDS = list(".?!\u2026\u3002")
# Common words of the languages of the corpus.
STOP = (
    "the of and to in a is that for it with as was on are be by this have from or at not an "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an "
    "de la le et les des en un du une que est pour qui dans par sur pas plus au avec "
    "el los y del se las por con no su para al lo como o"
).split()


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeat_words(words: Column) -> Column:
    """How many words lie in a run of three words that the array has more than once. Runs are compared by their 64-bit hash."""

    def covered(hashes):
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s):
            return F.sort_array(F.transform(
                F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
                lambda x: x["i"],
            ))

        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
        total = F.aggregate(let(ordered, positions), start, lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(3), p - a["last"])).alias("total")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(total["total"])

    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def measures(text: Column) -> Column:
    """A struct of everything the rules look at."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, SPACE) != "")

    def all_of(w, lines, length):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(without(text, SPACE)).cast("long").alias("word_chars"),
            (length - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (length - F.length(without(text, CAPITALS))).cast("long").alias("n_capitals"),
            (length - F.length(without(text, "!"))).cast("long").alias("n_bangs"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP))).cast("long").alias("n_stops"),
            (length - F.length(without(text, MARKS))).cast("long").alias("n_marks"),
            F.size(F.filter(w, lambda x: F.right(x, F.lit(1)).isin(ODD_ENDS))).cast("long").alias("n_odd_ends"),
            F.size(F.filter(w, lambda x: F.right(x, F.lit(1)).isin(SENTENCE_ENDS))).cast("long").alias("n_sentences"),
        )

    return let(words, lambda w: let(lines, lambda n: all_of(w, n, F.length(text))))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_failed(m: str = "m") -> Column:
    return (F.col(f"{m}.n_words") < 50) | (100 * F.col(f"{m}.n_repeat_words") > 50 * F.col(f"{m}.n_words"))


def rules(m: str = "m") -> dict[str, Column]:
    """The votes, by rule: 1 good, -1 bad, 0 abstains."""
    n = {k: F.col(f"{m}.{k}").cast("double") for k in [*BASE, "n_lines", "n_capitals", "n_bangs", "n_stops", "n_marks", "n_odd_ends", "n_sentences"]}
    w, c = F.greatest(n["n_words"], F.lit(1.0)), F.greatest(n["word_chars"], F.lit(1.0))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        # Several rules see each kind of junk, from different sides: that is what lets their agreement tell how good they are.
        "length": vote(n["n_words"] >= 80, n["n_words"] < 20),
        "symbols": vote(n["n_symbols"] <= 0.02 * w, n["n_symbols"] > 0.1 * w),
        "capitals": vote(n["n_capitals"] <= 0.1 * c, n["n_capitals"] > 0.4 * c),
        "bangs": vote(n["n_bangs"] <= 0.01 * w, n["n_bangs"] > 0.1 * w),
        "marks": vote(n["n_marks"] <= 0.06 * c, n["n_marks"] > 0.12 * c),
        "odd_ends": vote(n["n_odd_ends"] <= 0.02 * w, n["n_odd_ends"] > 0.2 * w),
        "sentences": vote(n["n_sentences"] >= 0.03 * w, (n["n_sentences"] < 0.01 * w) & (n["n_words"] >= 50)),
        "repeats": vote(n["n_repeat_words"] <= 0.15 * w, n["n_repeat_words"] > 0.4 * w),
        "lines": vote(n["n_dup_lines"] <= 0.1 * n["n_lines"], n["n_dup_lines"] > 0.3 * n["n_lines"]),
        "word_length": vote((c >= 3 * w) & (c <= 9 * w), (c < 2 * w) | (c > 14 * w)),
        "stop_words": vote(n["n_stops"] >= 0.1 * w, (n["n_stops"] < 0.02 * w) & (n["n_words"] >= 20)),
    }


@dataclass(frozen=True)
class Model:
    """Probability of good, and of each vote of each rule for good and for bad documents."""

    good: float
    votes: dict[str, dict[int, tuple[float, float]]]

    def log_odds(self, votes: dict[str, Column]) -> Column:
        def weight(rule):
            w = {v: F.log(F.lit(g)) - F.log(F.lit(b)) for v, (g, b) in self.votes[rule].items()}
            return F.when(votes[rule] == 1, w[1]).when(votes[rule] == -1, w[-1]).otherwise(w[0])

        return reduce(lambda a, b: a + b, map(weight, votes), F.log(F.lit(self.good)) - F.log(F.lit(1 - self.good)))

    def probability(self, votes: dict[str, Column]) -> Column:
        return 1 / (1 + F.exp(-self.log_odds(votes)))


def start(names) -> Model:
    """Rules are right more often than not: that is what tells good from bad."""
    return Model(0.8, {r: {1: (0.85, 0.5), 0: (0.13, 0.15), -1: (0.02, 0.35)} for r in names})


def fit(votes: DataFrame, names, steps: int = 60) -> Model:
    """Estimate the model from vote columns in ``steps`` steps of expectation-maximisation.

    The counts of the vote patterns are one array of at most 3 to the number of rules elements; each step is a fold over it.
    """
    names, n = list(names), len(names)
    first = start(names)

    def flat(side):
        return F.array(*(F.lit(float(first.votes[r][v][side])) for r in names for v in (-1, 0, 1)))

    # The vote of rule r is slot 3 r + 1 + vote of the probabilities.
    slots = F.array(*(F.lit(3 * i + 1) + F.col(r) for i, r in enumerate(names)))
    patterns = votes.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n"))
    patterns = patterns.agg(F.collect_list(F.struct("n", slots.alias("slots"))).alias("patterns"))

    def step(model, _):
        def weighed(p):
            odds = F.aggregate(p["slots"], F.log(model["good"] / (1 - model["good"])), lambda a, k: a + F.log(F.get(model["g"], k)) - F.log(F.get(model["b"], k)))
            q = 1 / (1 + F.exp(-odds))
            return F.struct(p["slots"].alias("slots"), (p["n"] * q).alias("g"), (p["n"] * (1 - q)).alias("b"))

        def total(all, side):
            return F.aggregate(all, F.lit(0.0), lambda a, p: a + p[side])

        def share(all, side, whole):
            def of(k):
                mine = F.aggregate(all, F.lit(1.0), lambda a, p: a + F.when(F.get(p["slots"], F.floor(k / 3).cast("int")) == k, p[side]).otherwise(0.0))
                return mine / (whole + 3.0)

            return F.transform(F.sequence(F.lit(0), F.lit(3 * n - 1)), of)

        # One imagined document per class and vote keeps every probability above nothing.
        def updated(all):
            good, bad = total(all, "g"), total(all, "b")
            return let(F.struct(good.alias("g"), bad.alias("b")), lambda t: F.struct(
                ((t["g"] + 1.0) / (t["g"] + t["b"] + 2.0)).alias("good"), share(all, "g", t["g"]).alias("g"), share(all, "b", t["b"]).alias("b"),
            ))

        return let(F.transform(F.col("patterns"), weighed), updated)

    begin = F.struct(F.lit(float(first.good)).alias("good"), flat(0).alias("g"), flat(1).alias("b"))
    fitted = F.when(F.size("patterns") == 0, begin).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, step))
    m = patterns.select(fitted.alias("m")).first()["m"]
    return Model(m["good"], {r: {v: (m["g"][3 * i + 1 + v], m["b"][3 * i + 1 + v]) for v in (-1, 0, 1)} for i, r in enumerate(names)})


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Per row the id, the base measures, ``base_failed``, the probability of good and whether the row is ``kept``. One pass over the texts."""
    votes = rules()
    measured = docs.select(F.col(id).alias(id), measures(F.col(text)).alias("m"))
    seen = staged(measured.select(id, *(F.col(f"m.{k}").alias(k) for k in BASE), base_failed().alias("base_failed"), *(v.alias(f"vote_{r}") for r, v in votes.items())), "measures")
    names = [f"vote_{r}" for r in votes]
    probability = fit(seen, names).probability({r: F.col(r) for r in names})
    return seen.select(id, *BASE, "base_failed", probability.alias("probability"), (~F.col("base_failed") & (probability >= least)).alias("kept"))


def keep(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of good quality with all their columns. The texts are measured once to fit and once to filter, and never shuffled."""
    votes = rules()
    names = list(votes)
    measured = docs.select(measures(F.col(text)).alias("m"))
    model = fit(measured.select(*(v.alias(r) for r, v in votes.items())), names)
    whole = docs.select(F.struct("*").alias("row"), measures(F.col(text)).alias("m"))
    good = ~base_failed() & (model.probability(votes) >= least)
    return whole.select("row", good.alias("good")).where("good").select("row.*")
