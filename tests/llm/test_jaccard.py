import random
import time

import numpy as np
import pytest

from helpers import ODD, SF, documents, lower, words
from rillmark.llm import jaccard
from rillmark.llm.graph import components


def shingles(text, n=4):
    own = words(lower(text))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if len(own) >= n else ({tuple(own)} if own else set())


def brute(rows, percent=85):
    """All pairs compared, groups by following links."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sorted((str(i), len(s), str(top(i))) for i, s in sets)


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def edited(draw, base, share):
    return [draw.choice("uvwxyz") + str(draw.randrange(1000)) if draw.random() < share else w for w in base]


@pytest.mark.parametrize("many", [3, 32])
def test_against_all_pairs(spark, many):
    draw = random.Random(many)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [f"p{i}" for i in range(40)]
    texts = list(ODD) + ["A b C", "a b c", "a b"]
    for _ in range(6):
        base = draw.choices(vocabulary, k=draw.choice([30, 80, 150]))
        texts += [" ".join(edited(draw, base, draw.choice([0, 0.005, 0.01, 0.02, 0.04]))) for _ in range(9)]
    texts += [" ".join(draw.choices(vocabulary, k=45) + passage + draw.choices(vocabulary, k=15)) for _ in range(25)]
    texts += [" ".join(passage + draw.choices(vocabulary, k=k)) for k in (0, 1, 2, 3, 4, 5, 6) for _ in range(2)]
    draw.shuffle(texts)
    df = documents(spark, texts).repartition(3)
    _, out = jaccard.join(df, many=many)
    assert got(out) == brute(list(enumerate(texts)))


def test_repeated_null_and_empty(spark):
    df = documents(spark, ["a b c d e", None, "A B C D E", ""])
    df = df.union(df).union(df.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars", "id", "spans"))
    _, out = jaccard.join(df)
    assert got(out) == sorted([("0", 2, "0"), ("1", 0, "1"), ("2", 2, "0"), ("3", 0, "3")] * 2 + [("None", 2, "None"), ("None", 0, "None")] * 2)
    assert jaccard.join(df.limit(0))[1].count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, out = jaccard.join(docs)
    assert got(out) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_bitmap_bound_never_rules_out_a_link():
    draw = np.random.default_rng(3)
    for size in (1, 5, 40, 400, 3000):
        a = np.unique(draw.integers(-(2**62), 2**62, size))
        for share in (0, 0.02, 0.08, 0.5):
            b = np.unique(np.concatenate([a[draw.random(len(a)) >= share], draw.integers(-(2**62), 2**62, int(share * size))]))
            assert jaccard.differ(jaccard.bitmap(a), jaccard.bitmap(b)) <= len(np.setxor1d(a, b))
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 85 * (len(a) + len(b) - shared):
                assert jaccard.similar(a, b, 85) and jaccard.may_link(jaccard.differ(jaccard.bitmap(a), jaccard.bitmap(b)), len(a), len(b), 85)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (300, 300)]
    random.Random(1).shuffle(links)
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_of_texts_in_any_script_cost_the_same():
    """Capitals beside letters that are not ASCII are no slow path, and texts hashed together get the sets they get alone."""
    draw = random.Random(6)
    plain = [" ".join(f"{draw.randrange(1000)}" + "aB" * 20 for _ in range(300)) for _ in range(100)]
    texts = [*ODD, *plain[:5], "a", None, "a b c d", "a b c", "a b c d a b c d"]
    assert [s.tolist() for s in jaccard.token_sets(texts, 4)] == [jaccard.token_set(t, 4).tolist() for t in texts]
    assert [len(s) for s in jaccard.token_sets(texts, 4)] == [len(shingles(t)) for t in texts]

    def seconds(texts):
        begun = time.process_time()
        for text in texts:
            jaccard.token_set(text, 4)
        return time.process_time() - begun

    assert min(seconds([t + " é" for t in plain]) for _ in range(3)) < 2 * max(seconds(plain) for _ in range(3))
