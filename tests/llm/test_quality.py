import random
import re
from collections import Counter

from pyspark.sql import functions as F

from helpers import ODD, SF, documents, words
from rillmark.llm import quality

NATIVE = re.compile("Python|Pandas|Arrow")


def base(text):
    text, own = text or "", words(text)
    runs = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    times = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = ["a b c a b c", "a a a a a", "x a b c d a b c y a b", "a b c d", "l\nl\n l\nl", "a b c " * 400, " ".join(map(str, range(60))), "é 𝔘 $ # é 𝔘 $ #"]


def test_base(spark):
    texts = ODD + TEXTS
    rows = {r["doc_id"]: r for r in quality.judge(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        want = base(text)
        assert tuple(rows[i][k] for k in quality.BASE) == want, text
        assert rows[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (rows[i]["base_failed"] and rows[i]["kept"])
    assert quality.judge(documents(spark, texts).limit(0)).count() == 0


def test_given_documents_and_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = quality.judge(docs)
    rows = {r["doc_id"]: r for r in judged.collect()}
    for r in docs.collect():
        assert tuple(rows[r["doc_id"]][k] for k in quality.BASE) == base(r["text"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    long = [x for x in labels if not rows[x["doc_id"]]["base_failed"]]
    assert sum(rows[x["doc_id"]]["kept"] == (x["quality"] == 1) for x in long) >= 0.98 * len(long)


def test_keep_filters_rows_as_judged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in quality.judge(docs).where("kept").select("doc_id").collect())
    odd = documents(spark, ODD)
    assert quality.keep(odd.union(odd)).count() == 2 * quality.keep(odd).count()


def test_plan_is_native(spark):
    plan = quality.keep(documents(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not NATIVE.search(plan)


def test_estimates_accuracies(spark):
    """Votes drawn with known accuracies: the estimates come near them, and the verdict beats the best rule."""
    draw = random.Random(7)
    accuracies = {"a": 0.95, "b": 0.85, "c": 0.75, "d": 0.6, "e": 0.9}
    truth = [draw.random() < 0.7 for _ in range(4000)]
    rows = [tuple((1 if t == (draw.random() < p) else -1) if draw.random() < 0.8 else 0 for p in accuracies.values()) + (t,) for t in truth]
    votes = spark.createDataFrame(rows, ", ".join(f"{r} int" for r in accuracies) + ", truth boolean")
    model = quality.fit(votes, list(accuracies), steps=60)
    assert abs(model.good - 0.7) < 0.05
    for r, p in accuracies.items():
        good, bad = model.votes[r][1][0], model.votes[r][-1][0]
        assert abs(good / (good + bad) - p) < 0.06
    right = votes.where((model.probability({r: F.col(r) for r in accuracies}) >= 0.5) == F.col("truth")).count()
    assert right / len(rows) > 0.9
