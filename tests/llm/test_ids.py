"""Ids and other whole numbers of over 53 bits stay exact beside NULL, in every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import SF
from rillmark.llm import chat, extract, jaccard, leaks, lm, packing, phrases, pii, quality, repeats, search, secrets, warc
from rillmark.llm.common import table
from rillmark.llm.queries import tokenizer

BIG = (1 << 62) + 1
TEXT = "the quick brown fox jumps over the lazy dog and runs away. " * 9
ITEM = "one quite unlike sentence about kernels that nobody else has written down so far"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(BIG, TEXT), (None, TEXT), (BIG + 1, TEXT), (5, ITEM), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(BIG, ITEM), (None, ITEM)], "item_id long, text string").coalesce(1)


def ids(df, column="doc_id"):
    return sorted(r[column] for r in df.collect() if r[column] is not None)


def test_operators_of_documents(docs, bench):
    every = [5, BIG, BIG + 1]
    assert ids(lm.score(docs, F.lit(False))) == every
    out = repeats.remove_repeats(docs)
    assert ids(out) == every
    assert {r["doc_id"]: r["n_removed"] > 0 for r in out.collect() if r["doc_id"]} == {5: False, BIG: False, BIG + 1: True}
    assert ids(quality.judge(docs)) == every
    leaked = leaks.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in leaked} == {(5, BIG), (5, None)}
    placed = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs)[1].collect()}
    assert placed == {5: 5, BIG: BIG, BIG + 1: BIG, None: None}
    assert ids(secrets.find_secrets(docs)) == every
    assert ids(packing.pack(docs, tokenizer("word_bpe_49k.json"))) == every
    assert ids(pii.find_personal_data(docs)) == every
    assert phrases.collocations(docs.withColumn("lang", F.lit("en"))).count() >= 0
    assert (BIG, 5) in {(r["item_id"], r["doc_id"]) for r in search.rank(docs, bench).collect()}


def test_pages(spark):
    pages = spark.createDataFrame([(BIG, "u", "<p>a"), (None, "u", "<p>a"), (BIG + 1, "u", "<p>a"), (None, None, None)], "page_id long, url string, html string").coalesce(1)
    index, folder = warc.archive(spark, pages)
    rows = {r["page_id"]: r["refers_to"] for r in warc.read(index, folder).collect() if r["page_id"]}
    assert rows == {BIG: BIG + 1, BIG + 1: None}
    assert ids(extract.main_text(pages), "page_id") == [BIG, BIG + 1]


def test_conversations(spark):
    turns = spark.createDataFrame([(BIG, BIG, "user", "a"), (None, None, "assistant", "b"), (BIG + 1, 0, "user", "a")], "conv_id long, turn long, role string, text string").coalesce(1)
    written = chat.format_turns(chat.from_frame(turns))
    assert ids(written, "conv_id") == [BIG, BIG + 1] and ids(written, "turn") == [0, BIG]
    assert ids(chat.summaries(written), "conv_id") == [BIG, BIG + 1]
    records = spark.createDataFrame([(BIG, '{"prompt": "a", "response": "b"}'), (None, "{}"), (BIG + 2, "x")], "id long, r string").coalesce(1)
    known, other = chat.from_records(records, "id", "r")
    assert ids(known, "conv_id") == [BIG, BIG] and ids(other, "conv_id") == [BIG + 2]


def test_stages_keep_ids_and_other_columns(spark):
    given = table(spark, SF, "documents")
    shifted = given.withColumn("doc_id", F.expr(f"case when doc_id % 50 = 1 then null else doc_id + {BIG} end").cast("long"))
    docs = shifted.withColumn("big", F.when(F.col("doc_id") % 2 == 0, F.lit(BIG))).coalesce(1)
    known = set(ids(docs))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert set(ids(out)) <= known and ids(out), name
        if name != "packing":
            assert {r["big"] for r in out.select("big").collect()} <= {None, BIG}, name
