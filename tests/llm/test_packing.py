import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helpers import ODD, SF, documents
from rillmark.llm import packing
from rillmark.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")


def check(rows, texts):
    """Every id in one piece, sequences without gaps or overlaps, digests of the whole text's ids."""
    model = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = np.array([*model.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and len({r["tier"] for r in own}) == 1 and at <= own[0]["tier"]


def test_odd_documents(spark):
    texts = dict(enumerate(ODD + ["A<|endoftext|>b 'S ΑΣ İ x y 1234 don't", "q" * 5000]))
    check(packing.pack(documents(spark, list(texts.values())), PATH).collect(), texts)
    assert packing.pack(documents(spark, ODD).limit(0), PATH).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    rows = packing.pack(docs, PATH).collect()
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len({r["sequence_id"] for r in rows if r["tier"] == 2048}) + sum({r["sequence_id"]: r["tier"] for r in rows if r["tier"] < 2048}.values())) > 0.97


def test_repeated_rows(spark):
    df = documents(spark, ["a b c d"])
    rows = packing.pack(df.union(df), PATH).collect()
    assert len(rows) == 2 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 2


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40)))
def test_layouts_use_every_piece_once(counts):
    used = {}
    for lengths, times in packing.layouts(counts, (8, 16, 32, 64)):
        assert times > 0 and sum(lengths) <= 64
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts


def test_workers_give_back_the_words_they_learnt(spark, monkeypatch):
    """What the first pass keeps in a worker is gone once that worker places pieces."""
    runs, real = [], packing.map_frames
    monkeypatch.setattr(packing, "map_frames", lambda df, run, schema: runs.append(run) or real(df, run, schema))
    packing.pack(documents(spark, ["a b c"]), PATH)
    packing.per_process("an encoder", lambda: "kept")
    assert list(runs[-1](iter([]))) == []
    assert packing.per_process("an encoder", lambda: "made again") == "made again"
