"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on all that the one before it kept and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm import jaccard, leaks, packing, quality, secrets
from rillmark.llm.common import staged, table
from rillmark.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality stay."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; documents without an id are in no group.

    Near copies share 80 % or more of their runs of five words; four words and 85 % are the rule of the op8 query alone.
    """
    return jaccard.one_of_each(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and texts counted anew."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences for training."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scans),
    ("packing", packed),
]

# Estimated models, alignments and tokens are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        if k:
            docs = staged(docs, f"stage-{k}")
        docs = stage(spark, docs, sf_dir)
    return docs
