"""What several operators share."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rillmark.session import work_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_words(text: str | None) -> list[bytes]:
    """The matches of ``WORD`` in UTF-8, A-Z lower-cased: on bytes ``split`` knows no other white space and ``lower`` no other letters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def arrow_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    return spark.createDataFrame([], schema).toArrow().schema


def exact_pandas(data: pa.RecordBatch | pa.Table) -> pd.DataFrame:
    """A pandas frame in which whole numbers beside NULL are objects: as floats they would lose all but 53 bits."""
    return data.to_pandas(integer_object_nulls=True)


def map_frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | StructType) -> DataFrame:
    """``mapInPandas`` by which whole numbers come through exactly, beside NULL too. Frames made of rows must be made as objects."""
    target = arrow_schema(df.sparkSession, schema)

    def frames(batches):
        for pdf in run(exact_pandas(b) for b in batches):
            yield pa.RecordBatch.from_pandas(pdf, target, preserve_index=False)

    return df.mapInArrow(frames, schema)


def slices(batches: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    """Smaller batches: what is made of the texts of a batch is held at once."""
    for pdf in batches:
        for at in range(0, len(pdf), rows):
            yield pdf.iloc[at : at + rows]


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: cuts lineage and survives lost executors. ``options`` are the writer's."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_values() -> dict:
    return sys.modules.setdefault("_rillmark_kept", types.ModuleType("_rillmark_kept")).__dict__.setdefault("values", {})


def per_process(key, make):
    """A value kept by a worker process from one task to the next; tasks may not rely on it being there.

    A worker keeps only the one it used last: what an earlier stage left must not add to the memory of the next.
    """
    kept = kept_values()
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def forget() -> None:
    """Give back what earlier stages left with this worker process; for stages that keep nothing themselves."""
    if kept_values():
        kept_values().clear()
        pa.default_memory_pool().release_unused()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, as in ``WordIds``. Texts have so many rare words that keeping hashes costs more than making them again."""
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


class WordIds(dict):
    """64-bit hash of each word seen, kept while there are at most ``most`` of them (a cache: dropping it changes no value)."""

    def __init__(self, most: int = 200_000):
        self.most = most

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` words, from the words' hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    size = len(h) - n + 1
    out = mixed(h[:size])
    for i in range(1, n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + size])
    return out
