"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Let the runtime choose: sides are broadcast only when their measured size is
# under the threshold, and a join partition that is far too big is split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Open windows may hold more records than fit in executor heaps.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Shuffle files go when their write has ended, not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_folder: str | None = None
_configured: weakref.WeakSet = weakref.WeakSet()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this library relies on, once per session."""
    if spark not in _configured:
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        _configured.add(spark)
    return spark


@contextmanager
def setting(key: str, value: str, *sessions: SparkSession) -> Iterator[None]:
    """A setting that holds inside, and is put back after."""
    before = [(spark, spark.conf.get(key, None)) for spark in dict.fromkeys(sessions)]
    for spark, _ in before:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for spark, old in before:
            spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def shuffles_freed(*sessions: SparkSession):
    """Writes that end inside leave no shuffle files: what one has shuffled is not on disk beside what the next one shuffles."""
    return setting(FREE_SHUFFLES, "true", *sessions)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a temporary
    folder that is removed at exit.
    """
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="rillmark-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return _own_folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable where the cluster set no folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
