"""Key-value cache whose expired entries are removed from disk, folder by folder.

Entries lie in a folder for each day on which they are gone for certain: the day they were written plus the longest life an entry of
the cache may have. So a newer entry of a key is never gone before an older one, a read may pass over the folders of
past days, and removing these whole brings back nothing that was overwritten.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import latest
from .stores import KV_SCHEMA, live_entries

KEY = ["kv_table", "tenant", "key"]
GONE, WRITTEN = "gone_after", "written_at"


class KeyValueCache:
    """``longest_days`` is the longest life of an entry; a longer one is an error."""

    def __init__(self, spark: SparkSession, path: str, longest_days: int = 30):
        self.spark, self.path, self.longest_days = spark, path.rstrip("/"), longest_days

    def write(self, entries: DataFrame, now: Column | None = None) -> None:
        """Add entries (``kv_rows``); of a key the one written last counts."""
        now = F.current_timestamp() if now is None else now
        end = now + F.make_dt_interval(F.lit(self.longest_days))
        lives = F.assert_true(F.col("expires_at") <= end, F.lit("an entry lives longer than the cache allows"))
        rows = entries.where(lives.isNull()).withColumns({WRITTEN: now, GONE: F.to_date(end)})
        rows.write.mode("append").partitionBy(GONE).parquet(self.path)

    def stored(self) -> DataFrame:
        """All entries on disk, overwritten and expired ones too."""
        return self.spark.read.schema(f"{KV_SCHEMA}, {WRITTEN} timestamp, {GONE} date").parquet(self.path)

    def read(self, now: datetime.datetime) -> DataFrame:
        """The entries that live at a time. Folders of past days are not opened."""
        rows = self.stored().where(F.col(GONE) >= F.lit(now.date()))
        return live_entries(latest(rows, KEY, [WRITTEN, "expires_at", "value"]), F.lit(now)).drop(WRITTEN, GONE)

    def drop_expired(self, now: datetime.datetime) -> list[str]:
        """Remove the folders of days before a time; the days removed. No entry in them lives, nor any older one they hide."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = {s.getPath().getName().split("=", 1)[1]: s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{GONE}=")}
        old = sorted(d for d in found if d < now.date().isoformat())
        for day in old:
            fs.delete(found[day], True)
        return old
