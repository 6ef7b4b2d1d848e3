"""Functions over whole windows, and messages delivered more than once, batch by batch."""

import datetime

from pyspark.sql import functions as F
from rows import values

from rillmark.session import work_path
from rillmark.sources.changes import without_redelivery
from rillmark.streaming.windows import whole_window_function, with_event_time

MINUTE = 60_000


class Feed:
    """A file stream that is run after each batch, from one checkpoint."""

    def __init__(self, spark, schema, build):
        self.spark, self.schema, self.build = spark, schema, build
        self.path, self.out = work_path(spark, "feed"), work_path(spark, "fed")

    def give(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.path)
        df = self.build(self.spark.readStream.schema(self.schema).parquet(self.path))
        run = df.writeStream.format("parquet").option("path", self.out).option("checkpointLocation", f"{self.out}-c")
        run.trigger(availableNow=True).start().awaitTermination()
        return sorted(values(self.spark.read.schema(df.schema).parquet(self.out)), key=repr)


def test_whole_windows_with_late_and_repeated_records(spark):
    def summary(elements):
        import pandas as pd

        # The order of arrival cannot be told from parts, and neither can a median.
        return pd.DataFrame({"ids": ["".join(elements["id"])], "middle": [elements["v"].median()]})

    def build(stream):
        timed = with_event_time(stream, delay="30 seconds")
        out = whole_window_function(timed, "60 seconds", "event_time", ["k"], ["id"], ["v"], summary, "ids string, middle double")
        return out.select(F.unix_seconds("window_start").alias("s"), "k", "ids", "middle")

    feed = Feed(spark, "id string, k string, v double, opttime string", build)
    at = lambda minute, second=0: str(minute * MINUTE + second * 1000)
    assert feed.give(("a", "x", 1.0, at(10, 5)), ("b", "x", None, at(10, 1)), ("c", "y", 3.0, at(10, 2))) == []
    # Late but in an open window; repeated within a batch and over batches; the window is open for the delay.
    assert feed.give(("d", "x", 9.0, at(10)), ("d", "x", 9.0, at(10)), ("a", "x", 1.0, at(10, 5)), ("e", "x", 7.0, at(11, 20))) == []
    # The watermark reaches the end of the first window.
    first = [(600, "x", "abd", 5.0), (600, "y", "c", 3.0)]
    assert feed.give(("f", "x", 2.0, at(11, 31))) == first
    # Too late, and a window that has been given is not given again; the next one closes.
    assert feed.give(("g", "x", 100.0, at(10, 59)), ("h", "x", 3.0, at(11, 59))) == first
    assert feed.give(("i", "z", 1.0, at(30))) == [*first, (660, "x", "efh", 3.0)]


def test_whole_windows_without_a_time_or_a_key(spark):
    def count(elements):
        import pandas as pd

        return pd.DataFrame({"n": [len(elements)]})

    def build(stream):
        return whole_window_function(with_event_time(stream), "60 seconds", "event_time", ["k"], ["id"], [], count, "n bigint").select("k", "n")

    feed = Feed(spark, "id bigint, k string, opttime string", build)
    big = (1 << 62) + 1
    assert feed.give((big, None, "0"), (big + 1, None, "1000"), (None, None, "2000"), (1, "a", None), (2, "a", "soon"), (3, "b", str(5 * MINUTE))) == [(None, 3)]


def test_messages_delivered_again_are_given_once(spark):
    feed = Feed(spark, "topic string, partition int, offset bigint, value string, timestamp timestamp", lambda s: without_redelivery(s, "10 minutes").select("offset", "value"))
    at = lambda minute: datetime.datetime(2024, 1, 1, 0, minute)
    assert feed.give(("t", 0, 1, "a", at(0)), ("t", 0, 1, "a", at(0)), ("t", 1, 1, "b", at(0))) == [(1, "a"), (1, "b")]
    assert feed.give(("t", 0, 1, "a", at(5)), ("t", 0, 2, "c", at(9))) == [(1, "a"), (1, "b"), (2, "c")]
    assert feed.give(("t", 0, 3, "d", at(40))) == [(1, "a"), (1, "b"), (2, "c"), (3, "d")]
    # State keeps what is not older than the delay, so this one is known no more.
    assert feed.give(("t", 0, 1, "a", at(41))) == [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, "d")]
