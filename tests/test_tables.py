import datetime

import pytest
from rows import values
from pyspark.sql import functions as F

from rillmark.operators import keyed, ordering
from rillmark.operators.events import DEAL_KEY, filter_b_changes, join_deal_trades, order_events, order_events_by_op
from rillmark.session import work_path
from rillmark.sinks import jdbc, stores
from rillmark.sinks.keyed_table import KeyedTable
from rillmark.sinks.kv_cache import KeyValueCache

SCHEMA = "k string, a string, b string"


@pytest.fixture
def table(spark):
    def make(**options):
        return KeyedTable(spark, work_path(spark, "table"), SCHEMA, ["k"], buckets=4, **options)

    return make


def rows(df):
    return sorted(values(df), key=repr)


def test_upsert_and_rerun(frame, table):
    t = table()
    t.write_batch(frame("k a b", ("1", "x", "y"), ("2", "x", "y")), 0)
    for _ in range(2):
        t.write_batch(frame("k a b", ("2", "z", None), ("3", "n", "n")), 1)
        assert rows(t.read()) == [("1", "x", "y"), ("2", "z", None), ("3", "n", "n")]


def test_partial_upsert_keeps_absent_columns(spark, frame, table):
    t = table(partial=True)
    t.write_batch(frame("k a b", ("1", "x", "y")), 0)
    t.write_batch(frame("k a", ("1", "z")), 1)
    assert rows(t.read()) == [("1", "z", "y")]
    null_b = spark.createDataFrame([("1", None, None, ["b"])], SCHEMA + ", _present array<string>")
    t.write_batch(null_b, 2)
    assert rows(t.read()) == [("1", "z", None)]
    t.compact()
    t.write_batch(frame("k b", ("1", "w")), 3)
    assert rows(t.read()) == [("1", "z", "w")]


def test_partial_rows_of_one_batch_merge_in_order(frame, table):
    t = table(partial=True)
    t.write_batch(frame("k a b o", ("1", "x", None, "1"), ("1", None, "y", "2"), ("1", "z", None, "3")), 0, order=["o"])
    assert rows(t.read()) == [("1", "z", "y")]


def test_delete_then_write_again(frame, table):
    for partial in (False, True):
        t = table(partial=partial)
        t.write_batch(frame("k a b", ("1", "x", "y"), ("2", "x", "y")), 0)
        t.delete_keys(frame("k", "1"), 1)
        assert rows(t.read()) == [("2", "x", "y")]
        t.write_batch(frame("k a", ("1", "n")), 2)
        assert rows(t.read()) == [("1", "n", None), ("2", "x", "y")]


def test_compact_and_vacuum_change_nothing(spark, table):
    t = table()
    for batch in range(4):
        df = spark.range(200).where(F.col("id") % 4 >= batch).select(F.col("id").cast("string").alias("k"), F.lit(str(batch)).alias("a"))
        t.write_batch(df, batch)
        if batch == 2:
            t.compact()
    before = rows(t.read())
    assert len(before) == 200
    t.compact()
    assert rows(t.read()) == before
    t.vacuum()
    assert rows(t.read()) == before
    assert not t._batches("changes")


def test_bucket_values_with_special_characters(spark, frame):
    t = KeyedTable(spark, work_path(spark, "odd"), SCHEMA, ["k"], bucket="k")
    t.write_batch(frame("k a", ("a:b/c", "x"), ("50%", "x"), ("", "x")), 0)
    t.compact()
    t.write_batch(frame("k a", ("50%", "y"), ("a:b/c", "y")), 1)
    t.compact()
    want = [("", "x", None), ("50%", "y", None), ("a:b/c", "y", None)]
    assert rows(t.read()) == want
    assert rows(t.read(frame("k", "50%", ""))) == want[:2]


def test_compaction_rewrites_touched_buckets_only(spark, frame):
    path = work_path(spark, "months")
    t = KeyedTable(spark, path, SCHEMA, ["k"], bucket="substr(k, 1, 1)")
    t.write_batch(frame("k a", ("a1", "x"), ("b1", "x"), ("c1", "x")), 0)
    t.compact()
    t.write_batch(frame("k a", ("b2", "y")), 1)
    t.delete_keys(frame("k", "c1"), 2)
    t.compact()
    assert set(t._folders(f"{path}/base/batch=2")) == {"b", "c"}
    want = [("a1", "x", None), ("b1", "x", None), ("b2", "y", None)]
    assert rows(t.read()) == want
    assert rows(t.read(frame("k", "c1", "b1"))) == want[1:2]
    t.vacuum()
    assert rows(t.read()) == want
    t.write_batch(frame("k a", ("c2", "z")), 3)
    t.compact()
    t.vacuum()
    assert rows(t.read()) == [*want, ("c2", "z", None)]


def test_maintain_compacts_when_many_batches_wait(frame, table):
    for partial in (False, True):
        t = table(partial=partial)
        for batch in range(4):
            t.write_batch(frame("k a", (str(batch), "x")), batch)
            t.maintain(most_changes=2)
        assert list(t._batches("base")) == [2]
        assert t.read().count() == 4


def test_read_by_keys(spark, frame, table):
    t = table()
    t.write_batch(spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("a")), 0)
    t.compact()
    t.write_batch(frame("k a", ("7", "new"), ("900", "new")), 1)
    found = t.read(frame("k", "7", "8", "900", "none"))
    assert rows(found) == [("7", "new", None), ("8", "x", None), ("900", "new", None)]


def test_version_beats_arrival(frame, table):
    t = table(version=["a"])
    t.write_batch(frame("k a b", ("1", "2019-02", "late")), 0)
    t.write_batch(frame("k a b", ("1", "2019-01", "early")), 1)
    assert rows(t.read()) == [("1", "2019-02", "late")]


def test_unfinished_batch_is_not_read(spark, frame, table):
    t = table()
    t.write_batch(frame("k a b", ("1", "x", "y")), 0)
    frame("k a b", ("9", "x", "y")).withColumn("_deleted", F.lit(False)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{t.path}/changes/batch=1")
    assert rows(t.read()) == [("1", "x", "y")]


def test_create_and_drop(table):
    t = table()
    assert not t.exists()
    t.create()
    assert t.exists() and t.read().count() == 0
    t.drop()
    assert not t.exists()


def test_latest_with_a_hot_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = {r["k"]: r["v"] for r in ordering.latest(df, ["k"], ["v"]).collect()}
    assert got[-1] == 8997 and len(got) == 6001
    assert all(k == v for k, v in got.items() if k != -1)


def test_sequence(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    numbered = {r["k"]: r["n"] for r in ordering.with_sequence(df, ["k"], "n").collect()}
    assert numbered == {k: k + 1 for k in range(5000)}


def test_pages_over_equal_keys_hold_every_row_once(spark):
    df = spark.range(400).select((F.col("id") % 2).alias("k"), "id").repartition(7)
    seen = [r["id"] for n in range(1, 12) for r in ordering.page(df, "k", ".", n, 40, ["id"]).collect()]
    assert sorted(seen) == list(range(400))
    assert [r["k"] for r in ordering.page(spark.range(5000).toDF("k"), "k", "5$", 3, 40, ["k"]).collect()] == [10 * i + 5 for i in range(80, 120)]
    with pytest.raises(ValueError):
        ordering.page(df, "k", ".", 1, 40)


def test_a_new_stream_writes_after_the_old_one(spark, frame, table):
    """Batch ids start again at 0 with a new checkpoint; a batch run again replaces itself."""
    sc = spark.sparkContext
    t = table()
    try:
        sc.setLocalProperty("sql.streaming.queryId", "one")
        t.write_batch(frame("k a b", ("1", "x", "y")), 0)
        t.write_batch(frame("k a b", ("1", "again", "y")), 0)
        t.write_batch(frame("k a b", ("2", "x", "y")), 1)
        t.compact()
        sc.setLocalProperty("sql.streaming.queryId", "two")
        t.write_batch(frame("k a b", ("2", "new", "y"), ("3", "x", "y")), 0)
    finally:
        sc.setLocalProperty("sql.streaming.queryId", None)
    assert rows(t.read()) == [("1", "again", "y"), ("2", "new", "y"), ("3", "x", "y")]
    t.write_batch(frame("k a b", ("4", "x", "y")), 0, feed="a")
    t.write_batch(frame("k a b", ("5", "x", "y")), 0, feed="b")
    assert t.read().count() == 5


def test_maintain_removes_what_is_long_replaced(frame, table):
    t = table()
    for batch in range(9):
        t.write_batch(frame("k a", (str(batch), "x")), batch)
        t.maintain(most_changes=1)
    assert t.read().count() == 9
    assert len(t._batches("changes")) <= 5 and len(t._claims()) <= 5
    t.write_batch(frame("k a", ("8", "again")), 8)
    assert t.read().count() == 9


def test_prefixes_of_several_lengths(frame):
    df = frame("rowkey v", ("1_2", "a"), ("12_3", "b"), ("12_3", "c"), ("2_1", "d"))
    prefixes = frame("prefix", "1_", "12", "12_", "9")
    assert rows(keyed.key_prefix_any(df, prefixes)) == [("12_3", "b"), ("12_3", "c"), ("1_2", "a")]


def test_cells_round_trip(frame):
    df = frame("rowkey a b", ("1", "x", None), ("2", "y", "z"))
    cells = keyed.to_cells(df, "rowkey", F.lit(1))
    assert cells.count() == 3
    assert rows(keyed.from_cells(cells, ["a", "b"])) == [("1", "x", None), ("2", "y", "z")]


NEVER = "1970-01-01 00:00:00"
TIMES = "fdeal_gen_time fdeal_pay_suss_time fdeal_cancel_time fdeal_consign_time fdeal_recv_confirm_time"


def test_order_events_emit_every_tie(frame):
    t1, t2 = "2019-01-01 00:00:00", "2019-01-02 00:00:00"
    df = frame("id " + TIMES, ("a", t1, t2, NEVER, t2, NEVER), ("b", t1, NEVER, NEVER, NEVER, NEVER), ("c", NEVER, NEVER, NEVER, NEVER, NEVER))
    got = rows(order_events(df).select("id", "k_fopt_time", "fopt_type"))
    assert got == [("a", t2, "2"), ("a", t2, "4"), ("b", t1, "1")]


def test_order_events_by_op(frame):
    t1, t2 = "2019-01-01 00:00:00", "2019-01-02 00:00:00"
    df = frame(
        "id opttype " + TIMES,
        ("a", "INSERT", t1, t1, NEVER, NEVER, t2), ("b", "UPDATE", t1, t2, NEVER, t2, t1), ("c", "UPDATE", t1, t1, NEVER, NEVER, NEVER),
    )
    got = rows(order_events_by_op(df).select("id", "k_fopt_time", "fopt_type"))
    assert got == [("a", t1, "fdeal_gen"), ("a", t1, "fdeal_pay"), ("b", t2, "fdeal_consign")]


def test_key_equality_not_prefix(frame):
    a = frame(" ".join(DEAL_KEY) + " x", ("1", "1", "1", "12", "a"))
    b = frame(" ".join(DEAL_KEY) + " ftrade_id x", ("1", "1", "1", "123", "t", "b"), ("1", "1", "1", "12", "u", "b"))
    got = join_deal_trades(a, b)
    assert rows(got.select("ftrade_id", "x")) == [("u", "b")]


def test_b_change_rule(frame):
    names = " ".join(DEAL_KEY) + " ftrade_id opttime opttype"
    key = ("1", "1", "1", "1")
    state = frame(names, (*key, "t", "5", "INSERT"))
    b = frame(names, (*key, "t", "6", "UPDATE"), (*key, "t", "4", "UPDATE"), (*key, "t", "9", "INSERT"), (*key, "new", "1", "UPDATE"))
    assert rows(filter_b_changes(b, state).select("ftrade_id", "opttime")) == [("new", "1"), ("t", "6")]


def test_bulk_load_files_are_bounded(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    stores.bulk_load(df, str(tmp_path / "wide"), ["k"], ["v"], rows_per_partition=50)
    out = spark.read.parquet(str(tmp_path / "wide"))
    assert out.count() == 500 and out.where("cast(v as int) < 500").count() == 0
    assert max(r["count"] for r in out.groupBy(F.input_file_name()).count().collect()) <= 50


def test_reset_drops_only_when_asked(spark, frame):
    path, name = work_path(spark, "reset"), "reset_demo"
    stores.reset_tables(spark, {name: "a string"}, path)
    frame("a", "1").write.mode("append").insertInto(name)
    stores.reset_tables(spark, {name: "a string"}, path)
    assert spark.table(name).count() == 1
    stores.reset_tables(spark, {name: "a string"}, f"{path}2", drop=True)
    assert spark.table(name).count() == 0


def test_expired_entries(spark, frame):
    df = stores.kv_rows(frame("t k v", ("1", "a", "x"), ("1", "", "y")), "dim", "k", "v", "t", F.lit("2019-01-01").cast("timestamp"))
    assert df.count() == 1
    assert stores.live_entries(df, F.lit("2019-01-30").cast("timestamp")).count() == 1
    assert stores.live_entries(df, F.lit("2019-02-01").cast("timestamp")).count() == 0


def test_jdbc_statement_and_options():
    sql = jdbc.upsert_statement("t", "t_staging", ["k", "a"], ["k"])
    assert sql == "INSERT INTO t (k, a) SELECT k, a FROM t_staging ON DUPLICATE KEY UPDATE a = COALESCE(VALUES(a), t.a)"
    sql = jdbc.upsert_statement("t", "s", ["k", "a"], ["k"], present=True)
    assert sql.endswith("UPDATE a = CASE WHEN FIND_IN_SET('a', s._present) > 0 THEN VALUES(a) ELSE COALESCE(VALUES(a), t.a) END")
    assert jdbc.write_options("u", "t", {"user": "x"}, 500, 8) == {"url": "u", "dbtable": "t", "batchsize": "500", "user": "x", "numPartitions": "8"}


CELL = "rowkey string, family string, column string, value string, ts bigint, deleted string"


def live(spark, *cells, **more):
    return sorted(values(keyed.live_cells(spark.createDataFrame(list(cells), CELL), **more)))


def mark(spark, scope, ts, **named):
    df = spark.createDataFrame([tuple(named.values())], ", ".join(f"{n} string" for n in named))
    return [tuple(r) for r in keyed.deletion(df, scope, F.lit(ts)).collect()]


def test_deleted_cells(spark):
    a, b = ("r", "f", "a", "1", 10, None), ("r", "f", "b", "2", 20, None)
    other, far = ("r", "g", "a", "3", 10, None), ("s", "f", "a", "4", 10, None)
    everything = [a, b, other, far]
    shown = [c[:5] for c in everything]
    assert live(spark, *everything) == sorted(shown)
    # A mark hides what is not newer than it, whichever is stored first.
    assert live(spark, *mark(spark, keyed.FAMILY, 10, rowkey="r", family="f"), *everything) == sorted([b[:5], other[:5], far[:5]])
    assert live(spark, *everything, *mark(spark, keyed.ROW, 15, rowkey="r")) == sorted([b[:5], far[:5]])
    assert live(spark, *everything, *mark(spark, keyed.TABLE_FAMILY, 20, family="f")) == [other[:5]]
    assert live(spark, *everything, *mark(spark, keyed.COLUMN, 99, rowkey="r", family="f", column="b")) == sorted([a[:5], other[:5], far[:5]])
    # The newest mark counts; cells written after it are there, older versions are not.
    marks = [*mark(spark, keyed.FAMILY, 5, rowkey="r", family="f"), *mark(spark, keyed.FAMILY, 30, rowkey="r", family="f")]
    again = [("r", "f", "a", "new", 31, None), ("r", "f", "a", "old", 29, None), ("r", "f", "a", "newest", 32, None)]
    assert live(spark, *everything, *marks, *again) == sorted([("r", "f", "a", "newest", 32), other[:5], far[:5]])
    assert [c[3] for c in live(spark, *marks, *again, versions=2)] == ["new", "newest"]


def test_a_row_of_very_many_cells_is_split(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in before:
        spark.conf.set(k, "-1")
    try:
        cells = spark.range(3000).select(F.lit("hot").alias("rowkey"), F.lit("f").alias("family"), F.col("id").cast("string").alias("column"), F.lit("v").alias("value"), F.col("id").alias("ts"), F.lit(None).cast("string").alias("deleted"))
        marks = spark.createDataFrame(mark(spark, keyed.ROW, 999, rowkey="hot"), CELL)
        found = keyed.live_cells(cells.unionByName(marks))
        assert found.count() == 2000
        # Joins on structs made right before them: plain shuffles, which the runtime can split.
        assert found._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(_scope") >= 4
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cache_entries_leave_the_disk(spark):
    def at(day, hour=12):
        return datetime.datetime(2024, 1, day, hour)

    cache = KeyValueCache(spark, work_path(spark, "cache"), longest_days=5)

    def put(day, hours, *entries):
        rows = spark.createDataFrame(list(entries), "code string, name string, tenant string")
        cache.write(stores.kv_rows(rows, "t", "code", "name", "tenant", F.lit(at(day)), ttl=hours * 3600), F.lit(at(day)))

    def entries(df):
        return sorted((r["key"], r["value"]) for r in df.collect())

    put(1, 120, ("a", "1", "x"), ("b", "1", "x"), ("c", "1", "x"), ("", "no key", "x"))
    put(3, 2, ("b", "short", "x"))
    assert entries(cache.read(at(3, 13))) == [("a", "1"), ("b", "short"), ("c", "1")]
    put(4, 120, ("c", "2", "x"), ("a", "other tenant", "y"))
    # The short-lived one has run out; what it had replaced does not come back, before or after folders are removed.
    want = [("a", "1"), ("a", "other tenant"), ("c", "2")]
    assert entries(cache.read(at(5))) == want and cache.drop_expired(at(5)) == []
    assert cache.drop_expired(at(7)) == ["2024-01-06"]
    assert entries(cache.stored()) == [("a", "other tenant"), ("b", "short"), ("c", "2")]
    assert entries(cache.read(at(7))) == [("a", "other tenant"), ("c", "2")]
    with pytest.raises(Exception, match="lives longer"):
        put(5, 121, ("d", "1", "x"))
