from rows import values
from pyspark.sql import functions as F

from rillmark.operators.events import DEAL_KEY
from rillmark.functions.labels import ORDER_EVENT_LABELS
from rillmark.session import work_path
from rillmark.sinks.keyed_table import KeyedTable
from rillmark.sources.changes import MESSAGE_SCHEMA, read_changes
from rillmark.sources.tables import poll_every
from rillmark.streaming.change_join import ChangeJoin, LabelledChangeJoin
from rillmark.streaming.jobs import EntityJob, ledger_table, resume_options, resumed, run_batch, run_job
from rillmark.streaming.windows import tumble, with_event_time

import json
import time


class Plain(EntityJob):
    app, table, names = "plain", "t", ["id", "v"]

    def map(self, records):
        return records.select(F.col("id").alias("k"), "v", *(["_place"] if "_place" in records.columns else []))


def message(offset, *records, partition=0):
    return ("topic", partition, offset, json.dumps([json.dumps(r) for r in records]))


def batch(spark, *messages):
    return spark.createDataFrame(list(messages), MESSAGE_SCHEMA)


def test_batch_keeps_last_and_counts_rejected_in_ledger(spark):
    path = work_path(spark, "plain")
    target = KeyedTable(spark, f"{path}/t", "k string, v string", ["k"], buckets=2)
    ledger = ledger_table(spark, f"{path}/l")
    df = batch(
        spark,
        message(1, {"tableName": "t", "id": "1", "v": "a"}, {"tableName": "t_2", "id": "1", "v": "b"}),
        message(2, {"tableName": "other", "id": "2", "v": "a"}),
        ("topic", 0, 3, "broken"),
    )
    for _ in range(2):
        run_batch(Plain(target), df, 0, ledger, F.lit("2024-01-01 00"))
        assert values(target.read()) == [("1", "b")]
        assert values(ledger.read()) == [("plain", "topic", 0, "2024-01-01 00", 2)]


def test_required_columns_are_required(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.StringType(), False), T.StructField("v", T.StringType(), False)])
    target = KeyedTable(spark, work_path(spark, "required"), schema, ["k"], buckets=2)
    run_batch(Plain(target), batch(spark, message(1, {"tableName": "t", "id": "1"}, {"tableName": "t", "id": "2", "v": "x"})), 0)
    assert values(target.read()) == [("2", "x")]


def test_restart_reads_only_what_is_new(spark):
    path = work_path(spark, "restart")
    target = KeyedTable(spark, f"{path}/t", "k string, v string", ["k"], buckets=2)
    seen = []

    class Counting(Plain):
        def save(self, rows, batch_id):
            seen.append(rows.count())
            super().save(rows, batch_id)

    for run, v in enumerate("ab"):
        batch(spark, message(run, {"tableName": "t", "id": "1", "v": v}, {"tableName": "t", "id": v, "v": v})).write.mode("append").json(f"{path}/m")
        run_job(Counting(target), read_changes(spark, path=f"{path}/m"), f"{path}/c", every=None).awaitTermination()
    assert sum(seen) == 4
    assert sorted(values(target.read())) == [("1", "b"), ("a", "a"), ("b", "b")]


def change(table, op, deal, **fields):
    key = {"Fdeal_id": deal, "Fbdeal_id": "1", "Ftenancy_id": "T", "Fbuyer_id": "9"}
    return {"tableName": table, "optType": op, "optTime": "1", **key, **fields}


def a_change(deal, op="INSERT", pay="1970-01-01 00:00:00"):
    never = "1970-01-01 00:00:00"
    return change("t_deal", op, deal, Fdeal_gen_time="2019-02-01 08:00:00", Fdeal_pay_suss_time=pay, Fdeal_cancel_time=never, Fdeal_consign_time=never, Fdeal_recv_confirm_time=never)


def test_change_join_over_batches(spark):
    times = ["fdeal_gen_time", "fdeal_pay_suss_time", "fdeal_cancel_time", "fdeal_consign_time", "fdeal_recv_confirm_time"]
    job = ChangeJoin(spark, work_path(spark, "join"), "t_deal", "t_trade", times, ["fitem_sku_id"], as_of="2019-02-20", loaded="x", buckets=2)
    job.reset()

    def b_change(deal, trade):
        return change("t_trade", "INSERT", deal, Ftrade_id=trade, Fitem_sku_id=f"S{trade}")

    def events():
        return sorted(values(job.events.read().select("fdeal_id", "ftrade_id", "fskuid", "fopt_type")))

    # Both sides of deal 1, only the order of 2, only a line of 3; a delete does not count.
    job.run_batch(batch(spark, message(0, a_change("1"), b_change("1", "11"), a_change("2"), b_change("3", "31"), a_change("4", "DELETE"), b_change("4", "41"))), 0)
    assert events() == [("1", "11", "s11", "1")]
    # The other sides arrive; deal 1 is paid, which touches its stored line and a new one.
    job.run_batch(batch(spark, message(1, b_change("2", "21"), a_change("3"), a_change("1", "UPDATE", "2019-02-03 09:00:00"), b_change("1", "12"))), 1)
    assert events() == [("1", "11", "s11", "1"), ("1", "11", "s11", "2"), ("1", "12", "s12", "2"), ("2", "21", "s21", "1"), ("3", "31", "s31", "1")]
    job.a_state.compact()
    job.b_state.compact()
    job.run_batch(batch(spark, message(2, b_change("2", "22"))), 2)
    assert ("2", "22", "s22", "1") in events()


def test_tumble_gives_closed_windows_once(spark):
    path, out = work_path(spark, "win"), work_path(spark, "out")
    schema = "id bigint, opttime string"
    rows = [(i, str(1_600_000_020_000 + i * 20_000)) for i in range(10)]
    spark.createDataFrame(rows + rows[:3], schema).write.parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    tagged = tumble(with_event_time(stream), "60 seconds", ["id"])
    run = tagged.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c")
    run.trigger(availableNow=True).start().awaitTermination()
    got = sorted(values(spark.read.parquet(out).select("id", F.unix_seconds("window_start"))))
    # The last window is still open.
    assert got == [(i, 1_600_000_020 + i * 20 // 60 * 60) for i in range(9)]


def test_polling_reads_the_table_again_on_every_tick(spark):
    seen, path = [], work_path(spark, "polled")
    spark.range(5).select((F.col("id") * 2).alias("k")).write.parquet(path)

    def sink(df, tick):
        seen.append(sorted(r["rowkey"] for r in df.collect()))
        if tick == 0:
            spark.createDataFrame([(1,)], "k bigint").write.mode("append").parquet(path)

    run = poll_every(spark, lambda: spark.read.parquet(path), sink, "k", n=3, every="1 second")
    deadline = time.time() + 60
    while len(seen) < 2 and time.time() < deadline:
        time.sleep(0.2)
    run.stop()
    assert seen[0] == ["0", "2", "4"] and seen[1] == ["0", "1", "2"]


def test_batch_frames_give_all_windows(spark):
    df = spark.createDataFrame([(1, "0"), (2, "61000")], "id bigint, opttime string")
    assert tumble(with_event_time(df), "60 seconds", ["id"]).count() == 2


def test_change_time_beats_arrival(spark):
    """Offsets of two partitions do not say which change came first, the time of the change does."""
    job = ChangeJoin(spark, work_path(spark, "times"), "deal", "trade", ["fstate"], [], buckets=2)
    job.reset()
    key = dict(zip(job.a_columns[:4], "1111"))

    def change(state, time, offset, partition):
        text = json.dumps([json.dumps({**key, "tableName": "deal", "optType": "UPDATE", "optTime": time, "fstate": state})])
        return ("topic", partition, offset, text)

    for number, messages in enumerate([[change("old", 1000, 900, 0), change("new", 2000, 5, 1)], [change("late", 1500, 901, 0)]]):
        job.load_state(job.changes(batch(spark, *messages)), number)
    assert [(r["fstate"], r["opttime"]) for r in job.a_state.read().collect()] == [("new", "2000")]


def test_what_is_not_stored_is_set_aside(spark):
    path = work_path(spark, "aside")
    job = Plain(KeyedTable(spark, f"{path}/t", "k string, v string", ["k"], buckets=2), quarantine=f"{path}/quarantine")
    df = batch(spark, message(1, {"tableName": "t", "id": "1", "v": "a"}), message(2, {"tableName": "other", "id": "2"}), ("topic", 0, 3, "broken"))
    for _ in range(2):
        run_batch(job, df, 0)
        aside = sorted((r["reason"], json.loads(r["content"])["offset"]) for r in spark.read.parquet(job.quarantine).collect())
        assert aside == [("rejected", 2), ("undecodable", 3)]


def test_restart_with_a_new_checkpoint_keeps_rows(spark):
    path = work_path(spark, "fresh")
    target = KeyedTable(spark, f"{path}/t", "k string, v string", ["k"], buckets=2)
    for n in (1, 2):
        batch(spark, message(n, {"tableName": "t", "id": str(n), "v": "a"})).write.mode("append").json(f"{path}/in{n}")
        query = run_job(Plain(target), read_changes(spark, path=f"{path}/in{n}"), f"{path}/checkpoint{n}", every=None)
        query.awaitTermination()
    assert values(target.read().orderBy("k")) == [("1", "a"), ("2", "a")]


def test_resume_from_the_ledger(spark):
    ledger = ledger_table(spark, work_path(spark, "resume"))
    assert resume_options(ledger, "plain", "topic") == {"startingOffsets": "earliest"}
    target = KeyedTable(spark, work_path(spark, "resumed"), "k string, v string", ["k"], buckets=2)
    rows = [message(n, {"tableName": "t", "id": str(n), "v": "a"}, partition=n % 2) for n in range(1, 6)]
    run_batch(Plain(target), batch(spark, *rows), 0, ledger, F.lit("2024-01-01 00"))
    assert resume_options(ledger, "plain", "topic") == {"startingOffsets": json.dumps({"topic": {"0": 4, "1": 5}})}
    # Another hour, in which one partition stood elsewhere and the other has no row; the topic has three.
    run_batch(Plain(target), batch(spark, message(9, {"tableName": "t", "id": "9", "v": "a"}, partition=1)), 1, ledger, F.lit("2024-01-01 01"))
    assert resume_options(ledger, "plain", "topic", partitions=3) == {"startingOffsets": json.dumps({"topic": {"0": 4, "1": 9, "2": -2}})}
    assert resume_options(ledger, "plain", "topic", "2024-01-01 01", 3) == {"startingOffsets": json.dumps({"topic": {"0": -2, "1": 9, "2": -2}})}
    messages = batch(spark, *rows, message(9, {}, partition=1), message(1, {}, partition=2))
    left = {(r["partition"], r["offset"]) for r in resumed(messages, ledger, "plain", "2024-01-01 01").collect()}
    assert left == {(0, 2), (0, 4), (1, 9), (2, 1)}


def test_labelled_job(spark):
    times = list(ORDER_EVENT_LABELS)
    job = LabelledChangeJoin(spark, work_path(spark, "labelled"), "deal", "trade", ["fdeal_gen_time", *times], ["fitem_sku_id"], buckets=2, as_of="2020-02-01", loaded="x")
    job.reset()

    def change(offset, table, op, time, deal, **more):
        text = {**dict.fromkeys(DEAL_KEY, "1"), "fdeal_id": deal, "tableName": table, "optType": op, "optTime": time, **more}
        return ("topic", 0, offset, json.dumps([json.dumps(text)]))

    def order(offset, op, time, deal, paid):
        at = {t: "2019-12-01 08:00:00" for t in times}
        return change(offset, "deal", op, time, deal, **{**at, "fdeal_gen_time": "2019-12-01 08:00:00", times[-1]: paid})

    same, later = "2019-12-01 08:00:00", "2020-01-05 10:00:00"
    first = [change(1, "trade", "INSERT", 10, "a", ftrade_id="t", fitem_sku_id="s"), order(2, "INSERT", 10, "a", same), order(3, "INSERT", 10, "lonely", same)]
    second = [order(4, "UPDATE", 20, "a", later), change(5, "trade", "UPDATE", 5, "a", ftrade_id="t", fitem_sku_id="old"), change(6, "trade", "INSERT", 30, "lonely", ftrade_id="u", fitem_sku_id="s")]
    for number, messages in enumerate((first, second)):
        for _ in range(2):
            job.run_batch(batch(spark, *messages), number)
    events = sorted((r["fdeal_id"], r["k_fopt_time"], r["fopt_type"], r["fskuid"]) for r in job.events.read().collect())
    labels = list(ORDER_EVENT_LABELS.values())
    assert events == sorted([("a", same, x, "s") for x in set(labels)] + [("a", later, labels[-1], "s")])
    assert [r["fdeal_id"] for r in job.unmatched.read().collect()] == ["lonely"]


def test_a_load_decodes_once_in_code_the_jvm_compiles(spark, monkeypatch):
    job = ChangeJoin(spark, work_path(spark, "once"), "t_deal", "t_trade", [*ORDER_EVENT_LABELS, "fplatform_id"], ["fitem_sku_id", "ftrade_num"], buckets=2)
    key = dict.fromkeys(DEAL_KEY, 7)
    deal = key | {"tableName": "t_deal", "optTime": 5, "optType": "INSERT", "fplatform_id": 10000000.0}
    trade = key | {"tableName": "t_trade", "optTime": "5", "optType": "UPDATE", "ftrade_id": "1", "ftrade_num": 1.50}
    sent = batch(spark, message(0, deal, trade), ("topic", 0, 1, json.dumps([json.dumps(deal), "broken"])), message(2, trade | {"optTime": 6, "ftrade_num": None}))
    changes = job.changes(sent)
    # A longer method is never compiled.
    sizes = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(changes._jdf.queryExecution().executedPlan())
    assert 0 < max(sizes.apply(i)._3().maxMethodCodeSize() for i in range(sizes.size())) < 8000
    plans = []
    for state in (job.a_state, job.b_state):
        write = state.write_batch
        monkeypatch.setattr(state, "write_batch", lambda rows, i, write=write: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), write(rows, i))[1])
    job.load_state(changes, 0)
    assert len(plans) == 2 and all("InMemoryTableScan" in p for p in plans) and not changes.is_cached
    assert values(job.a_state.read().select("fdeal_id", "fplatform_id", "opttime")) == [("7", "10000000.0", "5")]
    assert values(job.b_state.read().select("ftrade_id", "ftrade_num", "opttime")) == [("1", None, "6")]
