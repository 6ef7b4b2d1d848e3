from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.functions.calendar import epoch_ms
from rillmark.operators.offsets import latest_offsets
from rillmark.session import work_path
from rillmark.sinks.stores import archive
from rillmark.sources.changes import filter_since, from_positions, read_changes, read_topic, replay_start, without_redelivery
from rillmark.sources.decode import decode_changes
from rillmark.sources.tables import poll_snapshot, scan_keyed, scan_table

from . import query
from .views import event_log, ledger, packed, table, with_views


def order_messages(spark, sf_dir):
    return packed(table(spark, sf_dir, "orders"), F.col("o_orderkey"), 20, "orders")


@query("""
select 'orders' as topic, cast((o_orderkey // 20) % 4 as int) as "partition", o_orderkey // 20 as "offset",
  cast(count(*) as int) as n_records
from orders group by o_orderkey // 20
""")
def src_change_stream(spark, sf_dir):
    messages, out = work_path(spark, "messages"), work_path(spark, "copied")
    order_messages(spark, sf_dir).write.json(messages)
    stream = read_changes(spark, path=messages)
    counted = stream.select("topic", "partition", "offset", F.json_array_length("value").alias("n_records"))
    run = counted.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query("select o_orderkey, o_custkey from orders")
def src_topic_earliest(spark, sf_dir):
    messages = work_path(spark, "messages")
    order_messages(spark, sf_dir).write.json(messages)
    values = read_topic(spark, "orders", path=messages, streaming=False)
    record = F.col("record")
    return decode_changes(values, fields=["o_orderkey", "o_custkey"]).select(
        *[record[c].cast("bigint").alias(c) for c in ("o_orderkey", "o_custkey")]
    )


@query(with_views("ledger event_log", """,
starts as (
  select k_topic, k_partition, k_offset from (
    select *, row_number() over (partition by k_topic, k_partition order by k_date desc) as rn
    from ledger where k_appname = 'app1' and k_date < '2024-01-15 00') s where rn = 1)
select topic, "partition", "offset" from event_log
left join starts on topic = k_topic and "partition" = k_partition
where k_offset is null or "offset" >= k_offset
"""))
def src_start_positions(spark, sf_dir):
    stored = ledger(spark, sf_dir).where(F.col("k_date") < "2024-01-15 00")
    messages = event_log(spark, sf_dir).select("topic", "partition", "offset")
    return from_positions(messages, latest_offsets(stored, app="app1"))


@query("""
select event_id, strftime(date_trunc('day', ts + interval 8 hour) - interval 8 hour - interval 30 minute, '%Y-%m-%d %H:%M:%S') as replay_from
from events
""")
def src_replay_midnight(spark, sf_dir):
    start = replay_start(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("replay_from")
    )


@query("select event_id from events where event_id % 7 <> 0 and epoch_ms(ts) >= 1705276800000")
def src_replay_filter(spark, sf_dir):
    time = F.when(F.col("event_id") % 7 == 0, "").otherwise(epoch_ms("ts").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", time.alias("optTime"))
    return filter_since(rows, F.lit(1705276800000)).select("event_id")


@query("select c_custkey, c_name, cast(c_custkey as varchar) as rowkey from customer order by c_custkey limit 1000")
def src_polled_snapshot(spark, sf_dir):
    return poll_snapshot(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 1000)


@query("select o_orderkey, o_custkey, o_orderstatus from orders where o_orderstatus = 'O'")
def src_warehouse_scan(spark, sf_dir):
    path = work_path(spark, "orders_by_status")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    archive(orders, name, path, partition_by=["o_orderstatus"])
    return scan_table(spark, name, "o_orderstatus = 'O'")


@query("select p_partkey, p_name, p_retailprice from part where p_type = 'ECONOMY' and p_size = 11")
def src_keyed_scan(spark, sf_dir):
    return scan_keyed(table(spark, sf_dir, "part"), {"p_type": "ECONOMY", "p_size": "11"}, ["p_partkey", "p_name", "p_retailprice"])


@query("""select event_type as topic, cast(user_id % 3 as int) as "partition", event_id as "offset", cast(user_id as varchar) as value from events""")
def src_redelivery(spark, sf_dir):
    """All messages come in a first batch and every second one again in the next."""
    path = work_path(spark, "redelivered")
    messages = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("value"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"))
    for rows in (messages, messages.where("event_id % 2 = 0")):
        rows.coalesce(1).write.mode("append").json(path)
    stream = read_changes(spark, path=path, timestamps=True, options={"maxFilesPerTrigger": "1"})
    # The second delivery comes after all of the first: the delay has to cover the whole topic here.
    found = without_redelivery(stream, "366 days").drop("timestamp")
    out = work_path(spark, "once")
    found.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(out)
