from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.coerce import schema_of
from rillmark.operators import filters as flt
from rillmark.plans.configured import require_sources
from rillmark.sources.decode import decode_batches, fields

from . import query
from .decoding import BATCH_ROWS, batch_messages
from .views import deal, score, stamps, table, text, with_views


def named_rows(spark, sf_dir):
    k = F.col("o_orderkey") % 8
    name = (
        F.when(k == 0, "t_x").when(k == 1, "t_x_3").when(k == 2, "t_x7").when(k == 3, "t_xy")
        .when(k == 4, "t_x_y").when(k == 5, "T_X").when(k == 6, "t_z_12")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("tableName"))


@query("select o_orderkey from orders where o_orderkey % 8 in (0, 1, 2)")
def flt_sharded_table(spark, sf_dir):
    return flt.filter_table(named_rows(spark, sf_dir), "t_x").select("o_orderkey")


@query("select o_orderkey from orders where o_orderkey % 8 in (0, 5)")
def flt_table_exact_ci(spark, sf_dir):
    return flt.filter_table_exact(named_rows(spark, sf_dir), "T_x").select("o_orderkey")


@query("select o_orderkey from orders where o_orderkey % 8 in (0, 1, 2, 6)")
def flt_two_tables(spark, sf_dir):
    return flt.filter_any_table(named_rows(spark, sf_dir), ["t_x", "t_z"]).select("o_orderkey")


@query(with_views("deal", """
select fdeal_id, opttype from deal where opttype in ('INSERT', 'UPDATE') and cast(fbdeal_id as int) % 3 in (0, 1)
"""))
def flt_change_ops(spark, sf_dir):
    kind = F.col("fbdeal_id").cast("int") % 3
    name = F.when(kind == 0, "t_deal").when(kind == 1, "t_trade").otherwise("t_other")
    rows = deal(spark, sf_dir).withColumn("tableName", name)
    return flt.filter_changes(rows, ["t_deal", "t_trade"], op="opttype").select("fdeal_id", "opttype")


@query(with_views("score", "select event_id, faccounttype from score where faccounttype in ('2', '4')"))
def flt_account_type(spark, sf_dir):
    rows = flt.filter_account(score(spark, sf_dir))
    return rows.select("event_id", F.col("fAccountType").alias("faccounttype"))


@query(f"select no, name from ({BATCH_ROWS}) b where type = '2' and platform = '3'")
def flt_type_platform(spark, sf_dir):
    rows = fields(decode_batches(batch_messages(spark, sf_dir)), ["_cal_type_sel", "cal_platformNum", "no", "name"])
    return flt.filter_envelope(rows, "retail#2#3").select("no", "name")


@query("select o_orderkey, o_orderstatus from orders where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0")
def flt_required_columns(spark, sf_dir):
    key = F.col("o_orderkey")
    status = F.when(key % 7 == 0, "").when(key % 11 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", status.alias("o_orderstatus"), F.lit("").alias("note"))
    schema = schema_of([("o_orderkey", "int64", False), ("o_orderstatus", "string", False), ("note", "string")])
    return flt.require(rows, schema).select("o_orderkey", "o_orderstatus")


@query("select event_id from events where event_id % 6 <> 0")
def flt_required_sources(spark, sf_dir):
    user = F.when(F.col("event_id") % 6 == 0, "").otherwise(text("user_id"))
    rows = table(spark, sf_dir, "events").select("event_id", user.alias("user"), F.lit("").alias("web"), text("ts").alias("time"))
    config = {"configs": [{"eventId": "e", "mappping": [
        {"target": "_ftenancy_id", "source": "user", "defaultvalue": ""},
        {"target": "channel", "source": "web", "defaultvalue": "app"},
        {"target": "_dt", "source": "web", "defaultvalue": ""},
        {"target": "remark", "source": "web", "defaultvalue": ""},
    ]}]}
    schema = T.StructType([
        T.StructField("_ftenancy_id", T.StringType(), False), T.StructField("channel", T.StringType(), False),
        T.StructField("_dt", T.StringType(), False), T.StructField("remark", T.StringType(), True),
    ])
    return require_sources(rows, config, schema).select("event_id")


@query("""
select 'late' as run, o_orderkey from orders where o_orderdate >= date '2001-07-01' and o_orderkey % 13 <> 0
union all select 'early', o_orderkey from orders where o_orderdate >= date '2001-06-01' and o_orderkey % 13 <> 0
union all select 'plain', o_orderkey from orders where o_orderdate >= date '2001-06-01' and o_orderkey % 13 <> 0
""")
def flt_retention_floor(spark, sf_dir):
    time = F.when(F.col("o_orderkey") % 13 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", time.alias("saleTime"))

    def run(name, as_of, late_day):
        kept = flt.filter_retention(rows, "saleTime", F.lit(as_of), late_day=late_day)
        return kept.select(F.lit(name).alias("run"), "o_orderkey")

    return run("late", "2001-08-26", 25).unionByName(run("early", "2001-08-10", 25)).unionByName(run("plain", "2001-08-26", None))


@query("select o_orderkey from orders where o_orderkey % 97 <> 0 and o_orderkey % 89 <> 0")
def flt_valid_timestamp(spark, sf_dir):
    rows = stamps(spark, sf_dir)
    rows = rows.withColumn("t", F.when(F.col("o_orderkey") % 89 == 0, "2019-13-01 00:00:00").otherwise(F.col("t")))
    return flt.filter_parseable(rows, "t").select("o_orderkey")


@query("""
select event_id from events
where event_type = 'view' and cast(ts as date) = date '2024-01-05' and user_id <> 0 and event_id % 9 <> 0
""")
def flt_tracker(spark, sf_dir):
    user = F.when(F.col("event_id") % 9 == 0, "").otherwise(text("user_id"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", user.alias("userid"), F.date_format("ts", "yyyy-MM-dd").alias("days"),
        F.when(F.col("event_type") == "view", "40000").otherwise("1").alias("logtype"),
    )
    return flt.filter_tracker(rows, "2024-01-05").select("event_id")


@query("""
select cast(o_orderkey % 3 as int) as "partition", max(o_orderkey) as last_offset,
  count(*) filter (where o_orderstatus <> 'P' and o_orderkey % 7 <> 0) as stored,
  count(*) filter (where not (o_orderstatus <> 'P' and o_orderkey % 7 <> 0)) as rejected
from orders group by o_orderkey % 3
""")
def flt_reject_sideoutput(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        (key % 3).cast("int").alias("partition"), key.alias("offset"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"),
    )
    good, bad = flt.split_valid(rows, F.col("status") != "P")
    counts = good.withColumn("ok", F.lit(1)).unionByName(bad.withColumn("ok", F.lit(0)))
    return counts.groupBy("partition").agg(
        F.max("offset").alias("last_offset"), F.sum("ok").alias("stored"), F.sum(1 - F.col("ok")).alias("rejected")
    )
