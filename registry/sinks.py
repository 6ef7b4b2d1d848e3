from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from rillmark.operators import keyed
from rillmark.operators.events import EVENT_KEY, event_key
from rillmark.operators.filters import filter_account, filter_retention
from rillmark.operators.offsets import LEDGER_KEY, ledger_rows
from rillmark.plans.commerce import map_order_event as map_event
from rillmark.plans.customers import map_level, map_score
from rillmark.session import work_path
from rillmark.sinks import stores
from rillmark.sinks.keyed_table import KeyedTable
from rillmark.sinks.kv_cache import KeyValueCache
from rillmark.streaming.change_join import EVENT_SCHEMA
from rillmark.streaming.jobs import LEDGER_SCHEMA

from . import query
from .keyed import CELLS, order_cells
from .mappings import LEVELS, LOADED, MAPPED_EVENT, joined_events, levels
from .views import LINE_ORDER, score, table, text, with_views

ORDER_SCHEMA = "o_orderkey bigint, o_orderstatus string, o_totalprice double"


def order_batches(spark, sf_dir):
    """All orders, then new states of a third of them and some new keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X"))
    added = orders.where("o_orderkey % 10 = 0").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_orderstatus", "o_totalprice")
    return orders, changed.unionByName(added)


def upserted(spark, sf_dir):
    target = KeyedTable(spark, work_path(spark, "orders"), ORDER_SCHEMA, ["o_orderkey"], buckets=16)
    first, second = order_batches(spark, sf_dir)
    target.write_batch(first, 0)
    target.write_batch(second, 1)
    return target


UPSERTED = """
select o_orderkey, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as o_orderstatus, o_totalprice from orders
union all select -o_orderkey - 1, o_orderstatus, o_totalprice from orders where o_orderkey % 10 = 0
"""


@query(UPSERTED)
def snk_upsert(spark, sf_dir):
    return upserted(spark, sf_dir).read()


@query(with_views("score", f"""
with_scores as (
  select fuid, ftenancyid, faccounttype, faccountpoints,
    row_number() over (partition by ftenancyid, fuid, faccounttype order by event_id desc) as rn
  from score where faccounttype in ('2', '4'))
select cast(c_custkey % 10 as varchar) as k_ftenancy_id, cast(c_custkey as varchar) as k_fid, c_name as fnickname,
  p.faccountpoints as faccountpoints, l.faccountpoints as fmlevelvalue, '{LOADED}' as etl_date
from customer
left join with_scores p on p.fuid = cast(c_custkey as varchar) and p.faccounttype = '2' and p.rn = 1
left join with_scores l on l.fuid = cast(c_custkey as varchar) and l.faccounttype = '4' and l.rn = 1
""").replace("\nwith_scores as", ",\nwith_scores as"))
def snk_partial_upsert(spark, sf_dir):
    schema = "k_ftenancy_id string, k_fid string, fnickname string, faccountpoints string, fmlevelvalue string, etl_date string"
    target = KeyedTable(spark, work_path(spark, "members"), schema, ["k_ftenancy_id", "k_fid"], partial=True, buckets=16)
    members = table(spark, sf_dir, "customer").select(
        text(F.col("c_custkey") % 10).alias("k_ftenancy_id"), text("c_custkey").alias("k_fid"), F.col("c_name").alias("fnickname"),
        F.lit(LOADED).alias("etl_date"),
    )
    target.write_batch(members, 0)
    scores = filter_account(score(spark, sf_dir)).withColumn("_place", F.col("event_id"))
    target.write_batch(map_score(scores, LOADED), 1, order=["_place"])
    return target.read()


@query(CELLS)
def snk_cells(spark, sf_dir):
    path = work_path(spark, "cells")
    rows = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("rowkey"), "o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
    )
    stores.write_cells(rows, path, "rowkey", F.col("rowkey").cast("bigint") * 10)
    return spark.read.parquet(path).select(order_cells(spark, sf_dir).columns)


@query("""
select l_orderkey || '_' || l_linenumber as rowkey, cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
  cast(l_partkey as varchar) as l_partkey, cast(l_suppkey as varchar) as l_suppkey, l_returnflag
from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_extendedprice desc, l_partkey desc, l_suppkey desc) as rn
  from lineitem) t where rn = 1
""")
def snk_bulk_load(spark, sf_dir):
    path = work_path(spark, "wide_lines")
    stores.bulk_load(table(spark, sf_dir, "lineitem"), path, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return spark.read.parquet(path).select("rowkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


@query("select p_partkey, p_name, p_retailprice from part where p_size > 10")
def snk_overwrite_table(spark, sf_dir):
    path = work_path(spark, "archive")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    stores.archive(part, name, path)
    stores.archive(part.where("p_size > 10").drop("p_size"), name, path)
    return spark.table(name)


@query("""
select cast(s_suppkey % 10 as varchar) as tenant, cast(s_suppkey as varchar) as key, s_name as value, '2019-03-31 00:00:00' as expires
from supplier where s_suppkey % 9 <> 0 and s_suppkey % 4 <> 0
union all select cast(s_suppkey % 10 as varchar), cast(s_suppkey as varchar), s_name || ' new', '2019-04-20 00:00:00'
from supplier where s_suppkey % 9 <> 0 and s_suppkey % 4 = 0
""")
def snk_kv_cache(spark, sf_dir):
    cache = KeyedTable(spark, work_path(spark, "cache"), stores.KV_SCHEMA, ["kv_table", "tenant", "key"], buckets=16)
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        F.when(key % 9 == 0, "").otherwise(text(key)).alias("code"), text(key % 10).alias("tenant"), F.col("s_name").alias("name"), key.alias("id")
    )

    def at(day):
        return F.lit(f"{day} 00:00:00").cast("timestamp")

    cache.write_batch(stores.kv_rows(rows, "supplier_dim", "code", "name", "tenant", at("2019-03-01")), 0)
    newer = rows.where("id % 4 = 0").withColumn("name", F.concat("name", F.lit(" new")))
    cache.write_batch(stores.kv_rows(newer, "supplier_dim", "code", "name", "tenant", at("2019-03-21")), 1)
    # Entries of another table that have run out by now.
    cache.write_batch(stores.kv_rows(rows, "old_dim", "code", "name", "tenant", at("2019-01-01")), 2)
    live = stores.live_entries(cache.read(), at("2019-03-25"))
    return live.select("tenant", "key", "value", F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss").alias("expires"))


@query(with_views("ledger", "select * from ledger"))
def snk_offset_ledger(spark, sf_dir):
    target = KeyedTable(spark, work_path(spark, "ledger"), LEDGER_SCHEMA, LEDGER_KEY, buckets=1)
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.concat(F.lit("app"), text(F.col("user_id") % 4)).alias("app"), F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "ts",
    )
    for batch, rows in enumerate((events.where("day(ts) <= 12"), events.where("day(ts) > 12"))):
        target.write_batch(ledger_rows(rows, F.col("app"), F.col("hour")), batch)
    return target.read()


@query(with_views("deal trade order_event", f"select * from ({MAPPED_EVENT}) m where k_dt >= '1999-06-01'"))
def snk_order_events(spark, sf_dir):
    target = KeyedTable(spark, work_path(spark, "events"), EVENT_SCHEMA, EVENT_KEY, buckets=16)
    rows = filter_retention(map_event(event_key(joined_events(spark, sf_dir), ["fplatform_id"]), LOADED), "k_dt", F.lit("1999-08-26"))
    target.write_batch(rows, 0)
    return target.read()


@query(LEVELS)
def snk_noop(spark, sf_dir):
    rows = map_level(levels(spark, sf_dir), LOADED)
    stores.dry_run(rows)
    return rows


@query("select p_partkey, p_name from part")
def tbl_reset_state(spark, sf_dir):
    path = work_path(spark, "state")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    stores.reset_tables(spark, {name: part.schema}, path)
    part.write.mode("append").insertInto(name)
    # What is there stays, unless a drop is asked for.
    stores.reset_tables(spark, {name: part.schema}, path)
    return spark.table(name)


@query("select c_custkey, c_name from customer where c_custkey % 4 <> 0 union all select c_custkey, 'back' from customer where c_custkey % 8 = 0")
def tbl_delete_keys(spark, sf_dir):
    target = KeyedTable(spark, work_path(spark, "customers"), "c_custkey bigint, c_name string", ["c_custkey"], buckets=16)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    target.write_batch(customers, 0)
    target.delete_keys(customers.where("c_custkey % 4 = 0"), 1)
    target.compact()
    target.write_batch(customers.where("c_custkey % 8 = 0").withColumn("c_name", F.lit("back")), 2)
    return target.read()


@query("""
with entries as (
  select *, day from (values (date '2019-01-01'), (date '2019-02-20'), (date '2019-03-21')) d(day), supplier
  where day < date '2019-03-21' or s_suppkey % 4 = 0)
select 'stored' as state, cast(s_suppkey as varchar) as key, s_name || ' ' || cast(day as varchar) as value from entries where day > date '2019-01-01'
union all
select 'live', cast(s_suppkey as varchar), s_name || ' ' || cast(day as varchar) from entries e
where day = (select max(day) from entries x where x.s_suppkey = e.s_suppkey) and not (day = date '2019-03-21' and s_suppkey % 8 = 0)
""")
def snk_kv_cache_expiry(spark, sf_dir):
    """Entries of three days, those of some keys short-lived; folders of past days are removed."""
    cache = KeyValueCache(spark, work_path(spark, "expiring"))
    suppliers = table(spark, sf_dir, "supplier")
    for day in ("2019-01-01", "2019-02-20", "2019-03-21"):
        rows = suppliers.where(F.lit(day < "2019-03-21") | (F.col("s_suppkey") % 4 == 0)).select(
            text("s_suppkey").alias("code"), F.lit("1").alias("tenant"), F.concat_ws(" ", "s_name", F.lit(day)).alias("name"), F.col("s_suppkey").alias("id"))
        at = F.lit(f"{day} 12:00:00").cast("timestamp")
        short = F.lit(day == "2019-03-21") & (F.col("id") % 8 == 0)
        for part, hours in ((rows.where(short), 12), (rows.where(~short), 30 * 24)):
            cache.write(stores.kv_rows(part, "dim", "code", "name", "tenant", at, ttl=hours * 3600), at)
    # What the short-lived entries had replaced would live still, and must not come back.
    now = datetime.datetime(2019, 3, 22, 6)
    cache.drop_expired(now)
    stored = cache.stored().select(F.lit("stored").alias("state"), "key", "value")
    return stored.unionByName(cache.read(now).select(F.lit("live").alias("state"), "key", "value"))


@query("""
with cells as (
  select p_partkey as k, 'name' as family, 'p_brand' as "column", p_brand as value, p_partkey as ts from part
  union all select p_partkey, 'name', 'p_name', p_name, p_partkey from part
  union all select p_partkey, 'info', 'p_size', cast(p_size as varchar), p_partkey from part
  union all select p_partkey, 'other', 'p_type', p_type, p_partkey from part
  union all select p_partkey, 'name', 'p_brand', 'back', p_partkey + 2000000 from part where p_partkey % 6 = 0
  union all select p_partkey, 'name', 'p_brand', 'too old', p_partkey - 1 from part where p_partkey % 9 = 0
  union all select p_partkey, 'other', 'p_type', 'again', 5000000 from part where p_partkey % 5 = 0)
select cast(k as varchar) as rowkey, family, "column", value, ts from cells
where not (family = 'name' and k % 3 = 0 and ts <= k + 1000000) and not (family = 'other' and ts <= 4000000)
  and not (k % 7 = 0 and ts <= k + 500000) and not (family = 'info' and k % 11 = 0)
""")
def tbl_delete_family(spark, sf_dir):
    """Families, rows and columns are deleted, and some cells written again."""
    path = work_path(spark, "cells")
    part = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey").cast("bigint"))

    def put(rows, family, column, value, ts):
        cells = rows.select(text("k").alias("rowkey"), F.lit(family).alias("family"), F.lit(column).alias("column"), value.cast("string").alias("value"), ts.cast("bigint").alias("ts"))
        cells.withColumn("deleted", F.lit(None).cast("string")).write.mode("append").parquet(path)

    def delete(rows, scope, ts, **named):
        marks = rows.select(text("k").alias("rowkey"), "k", *[F.lit(v).alias(n) for n, v in named.items()])
        keyed.deletion(marks, scope, ts).write.mode("append").parquet(path)

    put(part.where("k % 6 = 0"), "name", "p_brand", F.lit("back"), F.col("k") + 2_000_000)
    delete(part.where("k % 3 = 0"), keyed.FAMILY, F.col("k") + 1_000_000, family="name")
    for column, family in (("p_brand", "name"), ("p_name", "name"), ("p_size", "info"), ("p_type", "other")):
        put(part, family, column, F.col(column), F.col("k"))
    delete(part, keyed.TABLE_FAMILY, F.lit(4_000_000), family="other")
    delete(part.where("k % 7 = 0"), keyed.ROW, F.col("k") + 500_000)
    delete(part.where("k % 11 = 0"), keyed.COLUMN, F.col("k"), family="info", column="p_size")
    put(part.where("k % 9 = 0"), "name", "p_brand", F.lit("too old"), F.col("k") - 1)
    put(part.where("k % 5 = 0"), "other", "p_type", F.lit("again"), F.lit(5_000_000))
    return keyed.live_cells(spark.read.parquet(path))
