from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.operators.events import event_key, filter_b_changes, order_events_by_op
from rillmark.operators.offsets import latest_hour, offset_lag, offset_progress
from rillmark.operators import ordering
from rillmark.operators.ordering import latest, page, with_sequence

from . import query
from .mappings import joined_events
from .views import LINE_KEY, LINE_ORDER, ORDER_EVENT, deal, last_lines, ledger, table, text, with_views


@query(with_views("ledger", """
select k_appname, cast(sum(k_offset) as bigint) as sum_offset from ledger where k_topic = 'view' and k_date > '2024-01-10 00' group by k_appname
"""))
def agg_offset_sum(spark, sf_dir):
    return offset_progress(ledger(spark, sf_dir), "view", "2024-01-10 00")


@query(with_views("ledger", """
select cast(max(s) as bigint) as max_offset, cast(min(s) as bigint) as min_offset from (
  select sum(k_offset) as s from ledger where k_topic = 'view' and k_date > '2024-01-10 00' group by k_appname) x
"""))
def agg_offset_lag(spark, sf_dir):
    return offset_lag(ledger(spark, sf_dir), "view", "2024-01-10 00")


@query(with_views("ledger", "select k_topic, k_partition, k_appname, max(k_date) as k_date from ledger group by 1, 2, 3"))
def agg_latest_hour(spark, sf_dir):
    return latest_hour(ledger(spark, sf_dir))


@query("select count(*) as n from lineitem")
def agg_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_extendedprice desc, l_partkey desc, l_suppkey desc) as rn
  from lineitem) t where rn = 1
""")
def agg_latest_per_key(spark, sf_dir):
    return last_lines(spark, sf_dir).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(with_views("deal trade", ORDER_EVENT))
def agg_order_events(spark, sf_dir):
    return event_key(joined_events(spark, sf_dir))


@query(with_views("deal", """
select fdeal_id, fdeal_gen_time as k_fopt_time, label as fopt_type from (
  select fdeal_id, opttype, fdeal_gen_time, fdeal_gen_time as t, 'fdeal_gen' as label from deal
  union all select fdeal_id, opttype, fdeal_gen_time, fdeal_pay_suss_time, 'fdeal_pay' from deal
  union all select fdeal_id, opttype, fdeal_gen_time, fdeal_cancel_time, 'fdeal_cancel' from deal
  union all select fdeal_id, opttype, fdeal_gen_time, fdeal_consign_time, 'fdeal_consign' from deal
  union all select fdeal_id, opttype, fdeal_gen_time, fdeal_recv_confirm_time, 'Fdeal_recv_confirm' from deal) u
where opttype = 'INSERT' and t = fdeal_gen_time
union all
select fdeal_id, newest, case when fdeal_cancel_time = newest then 'fdeal_cancel' when fdeal_consign_time = newest then 'fdeal_consign'
  when fdeal_gen_time = newest then 'fdeal_gen' when fdeal_pay_suss_time = newest then 'fdeal_pay' else 'Fdeal_recv_confirm' end
from (select *, greatest(fdeal_gen_time, fdeal_pay_suss_time, fdeal_cancel_time, fdeal_consign_time, fdeal_recv_confirm_time) as newest from deal) d
where opttype = 'UPDATE' and newest > fdeal_gen_time
"""))
def agg_order_events_by_op(spark, sf_dir):
    changed = deal(spark, sf_dir).where(F.col("opttype").isin("INSERT", "UPDATE"))
    return order_events_by_op(changed).select("fdeal_id", "k_fopt_time", "fopt_type")


def lines_as_trades(lines):
    """Line rows with the trade key; one row per line."""
    last = latest(lines.select(*LINE_KEY, *LINE_ORDER, "l_quantity"), LINE_KEY, LINE_ORDER)
    return last.select(
        text("l_orderkey").alias("fdeal_id"), text(F.col("l_orderkey") % 500).alias("fbdeal_id"), F.lit("1").alias("ftenancy_id"),
        F.lit("1").alias("fbuyer_id"), text("l_linenumber").alias("ftrade_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("opttime"), F.when(F.col("l_quantity") > 10, "UPDATE").otherwise("INSERT").alias("opttype"),
    )


@query("""
with ranked as (
  select *, row_number() over (partition by l_returnflag = 'R', l_orderkey, l_linenumber
    order by l_shipdate desc, l_extendedprice desc, l_partkey desc, l_suppkey desc) as rn from lineitem),
state as (select * from ranked where rn = 1 and l_returnflag <> 'R'),
batch as (select * from ranked where rn = 1 and l_returnflag = 'R')
select cast(b.l_orderkey as varchar) as fdeal_id, cast(b.l_linenumber as varchar) as ftrade_id, strftime(b.l_shipdate, '%Y-%m-%d') as opttime
from batch b left join state s on b.l_orderkey = s.l_orderkey and b.l_linenumber = s.l_linenumber
where b.l_quantity > 10 and (s.l_orderkey is null or b.l_shipdate > s.l_shipdate)
""")
def agg_b_change_rule(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    batch, state = lines_as_trades(lines.where("l_returnflag = 'R'")), lines_as_trades(lines.where("l_returnflag <> 'R'"))
    return filter_b_changes(batch, state).select("fdeal_id", "ftrade_id", "opttime")


@query("select event_id, row_number() over (order by value, event_id) as seq from events")
def sort_by_change_time(spark, sf_dir):
    return with_sequence(table(spark, sf_dir, "events").select("event_id", "value"), ["value", "event_id"]).drop("value")


@query("select p_partkey, p_name from part order by p_partkey limit 100")
def limit_scan(spark, sf_dir):
    return ordering.limit_scan(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", 100)


@query("select c_custkey, c_name from customer where regexp_matches(c_name, '[13579]$') order by c_name, c_custkey limit 20 offset 40")
def page_scan(spark, sf_dir):
    return page(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", "[13579]$", 3, 20, ["c_custkey"])


@query("""
select o_orderkey, cast(o_orderdate as varchar) as o_orderdate from orders where regexp_matches(cast(o_orderdate as varchar), '-0[1-6]-')
order by orders.o_orderdate, o_orderkey limit 50 offset 450
""")
def page_scan_deep(spark, sf_dir):
    found = page(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "-0[1-6]-", 10, 50, ["o_orderkey"])
    return found.withColumn("o_orderdate", text("o_orderdate"))
