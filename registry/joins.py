from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.operators import enrich
from rillmark.operators.events import DEAL_KEY, join_changes, join_deal_trades, join_unmatched
from rillmark.operators.offsets import latest_offsets

from . import query
from .views import deal, ledger, member, name_dim, region_dim, source_dim, store_dim, table, text, trade, with_views

SAME_KEY = " and ".join(f"a.{k} = b.{k}" for k in DEAL_KEY)


@query(with_views("region_dim", """
select c_custkey, case when c_custkey % 6 = 0 then '' else n_regionkey || '_' || c_nationkey || '_0' end as fregion,
  fprovincename, fcityname, fdistrictname
from customer join nation on c_nationkey = n_nationkey
left join region_dim on c_custkey % 6 <> 0 and fcitysysno = cast(c_nationkey as varchar) and fcitysysno <> '7'
"""))
def join_region_dim(spark, sf_dir):
    dim = region_dim(spark, sf_dir).where("fcitysysno <> '7'")
    rows = member(spark, sf_dir).select(F.col("Fuid").cast("bigint").alias("c_custkey"), F.col("Fregion").alias("fregion"))
    rows = rows.withColumn("fregion", F.when(F.col("c_custkey") % 6 == 0, "").otherwise(F.col("fregion")))
    return enrich.enrich_region(rows, dim)


def coded_lines(spark, sf_dir):
    supplier = F.when(F.col("l_linenumber") == 1, "").otherwise(text("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text(F.col("l_suppkey") % 10).alias("k_ftenancy_id"),
        supplier.alias("freferrer"), text("l_partkey").alias("fmanager"),
    )


@query(with_views("name_dim", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey % 10 || '' as k_ftenancy_id,
  case when l_linenumber = 1 then '' else cast(l_suppkey as varchar) end as freferrer, cast(l_partkey as varchar) as fmanager,
  a.name as freferrer_name, b.name as fmanager_name
from lineitem
left join name_dim a on l_linenumber <> 1 and a.code = cast(l_suppkey as varchar) and a.k_ftenancy_id = cast(l_suppkey % 10 as varchar)
left join name_dim b on b.code = cast(l_partkey as varchar) and b.k_ftenancy_id = cast(l_suppkey % 10 as varchar)
"""))
def join_name_dim(spark, sf_dir):
    codes = {"freferrer": "freferrer_name", "fmanager": "fmanager_name"}
    return enrich.enrich_name(coded_lines(spark, sf_dir), name_dim(spark, sf_dir), codes)


@query(with_views("store_dim", """
select l_orderkey, l_linenumber, l_partkey, storename
from lineitem left join store_dim on l_linenumber <> 1 and storecode = cast(l_suppkey as varchar) and k_ftenancy_id = cast(l_suppkey % 10 as varchar)
"""))
def join_store_dim(spark, sf_dir):
    rows = enrich.enrich_store(coded_lines(spark, sf_dir), store_dim(spark, sf_dir), "freferrer", "storename")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "storename")


@query("""
select c_custkey, cast(c_custkey % 12 as varchar) as tenant, case when c_custkey % 12 < 10 then n_name end as source_name
from customer join nation on c_nationkey = n_nationkey
""")
def join_source_dim(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", text(F.col("c_custkey") % 12).alias("tenant"), text("c_nationkey").alias("source")
    )
    joined = enrich.enrich_source(rows, source_dim(spark, sf_dir), "source", "source_name", tenant="tenant")
    return joined.drop("source")


PAIR = ["fdeal_id", "fbuyer_id", "ftrade_id", "fitem_sku_id", "fdeal_gen_time"]
PAIR_SQL = "a.fdeal_id, a.fbuyer_id, ftrade_id, fitem_sku_id, fdeal_gen_time"


@query(with_views("deal trade", f"""
select {PAIR_SQL}, 'b' as origin from deal a join trade b on {SAME_KEY} where a.opttype in ('INSERT', 'UPDATE')
"""))
def join_a_to_b(spark, sf_dir):
    changed = deal(spark, sf_dir).where(F.col("opttype").isin("INSERT", "UPDATE")).withColumn("origin", F.lit("a"))
    state = trade(spark, sf_dir).withColumn("origin", F.lit("b"))
    return join_deal_trades(changed, state).select(*PAIR, "origin")


@query(with_views("deal trade", f"""
select {PAIR_SQL} from trade b join deal a on {SAME_KEY} where b.ftrade_num > 25 and a.opttype <> 'DELETE'
"""))
def join_b_to_a(spark, sf_dir):
    changed = trade(spark, sf_dir).where("ftrade_num > 25")
    state = deal(spark, sf_dir).where("opttype <> 'DELETE'")
    return join_deal_trades(state, changed).select(*PAIR)


@query(with_views("deal trade", f"""
select {PAIR_SQL} from deal a join trade b on {SAME_KEY}
where cast(a.fdeal_id as bigint) % 3 = 0 or cast(b.fdeal_id as bigint) % 3 = 1 or (cast(b.ftrade_id as bigint) % 7 = 0)
"""))
def join_bidirectional(spark, sf_dir):
    a, b = deal(spark, sf_dir).drop("opttype"), trade(spark, sf_dir).drop("opttime")
    key, line = F.col("fdeal_id").cast("bigint"), F.col("ftrade_id").cast("bigint")
    a_changes, b_changes = a.where(key % 3 == 0), b.where((key % 3 == 1) | (line % 7 == 0))
    return join_changes(a_changes, b_changes, a, b).select(*PAIR)


@query("select cast(o_orderkey as varchar) as fdeal_id from orders where o_orderkey not in (select l_orderkey from lineitem)")
def join_unmatched_a(spark, sf_dir):
    return join_unmatched(deal(spark, sf_dir), trade(spark, sf_dir)).select("fdeal_id")


@query(with_views("ledger", """
select k_appname, k_topic, k_partition, k_date, k_offset
from ledger where k_topic = 'click' qualify row_number() over (partition by k_appname, k_topic, k_partition order by k_date desc) = 1
"""))
def join_latest_offsets(spark, sf_dir):
    return latest_offsets(ledger(spark, sf_dir), topic="click")
