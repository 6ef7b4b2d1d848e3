"""Entity views over the given tables, once as frames and once as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.operators.ordering import latest
from rillmark.session import configure

NEVER = "1970-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def midnight(d: Column) -> Column:
    return F.concat(d.cast("string"), F.lit(" 00:00:00"))


def deal(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key, status, d = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate").cast("date")

    def after(days: Column, when: Column) -> Column:
        return F.when(when, midnight(F.date_add(d, days.cast("int")))).otherwise(NEVER)

    return o.select(
        text(key).alias("fdeal_id"), text(key % 500).alias("fbdeal_id"),
        text(F.col("o_custkey") % 25).alias("ftenancy_id"), text("o_custkey").alias("fbuyer_id"),
        F.when(key % 10 == 0, "DELETE").when(status == "O", "INSERT").otherwise("UPDATE").alias("opttype"),
        midnight(d).alias("fdeal_gen_time"),
        after(key % 3, status.isin("F", "P")).alias("fdeal_pay_suss_time"),
        after(F.lit(1), (status == "O") & (F.col("o_orderpriority") == "5-LOW")).alias("fdeal_cancel_time"),
        after(key % 5, status == "F").alias("fdeal_consign_time"),
        after(key % 7, status == "F").alias("fdeal_recv_confirm_time"),
    )


DEAL = """
select cast(o_orderkey as varchar) as fdeal_id, cast(o_orderkey % 500 as varchar) as fbdeal_id,
  cast(o_custkey % 25 as varchar) as ftenancy_id, cast(o_custkey as varchar) as fbuyer_id,
  case when o_orderkey % 10 = 0 then 'DELETE' when o_orderstatus = 'O' then 'INSERT' else 'UPDATE' end as opttype,
  cast(cast(o_orderdate as date) as varchar) || ' 00:00:00' as fdeal_gen_time,
  case when o_orderstatus in ('F','P') then cast(cast(o_orderdate as date) + cast(o_orderkey % 3 as int) as varchar) || ' 00:00:00' else '1970-01-01 00:00:00' end as fdeal_pay_suss_time,
  case when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then cast(cast(o_orderdate as date) + 1 as varchar) || ' 00:00:00' else '1970-01-01 00:00:00' end as fdeal_cancel_time,
  case when o_orderstatus = 'F' then cast(cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as varchar) || ' 00:00:00' else '1970-01-01 00:00:00' end as fdeal_consign_time,
  case when o_orderstatus = 'F' then cast(cast(o_orderdate as date) + cast(o_orderkey % 7 as int) as varchar) || ' 00:00:00' else '1970-01-01 00:00:00' end as fdeal_recv_confirm_time
from orders
"""

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]


def last_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_ORDER, "l_quantity")
    return latest(lines, LINE_KEY, LINE_ORDER)


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = last_lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        text("l_orderkey").alias("fdeal_id"), text(F.col("l_orderkey") % 500).alias("fbdeal_id"),
        text(F.col("o_custkey") % 25).alias("ftenancy_id"), text("o_custkey").alias("fbuyer_id"),
        text(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ftrade_id"),
        text("l_partkey").alias("fitem_sku_id"), F.col("l_quantity").alias("ftrade_num"),
        F.col("l_shipdate").alias("opttime"),
    )


TRADE = """
select fdeal_id, fbdeal_id, ftenancy_id, fbuyer_id, ftrade_id, fitem_sku_id, ftrade_num, opttime from (
  select cast(l_orderkey as varchar) as fdeal_id, cast(l_orderkey % 500 as varchar) as fbdeal_id,
    cast(o_custkey % 25 as varchar) as ftenancy_id, cast(o_custkey as varchar) as fbuyer_id,
    cast(l_orderkey * 10 + l_linenumber as varchar) as ftrade_id, cast(l_partkey as varchar) as fitem_sku_id,
    l_quantity as ftrade_num, l_shipdate as opttime,
    row_number() over (partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_extendedprice desc, l_partkey desc, l_suppkey desc) as rn
  from lineitem join orders on l_orderkey = o_orderkey) t where rn = 1
"""

ORDER_EVENT = """
select e.ftenancy_id as k_ftenancy_id, substr(t, 1, 10) as k_dt, e.fbuyer_id as k_fid, t as k_fopt_time, ftrade_id,
  e.fdeal_id, fitem_sku_id as fskuid, e.fbdeal_id, fopt_type
from (select *, max(t) over (partition by fdeal_id) as mt from (
    select *, '1' as fopt_type, fdeal_gen_time as t from deal union all
    select *, '2' as fopt_type, fdeal_pay_suss_time as t from deal union all
    select *, '3' as fopt_type, fdeal_cancel_time as t from deal union all
    select *, '4' as fopt_type, fdeal_consign_time as t from deal union all
    select *, '5' as fopt_type, fdeal_recv_confirm_time as t from deal) u
  where t > '1970-01-01 00:00:00' and opttype in ('INSERT','UPDATE')) e
join trade b on e.fdeal_id = b.fdeal_id and e.fbdeal_id = b.fbdeal_id
  and e.ftenancy_id = b.ftenancy_id and e.fbuyer_id = b.fbuyer_id
where t = mt
"""


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        text("r_regionkey").alias("fprovincesysno"), text("n_nationkey").alias("fcitysysno"),
        F.lit("0").alias("fdistrictsysno"), F.col("r_name").alias("fprovincename"),
        F.col("n_name").alias("fcityname"), F.concat("n_name", F.lit("-D")).alias("fdistrictname"),
    )


REGION_DIM = """
select cast(r_regionkey as varchar) as fprovincesysno, cast(n_nationkey as varchar) as fcitysysno, '0' as fdistrictsysno,
  r_name as fprovincename, n_name as fcityname, n_name || '-D' as fdistrictname
from nation join region on n_regionkey = r_regionkey
"""


def name_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text(F.col("s_suppkey") % 10).alias("k_ftenancy_id"), text("s_suppkey").alias("code"), F.col("s_name").alias("name")
    )


NAME_DIM = """
select cast(s_suppkey % 10 as varchar) as k_ftenancy_id, cast(s_suppkey as varchar) as code, s_name as name from supplier
"""


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text(F.col("s_suppkey") % 10).alias("k_ftenancy_id"), text("s_suppkey").alias("storecode"),
        F.concat(F.lit("store "), F.col("s_name")).alias("storename"),
    )


STORE_DIM = """
select cast(s_suppkey % 10 as varchar) as k_ftenancy_id, cast(s_suppkey as varchar) as storecode, 'store ' || s_name as storename from supplier
"""


def source_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenants = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("tenant")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", tenants)
    return rows.select(
        text("tenant").alias("k_ftenancy_id"), text("n_nationkey").alias("fmembersource"),
        F.col("n_name").alias("fmembersource_name"),
    )


SOURCE_DIM = """
select cast(t as varchar) as k_ftenancy_id, cast(n_nationkey as varchar) as fmembersource, n_name as fmembersource_name
from nation, range(10) r(t)
"""


def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1990-01-01").cast("date"), (key % 9000).cast("int"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text(key % 10).alias("FtenancyId"), text(key).alias("Fuid"), F.col("c_name").alias("Fnickname"),
        F.when(key % 4 == 3, "").otherwise(text(key % 4)).alias("Fsex"),
        text(born).alias("Fbirthday"),
        F.concat_ws("_", text("n_regionkey"), text("c_nationkey"), F.lit("0")).alias("Fregion"),
        F.concat(text(key % 3), F.lit(":"), text(key * 60 + 1500000000), F.lit(";7:1600000000")).alias("FdiffSrcRegTime"),
        text(key % 8).alias("FregisterSource"), F.lit("2018-01-01 00:00:00").alias("Faddtime"),
        text(key).alias("Fproperty"), text(key % 9).alias("FrelationWithBaby"), text(key % 110).alias("Freferrer"),
        text(key % 97).alias("Frecruiter"), text(key % 7).alias("Fmanager"), text(key % 31).alias("Fcreator"),
        text(key % 50).alias("FcreatorDepartment"), text(key % 20).alias("FpromoteActive"),
        text("c_nationkey").alias("FmemberSource"), F.concat(F.lit("a\tb\n"), F.col("c_mktsegment")).alias("Faddress"),
    )


MEMBER = """
select cast(c_custkey % 10 as varchar) as ftenancyid, cast(c_custkey as varchar) as fuid, c_name as fnickname,
  case when c_custkey % 4 = 3 then '' else cast(c_custkey % 4 as varchar) end as fsex,
  cast(date '1990-01-01' + cast(c_custkey % 9000 as int) as varchar) as fbirthday,
  cast(n_regionkey as varchar) || '_' || cast(c_nationkey as varchar) || '_0' as fregion,
  cast(c_custkey % 3 as varchar) || ':' || cast(1500000000 + c_custkey * 60 as varchar) || ';7:1600000000' as fdiffsrcregtime,
  cast(c_custkey % 8 as varchar) as fregistersource, '2018-01-01 00:00:00' as faddtime,
  c_custkey as fproperty, cast(c_custkey % 9 as varchar) as frelationwithbaby, cast(c_custkey % 110 as varchar) as freferrer,
  cast(c_custkey % 97 as varchar) as frecruiter, cast(c_custkey % 7 as varchar) as fmanager, cast(c_custkey % 31 as varchar) as fcreator,
  cast(c_custkey % 50 as varchar) as fcreatordepartment, cast(c_custkey % 20 as varchar) as fpromoteactive,
  cast(c_nationkey as varchar) as fmembersource, 'ab' || c_mktsegment as faddress,
  c_custkey % 3 as reg_key, 1500000000 + c_custkey * 60 as reg_epoch
from customer join nation on c_nationkey = n_nationkey
"""


def child(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    born = F.date_add(F.lit("2012-01-01").cast("date"), (key % 3200).cast("int"))
    return o.select(
        text(F.col("o_custkey") % 10).alias("FtenancyId"), text("o_custkey").alias("Fmid"), text(key).alias("Fbid"),
        F.when(key % 50 == 0, "bad").otherwise(text(born)).alias("Fbirthday"),
        F.concat(F.lit("n\r\n"), text(key)).alias("Fnickname"),
    )


CHILD = """
select cast(o_custkey % 10 as varchar) as ftenancyid, cast(o_custkey as varchar) as fmid, cast(o_orderkey as varchar) as fbid,
  case when o_orderkey % 50 = 0 then 'bad' else cast(date '2012-01-01' + cast(o_orderkey % 3200 as int) as varchar) end as fbirthday,
  'n' || cast(o_orderkey as varchar) as fnickname
from orders
"""


def coupon(spark: SparkSession, sf_dir: str) -> DataFrame:
    def happened(c: str) -> Column:
        return F.when(F.col(c) > NEVER, F.col(c)).otherwise("")

    return deal(spark, sf_dir).select(
        F.col("ftenancy_id").alias("Fplatform_id"), F.col("fbuyer_id").alias("Fuser_id"),
        F.concat("fbuyer_id", F.lit("u")).alias("Fuse_user_id"), F.col("fdeal_id").alias("Fcoupon_code"),
        F.col("fdeal_gen_time").alias("Fget_time"), happened("fdeal_pay_suss_time").alias("Fuse_time"),
        happened("fdeal_cancel_time").alias("Freturn_time"),
    )


COUPON = """
select ftenancy_id as fplatform_id, fbuyer_id as fuser_id, fbuyer_id || 'u' as fuse_user_id, fdeal_id as fcoupon_code,
  fdeal_gen_time as fget_time,
  case when fdeal_pay_suss_time > '1970-01-01 00:00:00' then fdeal_pay_suss_time else '' end as fuse_time,
  case when fdeal_cancel_time > '1970-01-01 00:00:00' then fdeal_cancel_time else '' end as freturn_time
from deal
"""


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", text(F.col("user_id") % 10).alias("fTenancyId"), text("user_id").alias("fUid"),
        text(F.col("event_id") % 5).alias("fAccountType"), text(F.floor("value")).alias("fAccountPoints"),
    )


SCORE = """
select event_id, cast(user_id % 10 as varchar) as ftenancyid, cast(user_id as varchar) as fuid,
  cast(event_id % 5 as varchar) as faccounttype, cast(cast(floor(value) as bigint) as varchar) as faccountpoints from events
"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    keyed = e.select(
        F.concat(F.lit("app"), text(F.col("user_id") % 4)).alias("k_appname"), F.col("event_type").alias("k_topic"),
        (F.col("user_id") % 3).cast("int").alias("k_partition"), F.date_format("ts", "yyyy-MM-dd HH").alias("k_date"), "event_id",
    )
    return keyed.groupBy("k_appname", "k_topic", "k_partition", "k_date").agg(F.max("event_id").alias("k_offset"))


LEDGER = """
select 'app' || cast(user_id % 4 as varchar) as k_appname, event_type as k_topic, cast(user_id % 3 as int) as k_partition,
  strftime(ts, '%Y-%m-%d %H') as k_date, max(event_id) as k_offset
from events group by 1, 2, 3, 4
"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the messages of a topic."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("props").alias("value"),
    )


EVENT_LOG = """
select event_type as topic, cast(user_id % 3 as int) as "partition", event_id as "offset", props as value from events
"""

_SQL = {
    "deal": DEAL, "trade": TRADE, "order_event": ORDER_EVENT, "region_dim": REGION_DIM, "name_dim": NAME_DIM,
    "store_dim": STORE_DIM, "source_dim": SOURCE_DIM, "member": MEMBER, "child": CHILD, "coupon": COUPON,
    "score": SCORE, "ledger": LEDGER, "event_log": EVENT_LOG,
}


def with_views(names: str, sql: str) -> str:
    """SQL with some of the views in front."""
    views = ", ".join(f"{n} as ({_SQL[n].strip()})" for n in names.split())
    return f"with {views}\n{sql.strip()}"


def packed(df: DataFrame, key: Column, per_message: int, topic: str, element: Column | None = None) -> DataFrame:
    """Rows packed into change messages, ``per_message`` consecutive unique keys each.

    ``key`` is a unique whole number, so a message never holds more.
    """
    message = F.floor(key / per_message).cast("bigint")
    element = F.to_json(F.struct("*")) if element is None else element
    rows = df.select(message.alias("_m"), key.alias("_k"), element.alias("_e"))
    # Sorting the few elements of a message makes it the same in every run.
    items = F.array_sort(F.collect_list(F.struct("_k", "_e")))
    texts = F.transform(items, lambda i: i["_e"])
    return rows.groupBy("_m").agg(F.to_json(texts).alias("value")).select(
        F.lit(topic).alias("topic"), (F.col("_m") % 4).cast("int").alias("partition"),
        F.col("_m").alias("offset"), "value",
    )


def packed_objects(df: DataFrame, key: Column, per_message: int, topic: str, element: Column) -> DataFrame:
    """Like ``packed`` with elements that are JSON objects, not strings."""
    message = F.floor(key / per_message).cast("bigint")
    rows = df.select(message.alias("_m"), key.alias("_k"), element.alias("_e"))
    items = F.array_sort(F.collect_list(F.struct("_k", "_e")))
    joined = F.concat(F.lit("["), F.array_join(F.transform(items, lambda i: i["_e"]), ","), F.lit("]"))
    return rows.groupBy("_m").agg(joined.alias("value")).select(
        F.lit(topic).alias("topic"), (F.col("_m") % 4).cast("int").alias("partition"),
        F.col("_m").alias("offset"), "value",
    )


def packed_batches(df: DataFrame, key: Column, per_message: int, topic: str, kind: int, element: Column) -> DataFrame:
    """Typed batch envelopes; the platform is the message number modulo 10."""
    messages = packed_objects(df, key, per_message, topic, element)
    head = F.concat(F.lit(f'{{"content":{{"type":{kind},"platformNum":"'), (F.col("offset") % 10).cast("string"), F.lit('","data":'))
    envelope = F.concat(head, F.col("value"), F.lit("}}"))
    # Every third message is a single envelope, the others are arrays.
    value = F.when(F.col("offset") % 3 == 0, envelope).otherwise(F.concat(F.lit("["), envelope, F.lit("]")))
    return messages.withColumn("value", value)


def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time strings of orders: padded, unpadded and unreadable."""
    key, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    h = (key % 24).cast("int")
    padded = F.format_string("%s %02d:05:09", d.cast("string"), h)
    short = F.format_string("%d-%d-%d %d:5:9", F.year(d), F.month(d), F.dayofmonth(d), h)
    t = F.when(key % 97 == 0, "bad").when(key % 4 == 0, short).otherwise(padded)
    return table(spark, sf_dir, "orders").select("o_orderkey", t.alias("t"))


# The calendar facts come from the date itself, not from the text.
STAMPS = """
select o_orderkey, cast(o_orderdate as date) as d, o_orderkey % 24 as h,
  o_orderkey % 97 = 0 as bad, o_orderkey % 4 = 0 as short
from orders
"""
_SQL["stamps"] = STAMPS
