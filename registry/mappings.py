from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.coerce import conform, conform_record, schema_of
from rillmark.operators.events import event_key, join_deal_trades, order_events
from rillmark.operators.filters import filter_account
from rillmark.plans import commerce, customers
from rillmark.plans.common import with_etl_date
from rillmark.plans.configured import fanout_events, map_events
from rillmark.sources.decode import decode_batches, fields

from . import query
from .scalars import MONTHS, STAGE, TEN, YEAR_WEEK
from .views import (
    child, coupon, deal, member, name_dim, packed_batches, region_dim, score, source_dim, store_dim, table, text, trade, with_views,
)

AS_OF, LOADED = "2019-03-01", "2019-03-01 00:00:00"


def nulls(names, kind="varchar") -> str:
    return ", ".join(f"cast(null as {kind}) as {n.lower()}" for n in names)


def missing(names, present) -> str:
    have = {p.lower() for p in present}
    return nulls([n for n in names if n.lower() not in have])


def calendar_of(d: str, time: str) -> str:
    """Calendar columns from a date and the two-digit hour."""
    parts = {
        "k_dt": "cast(d as varchar)", "k_year": "cast(year(d) as varchar)",
        "k_year_quarter": "cast(year(d) as varchar) || '-Q' || cast(quarter(d) as varchar)",
        "k_year_month": "strftime(d, '%Y-%m')", "k_year_week": YEAR_WEEK, "k_y_m_tenofmonth": TEN,
        "k_year_week_day": f"{YEAR_WEEK} || '-' || cast(isodow(d) as varchar)",
    }
    return ", ".join(f"{sql} as {name}" for name, sql in parts.items()).replace("(d", f"({d}").replace("d +", f"{d} +") + f", {time} as k_hours"


EVENT_CONFIG = {
    "appName": "demo", "topic": "events", "kuduTable": "event.demo",
    "configs": [
        {"eventId": "buy", "condition": "event_type_=_purchase", "mappping": [
            {"target": "_ftenancy_id", "source": "tenant", "defaultvalue": ""},
            {"target": "_fopt_time", "source": "ts", "defaultvalue": ""},
            {"target": "channel", "source": "", "defaultvalue": "web"},
            {"target": "Amount", "source": "value", "defaultvalue": ""},
            {"target": "amount", "source": "value", "defaultvalue": ""},
        ]},
        {"eventId": "big", "condition": "value_>_50", "mappping": [
            {"target": "_ftenancy_id", "source": "tenant", "defaultvalue": ""},
            {"target": "_fopt_time", "source": "ts", "defaultvalue": ""},
            {"target": "channel", "source": "event_type", "defaultvalue": ""},
            {"target": "amount", "source": "value", "defaultvalue": ""},
        ]},
        {"eventId": "small", "condition": "value_<_5", "mappping": [
            {"target": "_fopt_time", "source": "ts", "defaultvalue": ""},
            {"target": "channel", "source": "event_type", "defaultvalue": ""},
        ]},
        {"eventId": "seen", "mappping": [
            {"target": "_ftenancy_id", "source": "tenant", "defaultvalue": ""},
            {"target": "channel", "source": "", "defaultvalue": "any"},
        ]},
    ],
}
EVENT_TARGET = schema_of([
    ("id", "string"), ("_ftenancy_id", "string", False), ("_event_id", "string"), ("channel", "string"), ("amount", "double"),
    ("_dt", "string"), ("_years", "string"), ("_year_quarter", "string"), ("_year_month", "string"),
    ("_year_week", "string"), ("_y_m_tenofmonth", "string"), ("_hours", "string"),
])


def event_records(spark, sf_dir, bad_every: int | None = None):
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    if bad_every:
        bad = F.col("event_id") % bad_every
        time = F.when(bad == 0, "2024").when(bad == 1, F.lit(None)).when(bad == 2, "2024-01-05").otherwise(time)
    return table(spark, sf_dir, "events").select(
        text("event_id").alias("id"), "event_type", text("value").alias("value"), time.alias("ts"),
        text(F.col("user_id") % 10).alias("tenant"),
    )


def with_id(config):
    """The same configuration with the record id mapped in every rule."""
    extra = {"target": "id", "source": "id", "defaultvalue": ""}
    return {**config, "configs": [{**r, "mappping": [*r["mappping"], extra]} for r in config["configs"]]}


D = "cast(ts as date)"
EVENT_DERIVED = f"""strftime(ts, '%Y-%m-%d') as _dt, strftime(ts, '%Y') as _years,
  strftime(ts, '%Y') || '-Q' || cast(quarter(ts) as varchar) as _year_quarter, strftime(ts, '%Y-%m') as _year_month,
  (select {YEAR_WEEK} from (select {D} as d) x) as _year_week, (select {TEN} from (select {D} as d) x) as _y_m_tenofmonth,
  strftime(ts, '%H') as _hours"""
EVENT_RULES = f"""
select cast(event_id as varchar) as id, cast(user_id % 10 as varchar) as _ftenancy_id, 'buy' as _event_id, 'web' as channel, value as amount, {EVENT_DERIVED}
from events where event_type = 'purchase'
union all select cast(event_id as varchar), cast(user_id % 10 as varchar), 'big', event_type, value, {EVENT_DERIVED} from events where value > 50
union all select cast(event_id as varchar), null, 'small', event_type, null, {EVENT_DERIVED} from events where value < 5
union all select cast(event_id as varchar), cast(user_id % 10 as varchar), null, 'any', null, null, null, null, null, null, null, null from events
"""


@query(EVENT_RULES)
def map_config(spark, sf_dir):
    return map_events(event_records(spark, sf_dir), with_id(EVENT_CONFIG), EVENT_TARGET)


@query("""
select cast(event_id as varchar) as id, 'buy' as rule from events where event_type = 'purchase'
union all select cast(event_id as varchar), 'big' from events where value > 50
union all select cast(event_id as varchar), 'small' from events where value < 5
union all select cast(event_id as varchar), 'always' from events
""")
def map_event_fanout(spark, sf_dir):
    rows = fanout_events(event_records(spark, sf_dir), with_id(EVENT_CONFIG), EVENT_TARGET)
    return rows.select("id", F.coalesce("_event_id", F.lit("always")).alias("rule"))


@query("""
select cast(event_id as varchar) as id, case when event_id % 8 <> 1 then 'buy' end as event_id,
  case when event_id % 8 <> 1 then strftime(ts, '%H') end as hours
from events where event_type = 'purchase' and event_id % 8 not in (0, 2)
""")
def map_derivation_reject(spark, sf_dir):
    only_buy = {**EVENT_CONFIG, "configs": EVENT_CONFIG["configs"][:1]}
    rows = map_events(event_records(spark, sf_dir, bad_every=8), with_id(only_buy), EVENT_TARGET)
    return rows.select("id", F.col("_event_id").alias("event_id"), F.col("_hours").alias("hours"))


@query(with_views("child", f"""
select ftenancyid as k_ftenancy_id, fmid as k_fid, fbid as k_fbid, fnickname, fbirthday, fbirthday as fexp_date_baby,
  case when fbirthday = 'bad' then null when substr(fbirthday, 6) < '03-01' then '2020-' || substr(fbirthday, 6)
    else '2019-' || substr(fbirthday, 6) end as fnext_birthday,
  m as fbaby_age, {STAGE} as fbabyagestage, '{LOADED}' as etl_date,
  {missing(customers.BABY_FIELDS, ["Fnickname", "Fbirthday"])}
from (select *, {MONTHS} as m from child) c
"""))
def map_baby(spark, sf_dir):
    return customers.map_baby(child(spark, sf_dir), AS_OF, LOADED)


COUPON_HAVE = ["Fplatform_id", "Fuse_user_id", "Fcoupon_code", "Fget_time", "Fuse_time", "Freturn_time"]


@query(with_views("deal coupon", f"""
select fplatform_id as k_ftenancy_id, case when code = 3 then fuse_user_id else fuser_id end as k_fid, code as fop_type, t as k_fopt_time,
  {calendar_of("d", "substr(t, 12, 2)")}, {", ".join(c.lower() for c in COUPON_HAVE)}, '{LOADED}' as etl_date,
  {missing(commerce.COUPON_FIELDS, COUPON_HAVE)}
from (select *, cast(substr(t, 1, 10) as date) as d from (
  select *, case when freturn_time > fget_time and freturn_time > fuse_time then 4 when fuse_time > fget_time then 3 else 1 end as code,
    greatest(fget_time, fuse_time, freturn_time) as t from coupon) a) b
"""))
def map_coupon(spark, sf_dir):
    return commerce.map_coupon(coupon(spark, sf_dir), LOADED)


@query(with_views("score", f"""
select event_id, ftenancyid as k_ftenancy_id, fuid as k_fid, case when faccounttype = '2' then faccountpoints end as faccountpoints,
  case when faccounttype = '4' then faccountpoints end as fmlevelvalue, '{LOADED}' as etl_date
from score where faccounttype in ('2', '4')
"""))
def map_score(spark, sf_dir):
    rows = filter_account(score(spark, sf_dir)).withColumn("_place", F.struct("event_id"))
    return customers.map_score(rows, LOADED).select("*", "_place.event_id").drop("_place")


MEMBER_HAVE = [
    "Fnickname", "Fsex", "Fbirthday", "Fregion", "FdiffSrcRegTime", "FregisterSource", "Fproperty", "FrelationWithBaby",
    "Freferrer", "Frecruiter", "Fmanager", "Fcreator", "FcreatorDepartment", "FpromoteActive", "FmemberSource", "Faddress",
]
REGISTERED = """case when fregistersource = cast(reg_key as varchar) then strftime(to_timestamp(reg_epoch) at time zone 'UTC', '%Y-%m-%d %H:%M:%S')
    when fregistersource = '7' then '2020-09-13 12:26:40' end as faddtime"""
BORN = """case when substr(fbirthday, 6) < '03-01' then '2020-' else '2019-' end || substr(fbirthday, 6) as fbirthday_next"""


@query(with_views("member region_dim", f"""
select ftenancyid as k_ftenancy_id, fuid as k_fid, {", ".join(c.lower() for c in MEMBER_HAVE if c not in ("Fproperty", "Fregion"))},
  cast(fproperty as varchar) as fproperty, fregion, {REGISTERED}, {BORN},
  bin(fproperty) as fproperty_str, case when fproperty >= 16 then cast((fproperty // 16) % 2 as varchar) else '' end as fbindweichat,
  fprovincename, fcityname, fdistrictname, '{LOADED}' as etl_date, {missing(customers.MEMBER_FIELDS, MEMBER_HAVE)}
from member left join region_dim on fregion = fprovincesysno || '_' || fcitysysno || '_' || fdistrictsysno
"""))
def map_member(spark, sf_dir):
    return customers.map_member(member(spark, sf_dir), region_dim(spark, sf_dir), AS_OF, loaded=LOADED)


RELATIONS = "['未知','父亲','母亲','爷爷','奶奶','外公','外婆','无关系','其他']"
SOURCES = "case fregistersource when '1' then '零售共场工具端' when '2' then '后台' when '3' then '宝宝店思迅同步' when '5' then 'pos端' when '6' then 'app' when '7' then '微商城' else '其他' end"
NAMED = " ".join(
    f"left join name_dim n{i} on n{i}.k_ftenancy_id = ftenancyid and n{i}.code = {c}" for i, c in enumerate(customers.MEMBER_NAME_CODES)
)
TYPED_TEXT = [c for c in customers.MEMBER_TEXT if c not in MEMBER_HAVE]


@query(with_views("member region_dim name_dim store_dim source_dim", f"""
select ftenancyid as k_ftenancy_id, fuid as k_fid, fnickname, fbirthday, fregion, fdiffsrcregtime, freferrer, frecruiter, fmanager, fcreator,
  fcreatordepartment, fpromoteactive, 'a' || chr(9) || 'b' || chr(10) || substr(faddress, 3) as faddress, fproperty, cast(frelationwithbaby as int) as frelationwithbaby,
  cast(fregistersource as int) as fregistersource, cast(m.fmembersource as int) as fmembersource,
  {nulls(TYPED_TEXT)}, {nulls(["fmid", "faccount_type", "fusertype", "frating"], "int")},
  0 as fmemberlevel, 0 as fmobilestatus, 0 as fmemberproperty, 0 as fpregnantplan, 0 as fstatus,
  {RELATIONS}[cast(frelationwithbaby as int) + 1] as frelationwithbaby_name, case when fsex = '' then '0' else fsex end as fsex,
  case fsex when '0' then '未知' when '1' then '女' when '2' then '男' end as fsex_name, {SOURCES} as fregistersource_name,
  {REGISTERED}, {BORN}, bin(fproperty) as fproperty_str,
  case when fproperty >= 16 then cast((fproperty // 16) % 2 as int) end as fbindweichat, '{LOADED}' as etl_date,
  fprovincename, fcityname, fdistrictname, {", ".join(f"n{i}.name as {c}_name" for i, c in enumerate(customers.MEMBER_NAME_CODES))},
  storename as fcreatordepartment_name, fmembersource_name
from member m left join region_dim on fregion = fprovincesysno || '_' || fcitysysno || '_' || fdistrictsysno {NAMED}
left join store_dim s on s.k_ftenancy_id = ftenancyid and storecode = fcreatordepartment
left join source_dim d on d.k_ftenancy_id = ftenancyid and d.fmembersource = m.fmembersource
"""))
def map_member_typed(spark, sf_dir):
    dims = {"region": region_dim, "name": name_dim, "store": store_dim, "source": source_dim}
    return customers.map_member_typed(member(spark, sf_dir), {n: d(spark, sf_dir) for n, d in dims.items()}, AS_OF, loaded=LOADED)


def levels(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        text(F.col("p_partkey") % 10).alias("fTenancyId"), text("p_partkey").alias("fLevelId"),
        F.concat("p_name", F.lit("\r\n")).alias("fLevelName"), text("p_size").alias("fLevelGrowthFloor"),
    )


LEVELS = f"""
select cast(p_partkey % 10 as varchar) as k_ftenancy_id, cast(p_partkey as varchar) as flevelid, p_name as flevelname,
  cast(p_size as varchar) as flevelgrowthfloor, '{LOADED}' as etl_date from part
"""


@query(LEVELS)
def map_member_level(spark, sf_dir):
    return customers.map_level(levels(spark, sf_dir), LOADED)


@query(f"""
select cast(s_suppkey % 10 as varchar) as k_ftenancy_id, cast(s_suppkey as varchar) as fmembersource, s_name as fmembersource_name,
  cast(s_nationkey % 2 as varchar) as fsourcestatus, '{LOADED}' as etl_date from supplier
""")
def map_member_source(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(
        text(F.col("s_suppkey") % 10).alias("fTenancyId"), text("s_suppkey").alias("fMemberSource"),
        F.concat(F.lit("\t"), "s_name").alias("fMemberSourceName"), text(F.col("s_nationkey") % 2).alias("fSourceStatus"),
    )
    return customers.map_source(rows, LOADED)


LINE_HAVE = {
    "orderNo": "cast(l_orderkey as varchar)", "orderInId": "cast(l_linenumber as varchar)", "skuNo": "cast(l_partkey as varchar)",
    "dealPrice": "cast(cast(l_quantity as int) as varchar)", "saleTime": "t", "storeCode": "cast(l_suppkey as varchar)",
    "brandName": "p_brand", "cateName1": "p_type", "skuName": "p_name",
}


@query(f"""
select cast(l_suppkey % 10 as varchar) as k_ftenancy_id, cast(l_orderkey % 1500 as varchar) as k_fid, t as k_fopt_time,
  {calendar_of("d", "'08'")}, {", ".join(f"{sql} as {n.lower()}" for n, sql in LINE_HAVE.items())},
  {missing(commerce.ORDER_LINE_FIELDS, LINE_HAVE)}, '{LOADED}' as etl_date
from (select *, cast(l_shipdate as date) as d, strftime(l_shipdate, '%Y-%m-%d') || ' 08:30:00' as t from lineitem) l
join part on l_partkey = p_partkey where d >= date '2000-06-01' and l_orderkey % 17 <> 0
""")
def map_order_line(spark, sf_dir):
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    time = F.when(F.col("l_orderkey") % 17 == 0, "").otherwise(F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 08:30:00")))
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        text(F.col("l_suppkey") % 10).alias("cal_platformNum"), text(F.col("l_orderkey") % 1500).alias("fuid"),
        text("l_orderkey").alias("orderNo"), text("l_linenumber").alias("orderInId"), text("l_partkey").alias("skuNo"),
        text(F.col("l_quantity").cast("int")).alias("dealPrice"), time.alias("saleTime"), text("l_suppkey").alias("storeCode"),
        F.col("p_brand").alias("brandName"), F.col("p_type").alias("cateName1"), F.col("p_name").alias("skuName"),
    )
    return commerce.map_order_line(rows, "2000-08-20", loaded=LOADED)


@query(f"""
select cast((p_partkey // 20) % 10 as varchar) as k_ftenancy_id, cast(p_partkey as varchar) as skuno, p_name as skuname,
  p_brand as brandname, p_type as catename1, cast(p_size as varchar) as standard,
  {missing(commerce.SKU_FIELDS, ["skuNo", "skuName", "brandName", "cateName1", "standard"])}, '{LOADED}' as etl_date
from part
""")
def map_sku_dim(spark, sf_dir):
    element = F.to_json(F.struct(
        text("p_partkey").alias("skuNo"), F.col("p_name").alias("skuName"), F.col("p_brand").alias("brandName"),
        F.col("p_type").alias("cateName1"), text("p_size").alias("standard"),
    ))
    messages = packed_batches(table(spark, sf_dir, "part"), F.col("p_partkey"), 20, "retail", 2, element)
    records = fields(decode_batches(messages, only_type=2), ["cal_platformNum", *commerce.SKU_FIELDS])
    return commerce.map_sku(records, LOADED)


@query(f"""
select cast((s_suppkey // 20) % 10 as varchar) as k_ftenancy_id, cast(s_suppkey as varchar) as storecode, s_name as storename,
  cast(s_nationkey as varchar) as province, {missing(commerce.STORE_FIELDS, ["storeCode", "storeName", "province"])}, '{LOADED}' as etl_date
from supplier
""")
def map_store_dim(spark, sf_dir):
    element = F.to_json(F.struct(
        text("s_suppkey").alias("storeCode"), F.col("s_name").alias("storeName"), text("s_nationkey").alias("province"),
    ))
    messages = packed_batches(table(spark, sf_dir, "supplier"), F.col("s_suppkey"), 20, "retail", 5, element)
    records = fields(decode_batches(messages, only_type=5), ["cal_platformNum", *commerce.STORE_FIELDS])
    return commerce.map_store(records, LOADED)


def joined_events(spark, sf_dir):
    """Event rows of all order inserts and updates."""
    changed = deal(spark, sf_dir).where(F.col("opttype").isin("INSERT", "UPDATE")).drop("opttype")
    platform = (F.col("fdeal_id").cast("bigint") % 3).cast("string")
    return order_events(join_deal_trades(changed.withColumn("fplatform_id", platform), trade(spark, sf_dir).drop("opttime")))


MAPPED_EVENT = f"""
select k_ftenancy_id, k_dt, k_fid, k_fopt_time, ftrade_id, fdeal_id, fskuid, fbdeal_id, fopt_type,
  {calendar_of("d", "'00'").split(",", 1)[1]}, cast(cast(fdeal_id as bigint) % 3 as varchar) as fplatform_id, '{LOADED}' as etl_date
from (select *, cast(k_dt as date) as d from order_event) e
"""


@query(with_views("deal trade order_event", MAPPED_EVENT))
def map_order_event(spark, sf_dir):
    return commerce.map_order_event(event_key(joined_events(spark, sf_dir), ["fplatform_id"]), LOADED)


TRACKER_HAVE = {"ip": "'10.0.0.' || cast(user_id as varchar)", "logtype": "'40000'", "appid": "event_type", "viewid": "cast(event_id as varchar)"}


@query(f"""
select 'openApp' as event_id, user_id as fuid, '2024-01-05' as dt, '2024' as years, '1' as year_week, '1' as y_m_tenofmonth, '2024_Q1' as year_quarter,
  '2024年1月' as year_month, '5' as numofweek, '5' as numofyear, strftime(ts, '%Y-%m-%d %H:%M:%S') as fopt_time, cast(hour(ts) as int) as hours,
  'p' || cast(user_id % 7 as varchar) as province_name, cast(null as varchar) as city_name, cast(null as varchar) as district_name,
  {", ".join(f"{sql} as {n}" for n, sql in TRACKER_HAVE.items())}, {missing(commerce.TRACKER_FIELDS, TRACKER_HAVE)}, {nulls(commerce.TRACKER_EMPTY)}
from events where event_type in ('view', 'click') and cast(ts as date) = date '2024-01-05' and user_id <> 0
""")
def map_tracker_event(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        text("user_id").alias("userid"), text(F.unix_millis(F.col("ts").cast("timestamp"))).alias("fronttime"),
        F.date_format("ts", "yyyy-MM-dd").alias("days"), F.when(F.col("event_type").isin("view", "click"), "40000").otherwise("1").alias("logtype"),
        F.concat(F.lit("10.0.0."), text("user_id")).alias("ip"), F.col("event_type").alias("appid"), text("event_id").alias("viewid"),
        F.concat(F.lit("p"), text(F.col("user_id") % 7)).alias("province"),
    )
    return commerce.map_tracker(rows, "2024-01-05")


@query("""
select o_orderkey, cast(o_custkey as int) as o_custkey, o_totalprice, case when o_orderkey % 5 = 0 then null else o_orderstatus end as o_orderstatus,
  case when o_orderkey % 3 = 0 then null else o_orderkey % 3 = 1 end as flag, cast(null as varchar) as note
from orders
""")
def map_conform_schema(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("extra"), F.when(key % 5 == 0, "").otherwise(F.col("o_orderstatus")).alias("O_OrderStatus"),
        text("o_totalprice").alias("o_totalprice"), text("o_custkey").alias("o_custkey"), text(key).alias("o_orderkey"),
        F.when(key % 3 == 0, "").when(key % 3 == 1, "True").otherwise("no").alias("flag"),
    )
    schema = schema_of([
        ("o_orderkey", "int64", False), ("o_custkey", "int32"), ("o_totalprice", "double"), ("o_orderstatus", "string"),
        ("flag", "bool"), ("note", "string"),
    ])
    return conform(rows, schema)


@query("select cast(regexp_extract(props, '[0-9]+') as bigint) as k, cast(null as varchar) as note, event_id from events")
def map_strict_columns(spark, sf_dir):
    record = F.from_json(
        F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(',"event_id":'), text("event_id"), F.lit("}")), "map<string,string>"
    )
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("note", T.StringType()), T.StructField("event_id", T.LongType())])
    return conform_record(table(spark, sf_dir, "events").select(record.alias("record")), "record", schema)


@query("select event_id, '2019-03-01 00:00:00' as etl_date from events")
def map_etl_date(spark, sf_dir):
    return with_etl_date(table(spark, sf_dir, "events").select("event_id"), LOADED)
