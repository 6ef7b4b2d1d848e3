from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.functions import calendar as cal
from rillmark.functions import person
from rillmark.functions import text as tx
from rillmark.functions.coerce import coerce
from rillmark.functions.labels import REGISTER_SOURCE_LABELS, REGISTER_SOURCE_OTHER, RELATION_LABELS, SEX_LABELS

from . import query
from .views import child, coupon, member, stamps, table, text, with_views

AS_OF = "2019-03-01"
# Weeks start on Sunday and week 1 holds 1 January: %U counts from the first Sunday.
WEEK = """case when year(d + cast(6 - dayofweek(d) as int)) > year(d) then 1
  else cast(strftime(d, '%U') as int) + case when dayofweek(make_date(year(d), 1, 1)) = 0 then 0 else 1 end end"""
YEAR_WEEK = f"cast(year(d) as varchar) || '-W' || lpad(cast({WEEK} as varchar), 2, '0')"
MONTH = "strftime(d, '%Y-%m')"
TEN = f"{MONTH} || case when day(d) <= 10 then '-T1' when day(d) <= 20 then '-T2' else '-T3' end"
HOUR = "lpad(cast(h as varchar), 2, '0')"
SHORT_DAY = "cast(year(d) as varchar) || '-' || cast(month(d) as varchar) || '-' || cast(day(d) as varchar)"


def of_stamps(value: str, bad: str) -> str:
    return with_views("stamps", f"select o_orderkey, case when bad then {bad} else {value} end as value from stamps")


def on_stamps(spark, sf_dir, fn):
    return stamps(spark, sf_dir).select("o_orderkey", fn("t").alias("value"))


@query("select doc_id, replace(replace(replace(text, chr(9), ''), chr(10), ''), chr(13), '') as value from documents")
def fn_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.clean_text("text").alias("value"))


@query(of_stamps(f"case when short then {SHORT_DAY} else cast(d as varchar) end", "'bad'"))
def fn_day(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.day)


@query(of_stamps("cast(year(d) as varchar)", "'bad'"))
def fn_year(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.year)


@query(of_stamps("cast(year(d) as varchar) || '-Q' || cast(quarter(d) as varchar)", "null"))
def fn_quarter(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.quarter)


@query(of_stamps(MONTH, "null"))
def fn_year_month(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.year_month)


@query(of_stamps(YEAR_WEEK, "''"))
def fn_year_week(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.year_week)


@query(of_stamps(TEN, "null"))
def fn_ten_of_month(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.ten_of_month)


@query(of_stamps(HOUR, "null"))
def fn_hour(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.hour)


@query(of_stamps("cast(isodow(d) as int)", "0"))
def fn_weekday(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.weekday)


@query(of_stamps(f"{YEAR_WEEK} || '-' || cast(isodow(d) as varchar)", "'-0'"))
def fn_year_week_day(spark, sf_dir):
    return on_stamps(spark, sf_dir, cal.year_week_day)


@query(with_views("stamps", """
select o_orderkey, cast(d as varchar) as dt, cast(year(d) as varchar) as years,
  cast((dayofyear(d) - 1) // 7 + 1 as varchar) as year_week,
  case when day(d) <= 10 then '1' when day(d) <= 20 then '2' else '3' end as y_m_tenofmonth,
  cast(year(d) as varchar) || '_Q' || cast(quarter(d) as varchar) as year_quarter,
  cast(year(d) as varchar) || '年' || cast(month(d) as varchar) || '月' as year_month,
  cast(isodow(d) as varchar) as numofweek, cast(dayofyear(d) as varchar) as numofyear
from stamps
"""))
def fn_tracker_calendar(spark, sf_dir):
    columns = cal.tracker_calendar("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in columns.items()])


@query("""
select event_id, case when event_id % 11 <> 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') end as fopt_time,
  case when event_id % 11 <> 0 then cast(hour(ts) as int) end as hours,
  case when event_id % 11 <> 0 then strftime(ts + interval 8 hour, '%Y-%m-%d %H:%M:%S') end as local_time
from events
""")
def fn_epoch_ms(spark, sf_dir):
    ms = F.when(F.col("event_id") % 11 == 0, "x").otherwise(text(cal.epoch_ms("ts")))
    rows = table(spark, sf_dir, "events").select("event_id", ms.alias("ms"))
    return rows.select(
        "event_id", cal.epoch_ms_to_time("ms").alias("fopt_time"), cal.epoch_ms_to_hour("ms").alias("hours"),
        cal.epoch_ms_to_time("ms", "Asia/Shanghai").alias("local_time"),
    )


@query(with_views("child", """
select fbid, case when fbirthday = 'bad' then '' when substr(fbirthday, 6) < '03-01' then '2020-' || substr(fbirthday, 6)
  else '2019-' || substr(fbirthday, 6) end as value from child
"""))
def fn_next_birthday(spark, sf_dir):
    return child(spark, sf_dir).select(F.col("Fbid").alias("fbid"), person.next_birthday("Fbirthday", AS_OF, "").alias("value"))


MONTHS = "case when fbirthday <> 'bad' then cast(date_diff('month', date_trunc('month', try_cast(fbirthday as date)), date '2019-03-01') as int) end"


@query(with_views("child", f"select fbid, {MONTHS} as value from child"))
def fn_age_months(spark, sf_dir):
    return child(spark, sf_dir).select(F.col("Fbid").alias("fbid"), person.age_months("Fbirthday", AS_OF).alias("value"))


STAGE = """case when m < -10 then '0' when m between -10 and -7 then '1' when m between -6 and -4 then '2'
  when m between -3 and -1 then '3' when m between 0 and 3 then '4' when m between 4 and 6 then '5'
  when m between 7 and 12 then '6' when m between 13 and 24 then '7' when m between 25 and 36 then '8'
  when m between 37 and 72 then '9' when m between 73 and 168 then '10' when m is not null then '11' end"""


@query(with_views("child", f"select fbid, {STAGE} as value from (select fbid, {MONTHS} as m from child) c"))
def fn_age_stage(spark, sf_dir):
    stage = person.age_stage(person.age_months("Fbirthday", AS_OF))
    return child(spark, sf_dir).select(F.col("Fbid").alias("fbid"), stage.alias("value"))


@query("""
select o_orderkey, case when o_orderkey % 5 = 0 then '2000-01-01 00:00:00'
  when o_orderkey % 4 = 0 then strftime(timestamp '2001-09-09 01:46:40' + interval 1 second * o_orderkey, '%Y-%m-%d %H:%M:%S')
  when o_orderkey % 4 = 1 then '2020-09-13 12:26:40'
  when o_orderkey % 4 = 2 then 'none' end as value
from orders
""")
def fn_keyed_list_lookup(spark, sf_dir):
    key = F.col("o_orderkey")
    wanted = F.when(key % 4 == 0, "1").when(key % 4 == 1, "7").when(key % 4 == 2, "8").otherwise("9")
    pairs = F.when(key % 5 == 0, "").otherwise(
        F.concat(F.lit("1:"), text(key + 1000000000), F.lit(";7:1600000000;7:5;1:3;8:x"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", pairs.alias("l"), wanted.alias("k"))
    value = tx.keyed_list_lookup("l", "k", F.lit("2000-01-01 00:00:00"), bad="none")
    return rows.select("o_orderkey", value.alias("value"))


@query("select o_orderkey, bin(o_orderkey) as value, bin(-o_orderkey - 1) as negative from orders")
def fn_bit_string(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", tx.bit_string(text(key)).alias("value"), tx.bit_string(text(-key - 1)).alias("negative")
    )


@query("""
select o_orderkey, case when o_orderkey >= 16 then cast((o_orderkey // 16) % 2 as varchar) else '' end as fifth,
  case when o_orderkey >= 8 then cast((o_orderkey // 8) % 2 as varchar) end as fourth
from orders
""")
def fn_bit_flag(spark, sf_dir):
    key = text("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", tx.bit_flag(key, 5).alias("fifth"), tx.bit_flag(key, 4, absent=None).alias("fourth")
    )


@query("""
select event_id,
  case when event_id % 10 = 9 then '' else ['未知','父亲','母亲','爷爷','奶奶','外公','外婆','无关系','其他'][event_id % 10 + 1] end as relation,
  case when event_id % 4 = 3 then '' else ['未知','女','男'][event_id % 4 + 1] end as sex,
  case event_id % 25 when 1 then '零售共场工具端' when 12 then 'ERP导入' when 2 then '后台' when 20 then '小程序' when 21 then '云pos'
    when 3 then '宝宝店思迅同步' when 5 then 'pos端' when 6 then 'app' when 7 then '微商城' else '其他' end as source
from events
""")
def fn_label_decode(spark, sf_dir):
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        tx.decode_label(text(key % 10), RELATION_LABELS, "").alias("relation"),
        tx.decode_label(text(key % 4), SEX_LABELS, "").alias("sex"),
        tx.decode_label(text(key % 25), REGISTER_SOURCE_LABELS, REGISTER_SOURCE_OTHER).alias("source"),
    )


@query(with_views("member", "select fuid, case when fsex = '' then '0' else fsex end as fsex from member"))
def fn_default_if_empty(spark, sf_dir):
    return member(spark, sf_dir).select(F.col("Fuid").alias("fuid"), tx.default_if_empty("Fsex", "0").alias("fsex"))


@query(with_views("deal coupon", """
select fcoupon_code, case when freturn_time > fget_time and freturn_time > fuse_time then 4 when fuse_time > fget_time then 3 else 1 end as code,
  greatest(fget_time, fuse_time, freturn_time) as time from coupon
"""))
def fn_latest_operation(spark, sf_dir):
    code, time = tx.latest_operation([(1, "Fget_time"), (3, "Fuse_time"), (4, "Freturn_time")])
    return coupon(spark, sf_dir).select(F.col("Fcoupon_code").alias("fcoupon_code"), code.alias("code"), time.alias("time"))


@query("""
select c_custkey, cast(n_regionkey as varchar) as province, cast(c_nationkey as varchar) as city, '0' as district
from customer join nation on c_nationkey = n_nationkey
""")
def fn_region_split(spark, sf_dir):
    names = ("province", "city", "district")
    codes = [c.alias(n) for n, c in zip(names, tx.region_codes("Fregion"))]
    return member(spark, sf_dir).select(F.col("Fuid").cast("bigint").alias("c_custkey"), *codes)


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_orderkey || '_' || l_linenumber || '_' || case when l_partkey % 5 = 0 then 'null' else cast(l_partkey as varchar) end as value
from lineitem
""")
def fn_row_key(spark, sf_dir):
    part = F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", tx.row_key(["l_orderkey", "l_linenumber", part]).alias("value")
    )


@query("select 0 as lowest, 9 as highest, 10 as buckets, count(*) as n, count(distinct o_custkey) as placed from orders")
def fn_hash_bucket(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", tx.hash_bucket(["o_custkey"], 10).alias("bucket"))
    # Every customer sits in one bucket, and all ten buckets are used.
    pairs = rows.groupBy("o_custkey", "bucket").agg(F.count("*").alias("n"))
    return pairs.agg(
        F.min("bucket").alias("lowest"), F.max("bucket").alias("highest"), F.count_distinct("bucket").cast("int").alias("buckets"),
        F.sum("n").alias("n"), F.count("*").alias("placed"),
    )


def messy(spark, sf_dir):
    key = F.col("o_orderkey")
    number = F.when(key % 6 == 0, "").when(key % 6 == 1, "x").when(key % 6 == 2, F.lit(None)).when(key % 6 == 3, F.concat(F.lit(" "), text(key))).otherwise(text(key))
    flag = F.when(key % 3 == 0, "TRUE").when(key % 3 == 1, "yes").otherwise("")
    return table(spark, sf_dir, "orders").select("o_orderkey", number.alias("number"), flag.alias("flag"), text("o_totalprice").alias("price"))


@query("""
select o_orderkey, case when o_orderkey % 6 >= 4 then o_orderkey end as number,
  case o_orderkey % 3 when 0 then true when 1 then false end as flag, o_totalprice as price,
  case when o_orderkey % 3 = 2 then null when o_orderkey % 3 = 1 then 'yes' else 'TRUE' end as word
from orders
""")
def fn_cast_null(spark, sf_dir):
    return messy(spark, sf_dir).select(
        "o_orderkey", coerce("number", "bigint").alias("number"), coerce("flag", "boolean").alias("flag"),
        coerce("price", "double").alias("price"), coerce("flag", "string").alias("word"),
    )


@query("""
select o_orderkey, case when o_orderkey % 6 >= 4 then o_orderkey end as number, o_orderkey % 3 = 0 as flag,
  case when o_orderkey % 3 = 2 then '' when o_orderkey % 3 = 1 then 'yes' else 'TRUE' end as word
from orders
""")
def fn_cast_skip(spark, sf_dir):
    return messy(spark, sf_dir).select(
        "o_orderkey", coerce("number", "bigint", "skip").alias("number"), coerce("flag", "boolean", "skip").alias("flag"),
        coerce("flag", "string", "skip").alias("word"),
    )


@query("select o_orderkey, case when o_orderkey % 6 >= 4 then o_orderkey when o_orderkey % 6 <> 2 then 0 end as number from orders")
def fn_cast_zero(spark, sf_dir):
    return messy(spark, sf_dir).select("o_orderkey", coerce("number", "bigint", "zero").alias("number"))
