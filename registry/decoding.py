from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.sources.decode import decode_batches, decode_changes, decode_content, decode_path, undecodable

from . import query
from .sources import order_messages
from .views import packed, packed_batches, packed_objects, table


@query("""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'orders' as topic,
  cast((o_orderkey // 20) % 4 as int) as "partition", o_orderkey // 20 as "offset",
  cast(row_number() over (partition by o_orderkey // 20 order by o_orderkey) - 1 as int) as position
from orders
""")
def dec_change_array(spark, sf_dir):
    record = F.col("record")
    return decode_changes(order_messages(spark, sf_dir)).select(
        record["o_orderkey"].cast("bigint").alias("o_orderkey"),
        record["o_custkey"].cast("bigint").alias("o_custkey"),
        record["o_orderstatus"].alias("o_orderstatus"),
        record["o_totalprice"].cast("double").alias("o_totalprice"),
        record["o_orderpriority"].alias("o_orderpriority"),
        "topic", "partition", "offset", "position",
    )


@query("select p_partkey, lower(p_name) as p_name, lower(p_brand) as p_brand, lower(p_type) as p_type from part")
def dec_change_array_lower(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    element = F.to_json(F.struct("p_partkey", F.upper("p_name").alias("P_NAME"), F.col("p_brand").alias("P_Brand"), "p_type"))
    messages = packed_objects(part, F.col("p_partkey"), 20, "part", element)
    record = F.col("record")
    return decode_changes(messages, lower="all").select(
        record["p_partkey"].cast("bigint").alias("p_partkey"),
        *[record[c].alias(c) for c in ("p_name", "p_brand", "p_type")],
    )


@query("select cast(c_custkey % 10 as varchar) as platform, c_custkey, c_name, c_mktsegment from customer")
def dec_content_envelope(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    content = F.struct(F.col("c_custkey"), "c_name", "c_mktsegment", F.lit("old").alias("platform"))
    element = F.to_json(F.struct((F.col("c_custkey") % 10).cast("string").alias("platform"), content.alias("content")))
    many = packed_objects(customer.where("c_custkey % 3 <> 0"), F.col("c_custkey"), 20, "customer", element)
    single = customer.where("c_custkey % 3 = 0").select(
        F.lit("customer").alias("topic"), F.lit(9).alias("partition"), F.col("c_custkey").alias("offset"), element.alias("value")
    )
    record = F.col("record")
    return decode_content(many.unionByName(single), "platform").select(
        record["platform"].alias("platform"), record["c_custkey"].cast("bigint").alias("c_custkey"),
        record["c_name"].alias("c_name"), record["c_mktsegment"].alias("c_mktsegment"),
    )


def batch_messages(spark, sf_dir):
    """SKU (2), order (3) and store (5) batches in one topic."""
    part, orders, supplier = (table(spark, sf_dir, t) for t in ("part", "orders", "supplier"))
    sku = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("no"), F.col("p_name").alias("name")))
    order = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("no"), F.col("o_orderpriority").alias("name")))
    store = F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("no"), F.col("s_name").alias("name")))
    return (
        packed_batches(part, F.col("p_partkey"), 20, "retail", 2, sku)
        .unionByName(packed_batches(orders, F.col("o_orderkey"), 20, "retail", 3, order))
        .unionByName(packed_batches(supplier, F.col("s_suppkey"), 20, "retail", 5, store))
    )


BATCH_ROWS = """
select '2' as type, cast((p_partkey // 20) % 10 as varchar) as platform, cast(p_partkey as varchar) as no, p_name as name from part
union all select '3', cast((o_orderkey // 20) % 10 as varchar), cast(o_orderkey as varchar), o_orderpriority from orders
union all select '5', cast((s_suppkey // 20) % 10 as varchar), cast(s_suppkey as varchar), s_name from supplier
"""


@query(BATCH_ROWS)
def dec_typed_batch_envelope(spark, sf_dir):
    record = F.col("record")
    return decode_batches(batch_messages(spark, sf_dir)).select(
        record["_cal_type_sel"].alias("type"), record["cal_platformNum"].alias("platform"),
        record["no"].alias("no"), record["name"].alias("name"),
    )


@query("select cast(event_id as varchar) as id, regexp_extract(props, '[0-9]+') as k, event_type from events")
def dec_nested_path(spark, sf_dir):
    content = F.concat(
        F.regexp_replace("props", r"\}$", ""), F.lit(',"id":'), F.col("event_id").cast("string"),
        F.lit(',"event_type":"'), F.col("event_type"), F.lit('"}'),
    )
    value = F.concat(F.lit('{"req":{"content":'), content, F.lit("}}"))
    messages = table(spark, sf_dir, "events").select(value.alias("value"))
    record = F.col("record")
    return decode_path(messages, "req.content").select(*[record[c].alias(c) for c in ("id", "k", "event_type")])


@query("""
select 'record' as kind, o_orderkey as id from orders where (o_orderkey // 20) % 5 <> 0
union all select distinct 'message', o_orderkey // 20 from orders where (o_orderkey // 20) % 5 = 0
""")
def dec_malformed_drop(spark, sf_dir):
    m = order_messages(spark, sf_dir)
    cut = F.col("value").substr(F.lit(1), F.length("value") - 5)
    # Cut short, no JSON at all, or an array with an element that is no object.
    bad = F.when(F.col("offset") % 15 == 0, cut).when(F.col("offset") % 15 == 5, F.lit("oops")).otherwise(
        F.concat(F.col("value").substr(F.lit(1), F.length("value") - 1), F.lit(',"{oops"]'))
    )
    m = m.withColumn("value", F.when(F.col("offset") % 5 == 0, bad).otherwise(F.col("value")))
    good = decode_changes(m).select(F.lit("record").alias("kind"), F.col("record")["o_orderkey"].cast("bigint").alias("id"))
    return good.unionByName(undecodable(m).select(F.lit("message").alias("kind"), F.col("offset").alias("id")))
