from __future__ import annotations

from pyspark.sql import functions as F

from rillmark.functions.text import row_key
from rillmark.operators import keyed

from . import query
from .views import table, text


def order_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(text("o_orderkey").alias("rowkey"), "o_custkey", "o_orderstatus")


def line_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        row_key(["l_orderkey", "l_linenumber", "l_partkey"]).alias("rowkey"), F.col("l_quantity").cast("int").alias("quantity")
    )


LINES = "select l_orderkey || '_' || l_linenumber || '_' || l_partkey as rowkey, cast(l_quantity as int) as quantity from lineitem"


def order_cells(spark, sf_dir):
    wide = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("rowkey"), "o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority", F.col("o_orderkey").alias("_ts"),
    )
    return keyed.to_cells(wide.drop("_ts"), "rowkey", F.col("rowkey").cast("bigint") * 10)


CELLS = """
select cast(o_orderkey as varchar) as rowkey, 'info' as family, c as "column",
  case c when 'o_custkey' then cast(o_custkey as varchar) when 'o_orderstatus' then o_orderstatus else o_orderpriority end as value,
  o_orderkey * 10 as ts
from orders, (values ('o_custkey'), ('o_orderstatus'), ('o_orderpriority')) v(c)
where c <> 'o_orderstatus' or o_orderkey % 5 <> 0
"""


@query("select cast(o_orderkey as varchar) as rowkey, o_custkey, o_orderstatus from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity = 1)")
def key_get(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").where("l_quantity = 1").select(text("l_orderkey").alias("rowkey"))
    return keyed.get_rows(order_rows(spark, sf_dir), keys)


@query(f"select * from ({CELLS}) x where rowkey = '77' and \"column\" = 'o_custkey'")
def key_get_column(spark, sf_dir):
    return keyed.get_column(order_cells(spark, sf_dir), "77", "o_custkey")


@query("""
select cast(p_partkey as varchar) as rowkey, f as family, case f when 'info' then 'p_size' else 'p_brand' end as "column",
  case f when 'info' then cast(p_size as varchar) else p_brand end as value, p_partkey as ts, case f when 'info' then cast(p_size as bigint) end as long_value
from part, (values ('info'), ('name')) v(f)
""")
def key_get_families(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("rowkey", text("p_partkey"))
    ts = F.col("rowkey").cast("bigint")
    cells = keyed.to_cells(part.select("rowkey", "p_size"), "rowkey", ts, "info")
    for family, column in (("name", "p_brand"), ("other", "p_type")):
        cells = cells.unionByName(keyed.to_cells(part.select("rowkey", column), "rowkey", ts, family))
    return keyed.get_families(cells, ["info", "name"], ["p_size"])


@query(f"select * from ({LINES}) x where starts_with(rowkey, '12')")
def key_prefix(spark, sf_dir):
    return keyed.key_prefix(line_rows(spark, sf_dir), "12")


@query(f"""
select * from ({LINES}) x where split_part(rowkey, '_', 1) in (select cast(o_orderkey as varchar) from orders where o_orderstatus = 'P')
""")
def key_prefix_any(spark, sf_dir):
    prefixes = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.concat(text("o_orderkey"), F.lit("_")).alias("prefix"))
    return keyed.key_prefix_any(line_rows(spark, sf_dir), prefixes)


@query(f"select * from ({LINES}) x where regexp_matches(rowkey, '_3_.*7$')")
def key_regex(spark, sf_dir):
    return keyed.key_regex(line_rows(spark, sf_dir), "_3_.*7$")


@query(f"select * from ({LINES}) x where rowkey >= '200' and rowkey < '31'")
def key_range(spark, sf_dir):
    return keyed.key_range(line_rows(spark, sf_dir), "200", "31")


@query(f"select rowkey from ({LINES}) x")
def key_list(spark, sf_dir):
    return keyed.key_list(line_rows(spark, sf_dir))


@query(CELLS)
def cells_from_wide(spark, sf_dir):
    return order_cells(spark, sf_dir)


@query("""
select cast(o_orderkey as varchar) as rowkey, cast(o_custkey as varchar) as o_custkey,
  case when o_orderkey % 3 = 0 then 'later' when o_orderkey % 5 <> 0 then o_orderstatus end as o_orderstatus
from orders
""")
def cells_to_wide(spark, sf_dir):
    cells = order_cells(spark, sf_dir)
    newer = cells.where((F.col("column") == "o_custkey") & (F.col("rowkey").cast("bigint") % 3 == 0)).select(
        "rowkey", "family", F.lit("o_orderstatus").alias("column"), F.lit("later").alias("value"), (F.col("ts") + 1).alias("ts")
    )
    return keyed.from_cells(cells.unionByName(newer), ["o_custkey", "o_orderstatus"])
