"""Plans at scale: skew, broadcasts, pushdown. Sizes are small, so limits are lowered."""

import contextlib
import io

import pytest
from rows import values
from pyspark.sql import functions as F

import registry
from rillmark.operators.enrich import enrich_name
from rillmark.operators.events import DEAL_KEY, join_changes, join_deal_trades
from rillmark.operators.keyed import get_rows, key_prefix_any
from rillmark.operators import ordering
from rillmark.operators.ordering import latest
from rillmark.session import work_path
from rillmark.sinks.keyed_table import KeyedTable
from rillmark.sources.tables import scan_keyed

registry.load()
SF_DIR = "/root/testdata/sf0.001"

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def big(spark):
    """Everything counts as too big to broadcast, and partitions as skewed early."""
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, final=True):
    if final:
        df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def hot(n):
    """A third of the rows share one key."""
    return F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % n).cast("string")


def keyed(df):
    return df.select(F.col("k").alias("fdeal_id"), *[F.lit("1").alias(c) for c in DEAL_KEY[1:]], *[c for c in df.columns if c != "k"])


def test_hot_order_is_split(big):
    a = keyed(big.range(-1, 3000).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("x")))
    b = keyed(big.range(0, 60000, 1, 8).select(hot(3000).alias("k"), F.col("id").cast("string").alias("ftrade_id")))
    # A folded state is no plain shuffle by itself; the join must still split.
    joined = join_deal_trades(latest(a, DEAL_KEY, ["x"]), b)
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.count() == 60000
    changes = join_changes(a.where("fdeal_id = '5'"), b, latest(a, DEAL_KEY, ["x"]), b)
    assert "SortMergeJoin(skew=true)" in plan(changes)
    assert changes.count() == 60000


def test_hot_prefix_is_split(big):
    prefix = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 3000))
    rows = big.range(0, 60000, 1, 8).select(F.concat_ws("_", prefix, F.col("id")).alias("rowkey"))
    wanted = big.range(500).select(F.concat(F.lit("p"), F.col("id"), F.lit("_")).alias("prefix")).unionAll(big.createDataFrame([("hot_",), ("hot_1",), ("none",)], "prefix string"))
    found = key_prefix_any(rows, wanted)
    assert plan(found).split("Initial Plan")[0].count("Exchange hashpartitioning(_range") == 1
    assert found.count() == found.distinct().count() == rows.where("rowkey like 'hot_%' or cast(substring_index(substring(rowkey, 2), '_', 1) as int) < 500").count()
    assert largest_part(found) < 20000 / 2


def largest_part(df):
    """Most rows of a partition, as they are dealt out."""
    df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return _largest_part(df)
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _largest_part(df):
    return df.groupBy(F.spark_partition_id().alias("part")).count().agg(F.max("count")).first()[0]


def test_prefixes_of_all_lengths_in_one_shuffle(big):
    rows = big.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.format_string("%05d", F.col("id"))).alias("rowkey"), F.col("id").alias("v"))
    asked = ["sam", "same", "same key", "1", "12", "123", "02", "0234", "29999", "299999", "zz", "", None]
    found = key_prefix_any(rows, big.createDataFrame([(p,) for p in asked], "prefix string"))
    text = plan(found).split("Initial Plan")[0]
    assert text.count("Exchange hashpartitioning(_range") == 1
    good = [p for p in asked if p]
    want = sorted((r["rowkey"], r["v"]) for r in rows.collect() if any(r["rowkey"].startswith(p) for p in good))
    assert sorted(values(found)) == want
    # The rows of one key are spread.
    assert largest_part(found.where("rowkey = 'same'")) < 10000 / 2
    assert key_prefix_any(rows.limit(0), big.createDataFrame([("a",)], "prefix string")).count() == 0
    assert key_prefix_any(rows, big.createDataFrame([], "prefix string")).count() == 0


def test_a_deep_page_sorts_few_rows(big, monkeypatch):
    monkeypatch.setattr(ordering, "PAGE_ROWS", 500)
    df = big.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919 % 60000).alias("k"), F.col("id").alias("n"))
    found = ordering.page(df, "k", ".", 1000, 40, ["n"])
    order = sorted(values(df))
    assert sorted(values(found)) == order[999 * 40 : 1000 * 40]
    # What is sorted is a small part, though a third of the rows have one key.
    for n in (100, 1000):
        sorted_rows, skip = ordering._around(df, ["k", "n"], n * 40, 40)
        assert sorted_rows.count() <= 500 and skip < 500
    limits = [values(ordering.page(df, "k", ".", n, 40, ["n"])) for n in (1, 2, 499, 501, 1500, 1501)]
    assert [sorted(x) for x in limits] == [order[(n - 1) * 40 : n * 40] for n in (1, 2, 499, 501, 1500, 1501)]


def test_hot_code_in_a_large_dimension_is_split(big):
    dim = big.range(-1, 3000).select(F.lit("1").alias("k_ftenancy_id"), F.col("id").cast("string").alias("code"), F.lit("n").alias("name"))
    facts = big.range(0, 60000, 1, 8).select(F.lit("1").alias("k_ftenancy_id"), hot(3000).alias("c"), F.col("id").cast("string").alias("row"))
    joined = enrich_name(facts, dim, {"c": "c_name"})
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.where("c_name is null").count() == 0 and joined.count() == 60000
    blank = facts.withColumn("c", F.when(F.col("c") == "-1", "").otherwise(F.col("c")))
    joined = enrich_name(blank, dim, {"c": "c_name"})
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.where("c_name is null").count() == 20000


def test_hot_key_in_a_table_read_by_keys_is_split(big):
    t = KeyedTable(big, work_path(big, "hot"), "k string, n string, v string", ["k", "n"], bucket_on=["k"])
    t.write_batch(big.range(0, 60000, 1, 8).select(hot(3000).alias("k"), F.col("id").cast("string").alias("n"), F.lit("x").alias("v")), 0)
    keys = big.range(-1, 2).select(F.col("id").cast("string").alias("k"))
    found = t.read(keys.unionByName(keys))
    assert "SortMergeJoin(skew=true)" in plan(found)
    assert found.count() == 20000 + 20


def test_keys_asked_for_many_times_are_reduced_first(big):
    df = big.range(0, 60000, 1, 8).select(hot(3000).alias("rowkey"), F.col("id").alias("v"))
    keys = big.range(0, 60000, 1, 8).select(hot(3000).alias("rowkey")).where("rowkey in ('-1', '7')")
    found = get_rows(df, keys)
    assert "SortMergeJoin(skew=true)" in plan(found)
    assert found.count() == 20000 + 20


def test_hot_key_sends_one_row_per_task_when_folded(big):
    df = big.range(0, 60000, 1, 8).select(hot(3000).alias("k"), F.col("id").alias("v"))
    text = plan(latest(df, ["k"], ["v"]), final=False)
    assert text.count("WindowGroupLimit") == 2 and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_equality_reaches_the_scan_and_columns_are_pruned(spark):
    df = spark.read.parquet(f"{SF_DIR}/part.parquet")
    text = plan(scan_keyed(df, {"p_brand": "Brand#2", "p_size": "11"}, ["p_partkey"]), final=False)
    assert "EqualTo(p_brand,Brand#2)" in text and "EqualTo(p_size,11)" in text
    assert "p_retailprice" not in text


def test_only_touched_buckets_are_read(spark):
    t = KeyedTable(spark, work_path(spark, "pruned"), "k string, v string", ["k"], buckets=16)
    t.write_batch(spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v")), 0)
    t.compact()
    keys = spark.range(3).select(F.col("id").cast("string").alias("k"))
    assert len(t.read(keys).inputFiles()) <= 3 < 16 <= len(t.read().inputFiles())
    assert sorted(values(t.read(keys))) == [("0", "x"), ("1", "x"), ("2", "x")]


@pytest.mark.parametrize("name", ["agg_order_events", "join_name_dim", "map_member_typed", "join_bidirectional", "key_prefix_any"])
def test_results_do_not_depend_on_broadcasts(big, name):
    from compare import check, connect

    assert check(big, connect(SF_DIR), SF_DIR, name, registry.QUERIES[name], registry.ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith(("src_", "st_", "snk_", "tbl_", "udf_", "sort_"))))
def test_no_nested_loops(spark, name):
    text = plan(registry.QUERIES[name](spark, SF_DIR), final=False)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
