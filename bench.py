"""Time the headline queries and print one JSON line.

Every query is run to the end into a sink that keeps nothing. Before that it
is run once on the smallest tables, if they lie beside the chosen ones, so
that the times hold the work on the data and less of the start of the JVM.
Pass query names to time only those.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

import registry

HEADLINE = [
    "agg_order_events", "agg_order_events_by_op", "agg_latest_per_key", "agg_b_change_rule", "join_a_to_b", "join_bidirectional",
    "join_name_dim", "dec_change_array", "dec_typed_batch_envelope", "map_config", "map_member", "map_member_typed",
    "map_order_line", "map_order_event", "map_coupon", "fn_year_week", "fn_clean_text", "key_prefix_any", "cells_to_wide",
    "sort_by_change_time", "snk_upsert", "snk_partial_upsert", "snk_bulk_load", "snk_order_events", "st_microbatch_job",
    "st_tumbling_collect", "st_change_join_job", "udf_window_function",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Building a plan is a good part of a short query; leave out the call sites.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    registry.load()
    names = sys.argv[1:] or HEADLINE
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            run(spark, name, small)
    times = {}
    for name in names:
        times[name] = run(spark, name, sf_dir)
        print(name, times[name], file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
