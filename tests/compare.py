"""Run registered queries beside their SQL and compare the results."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.9g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(out, key=repr)


def from_spark(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def from_duckdb(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return rows_of(names, result.fetchall())


def check(spark, con, sf_dir, name, fn, sql):
    """None when equal, else what differs."""
    names, rows = from_spark(fn(spark, sf_dir))
    if sql is None:
        return None if rows else "no rows"
    want_names, want = from_duckdb(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if not want:
        return "the SQL gives no rows"
    if rows != want:
        have, need = set(rows), set(want)
        return f"{len(rows)} rows, {len(want)} wanted; extra {list(have - need)[:2]}; missing {list(need - have)[:2]}"
    return None


def main(argv):
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import registry

    registry.load()
    sf_dir, wanted = argv[0], argv[1:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, fn in registry.QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = check(spark, con, sf_dir, name, fn, registry.ORACLE.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
