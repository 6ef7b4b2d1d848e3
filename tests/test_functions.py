from rows import values
from pyspark.sql import functions as F

from rillmark.functions import person
from rillmark.functions import text as tx
from rillmark.functions.coerce import coerce, conform, conform_record, schema_of, spark_type

import pytest


def test_clean_text(frame):
    assert values(frame("a", "x\r\n\ty\n", None).select(tx.clean_text("a"))) == [("xy",), (None,)]


def test_row_key_writes_null(frame):
    assert values(frame("a b", ("1", None)).select(tx.row_key(["a", "b"]))) == [("1_null",)]


def test_region_codes(frame):
    df = frame("a", "1_2_3", "1_2", "", None)
    assert values(df.select(*tx.region_codes("a"))) == [("1", "2", "3"), ("1", "2", None), ("", None, None), (None, None, None)]


def test_keyed_list_lookup(frame):
    df = frame("l k f", ("7:1600000000;1:1500000000;1:5", "1", "f"), ("", "1", "f"), (None, "1", "f"), ("1:x", "1", "f"), ("2:5", "1", "f"), ("1", "1", "f"))
    got = [r[0] for r in values(df.select(tx.keyed_list_lookup("l", "k", "f", bad="bad")))]
    assert got == ["2017-07-14 02:40:00", "f", "f", "bad", None, None]


def test_bits(frame):
    df = frame("a", "20", "-1", "x", None, "")
    got = values(df.select(tx.bit_string("a"), tx.bit_flag("a", 5), tx.bit_flag("a", 4, absent=None)))
    assert got == [("10100", "1", "0"), ("1" * 64, "1", "1"), ("", "", None), ("0", "", None), ("0", "", None)]


def test_latest_operation_ties_keep_the_earlier(frame):
    df = frame("a b c", ("2", "2", "1"), ("1", "3", "3"), ("", "", ""), (None, None, "1"))
    code, time = tx.latest_operation([(1, "a"), (3, "b"), (4, "c")])
    assert values(df.select(code, time)) == [(1, "2"), (3, "3"), (1, ""), (4, "1")]


def test_labels(frame):
    df = frame("a", "1", "9", "x", None)
    assert [r[0] for r in values(df.select(tx.decode_label("a", {1: "one"}, "other")))] == ["one", "other", None, None]


def test_birthdays(frame):
    df = frame("b", "2012-02-30", "2012-03-01", "2012-12-31 00:00:00", "bad", None)
    got = values(df.select(person.next_birthday("b", "2019-03-01", ""), person.age_months("b", "2019-03-01")))
    assert got == [("2020-02-30", 85), ("2019-03-01", 84), ("2019-12-31", 75), ("", None), (None, None)]


def test_stages(spark):
    edges = [-11, -10, -7, -6, -4, -3, -1, 0, 3, 4, 6, 7, 12, 13, 24, 25, 36, 37, 72, 73, 168, 169]
    stages = [0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 9, 10, 10, 11]
    df = spark.createDataFrame([(m,) for m in edges], "m int")
    assert [int(r[0]) for r in values(df.select(person.age_stage("m")))] == stages


@pytest.mark.parametrize(
    "policy, expected",
    [
        ("null", [12, None, None, None, None]),
        ("skip", [12, None, None, None, None]),
        ("zero", [12, 0, 0, 0, None]),
    ],
)
def test_coerce_integers(frame, policy, expected):
    df = frame("a", "12", "x", "", " 7", None)
    assert [r[0] for r in values(df.select(coerce("a", "int", policy)))] == expected


def test_coerce_error_fails(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame("a", "x").select(coerce("a", "int", "error")).collect()


def test_coerce_out_of_range(frame):
    assert values(frame("a", "300").select(coerce("a", "tinyint"), coerce("a", "tinyint", "zero"))) == [(None, 0)]


def test_booleans_only_true(frame):
    df = frame("a", "TRUE", "yes", "1", "", None)
    assert [r[0] for r in values(df.select(coerce("a", "boolean")))] == [True, False, False, None, None]


def test_store_types():
    assert [spark_type(n) for n in ("INT8", "unixtime_micros", "varchar", "geometry")] == ["tinyint", "bigint", "string", "string"]
    assert spark_type("unixtime_micros", micros_as_timestamp=True) == "timestamp"


def test_conform_order_and_strict(frame):
    schema = schema_of([("b", "int32"), ("a", "string"), ("c", "double")])
    assert values(conform(frame("A B x", ("1", "2", "3")), schema)) == [(2, "1", None)]
    with pytest.raises(ValueError, match="x"):
        conform(frame("a x", ("1", "3")), schema, strict=True)


def test_conform_record_rejects_unknown_keys(spark):
    schema = schema_of([("a", "int64"), ("b", "string")])
    df = spark.createDataFrame([({"a": "1"},)], "record map<string,string>")
    assert values(conform_record(df, "record", schema)) == [(1, None)]
    bad = spark.createDataFrame([({"a": "1", "z": "2"},)], "record map<string,string>")
    with pytest.raises(Exception, match="does not have"):
        conform_record(bad, "record", schema).collect()


def test_hash_bucket_range(spark):
    df = spark.range(1000).select(tx.hash_bucket(["id"], 10).alias("b")).groupBy("b").count()
    rows = {r["b"]: r["count"] for r in df.collect()}
    assert set(rows) == set(range(10)) and max(rows.values()) < 200
    assert F.col("b") is not None
