import json

from rows import values
from pyspark.sql import functions as F

from rillmark.operators import filters as flt
from rillmark.plans.configured import condition_column, fanout_events, map_events, tenant_field
from rillmark.functions.coerce import schema_of
from rillmark.sources import changes, decode


def messages(spark, *texts):
    return spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(texts)], changes.MESSAGE_SCHEMA)


def records(df):
    return sorted((r["offset"], r["position"], r["record"]) for r in df.collect())


def test_objects_and_strings(spark):
    text = json.dumps([{"a": 1, "B": "x"}, json.dumps({"a": "2"}, indent="\t").replace("{\n\t", "{\n\t")])
    got = records(decode.decode_changes(messages(spark, text)))
    assert got == [(0, 0, {"a": "1", "B": "x"}), (0, 1, {"a": "2"})]


def test_one_bad_element_drops_its_message_only(spark):
    df = messages(spark, '[{"a":"1"},"oops"]', '[{"a":"2"}]', "oops", None, '[{"a":"3"},null]', '[{"a":"4"}', "[]")
    assert [r[2]["a"] for r in records(decode.decode_changes(df))] == ["2"]
    assert sorted(r["offset"] for r in decode.undecodable(df).collect()) == [0, 2, 3, 4, 5]


def test_lowering(spark):
    df = messages(spark, '[{"Ab":"Cd"}]')
    assert records(decode.decode_changes(df, lower="all"))[0][2] == {"ab": "cd"}
    assert records(decode.decode_changes(df, lower="keys"))[0][2] == {"ab": "Cd"}


def test_fields_as_struct(spark):
    df = decode.decode_changes(messages(spark, '[{"a":1,"b":{"c":2}},{"b":null}]'), fields=["a", "b"])
    rows = values(decode.fields(df, ["a", "b"]).orderBy("position").select("a", "b"))
    assert rows == [("1", '{"c":2}'), (None, None)]


def test_content_envelope_replaces_platform(spark):
    df = messages(spark, '[{"p":"7","content":{"a":"1","p":"old"}}]', '{"p":"8","content":{"a":"2"}}', '{"p":"9"}')
    got = sorted(r["record"].items().__iter__().__next__() and tuple(sorted(r["record"].items())) for r in decode.decode_content(df, "p").collect())
    assert got == [(("a", "1"), ("p", "7")), (("a", "2"), ("p", "8"))]


def test_batches_of_one_type(spark):
    df = messages(
        spark,
        '[{"content":{"type":2,"platformNum":"7","data":[{"n":"1"},{"n":"2"}]}},{"content":{"type":3,"platformNum":"7","data":[{"n":"3"}]}}]',
        '{"content":{"type":"3","platformNum":8,"data":[{"n":"4"}]}}',
    )
    got = sorted((r["record"]["n"], r["record"]["cal_platformNum"]) for r in decode.decode_batches(df, only_type=3).collect())
    assert got == [("3", "7"), ("4", "8")]
    assert decode.decode_batches(df).count() == 4


def test_path(spark):
    df = messages(spark, '{"req":{"content":{"k":"v","n":1}}}', '{"req":{}}')
    assert [r["record"] for r in decode.decode_path(df, "req.content").collect()] == [{"k": "v", "n": "1"}]


def test_start_options():
    ledger = changes.kafka_start_options("ledger", "t", [(1, 20), (0, 10)])
    assert json.loads(ledger["startingOffsets"]) == {"t": {"0": 10, "1": 20}}
    assert changes.kafka_start_options("ledger", "t", []) == {"startingOffsets": "earliest"}
    assert changes.kafka_start_options("latest") == {"startingOffsets": "latest"}
    assert changes.kafka_start_options("timestamp", since_ms=5)["startingTimestamp"] == "5"


def test_stored_offset_is_read_again(spark):
    df = spark.createDataFrame([("t", p, o, "") for p in (0, 1) for o in range(4)], changes.MESSAGE_SCHEMA)
    starts = spark.createDataFrame([("t", 0, 2)], "k_topic string, k_partition int, k_offset bigint")
    got = sorted((r["partition"], r["offset"]) for r in changes.from_positions(df, starts).collect())
    assert got == [(0, 2), (0, 3), (1, 0), (1, 1), (1, 2), (1, 3)]


def test_sharded_names(frame):
    df = frame("tableName", "t", "t_", "t_3", "t12", "tx", "t_3x", "T", None)
    assert [r[0] for r in values(flt.filter_table(df, "t"))] == ["t", "t_", "t_3", "t12"]
    assert flt.filter_table(df, "").count() == 8


def test_retention_floor(spark):
    days = spark.createDataFrame([(d,) for d in ("2019-03-31", "2019-03-25", "2019-03-26", "2019-01-10")], "d string")
    got = values(days.select(flt.retention_floor(F.col("d")), flt.retention_floor(F.col("d"), late_day=25)))
    assert got == [("2019-01-01", "2019-02-01"), ("2019-01-01", "2019-01-01"), ("2019-01-01", "2019-02-01"), ("2018-11-01", "2018-11-01")]


def test_conditions(frame):
    assert flt.parse_condition("event_type_=_buy") == ("event_type", "=", "buy")
    assert flt.parse_condition("a_>_5") == ("a", ">", "5")
    assert flt.parse_condition("a") is None and flt.parse_condition(None) is None
    df = frame("a", "10", "9", "x", None)
    get = F.col
    assert [r[0] for r in values(df.select(condition_column("a_>_9", get)))] == [True, False, True, False]
    assert [r[0] for r in values(df.select(condition_column("a_<_10", get)))] == [False, True, False, False]


CONFIG = {"configs": [
    {"eventId": "e1", "condition": "kind_=_a", "mappping": [
        {"target": "_ftenancy_id", "source": "p", "defaultvalue": ""}, {"target": "_fopt_time", "source": "t", "defaultvalue": ""},
        {"target": "n", "source": "n", "defaultvalue": ""}]},
    {"eventId": "e2", "mappping": [{"target": "_ftenancy_id", "source": "p", "defaultvalue": "all"}]},
]}
TARGET = schema_of([("_ftenancy_id", "string"), ("_event_id", "string"), ("n", "int32"), ("_hours", "string")])


def test_config_mapping(frame):
    df = frame("kind p t n", ("a", "7", "2019-01-05 8:00:00", "3"), ("b", "8", "2019-01-05 8:00:00", "4"), ("a", "9", "2019-01-05", "5"))
    got = sorted(values(map_events(df, CONFIG, TARGET)), key=repr)
    # The third record has no hour: its first row is dropped, its second stays.
    assert got == sorted([("7", "e1", 3, "08"), ("all", None, None, None), ("all", None, None, None), ("all", None, None, None)], key=repr)
    assert fanout_events(df, CONFIG, TARGET, on_error="keep").count() == 5
    assert tenant_field(CONFIG) == "p"


def test_numbers_keep_their_text(spark):
    inner = '{"a":1.50,"b":10000000.0,"c":12345678901234567890.12,"d":-1e5,"e":"x 2.50, 3","f":{"g":[1.10,"4.0"]},"h":null,"i":true}'
    want = {"a": "1.50", "b": "10000000.0", "c": "12345678901234567890.12", "d": "-1e5", "e": "x 2.50, 3", "f": '{"g":[1.10,"4.0"]}', "h": None, "i": "true"}
    for text in (f"[{inner}]", json.dumps([inner]), f"[ {inner}]"):
        (row,) = decode.decode_changes(messages(spark, text)).collect()
        assert row["record"] == want
        (row,) = decode.decode_changes(messages(spark, text), fields=list(want)).collect()
        assert row["record"].asDict() == want
    content = decode.decode_content(messages(spark, f'{{"p":1.0,"content":{inner}}}'), "p").collect()
    assert content[0]["record"] == {**want, "p": "1.0"}
    batches = decode.decode_batches(messages(spark, f'[{{"content":{{"type":2,"platformNum":7,"data":[{inner}]}}}}]'), only_type=2).collect()
    assert batches[0]["record"] == {**want, "cal_platformNum": "7", "_cal_type_sel": "2"}
    (row,) = decode.decode_path(messages(spark, f'{{"x":{{"y":{inner}}}}}'), "x.y").collect()
    assert row["record"] == want


def test_undecodable_envelopes(spark):
    good = '{"p":"1","content":{"a":"1"}}'
    texts = [good, f"[{good},{good}]", f'[{good},{{"p":"1"}}]', f"[{good},7]", "x", "[]"]
    lost = [r["value"] for r in decode.undecodable_content(messages(spark, *texts), "p").collect()]
    assert sorted(lost) == sorted(texts[2:])
    good = '{"content":{"type":1,"platformNum":2,"data":[{"a":1}]}}'
    texts = [good, f"[{good}]", f'[{good},{{"content":{{"type":1}}}}]', "[", '{"content":{"type":1,"platformNum":2,"data":[{"a":1},null]}}']
    lost = [r["value"] for r in decode.undecodable_batches(messages(spark, *texts)).collect()]
    assert sorted(lost) == sorted(texts[2:])


def test_starts_are_in_the_filter(spark):
    rows = spark.createDataFrame([("t", p, o, "v") for p in (0, 1, 2) for o in range(4)], changes.MESSAGE_SCHEMA)
    starts = spark.createDataFrame([("t", 0, 2), ("t", 1, None), ("u", 2, 9)], "k_topic string, k_partition int, k_offset long")
    out = changes.from_positions(rows, starts)
    assert sorted((r["partition"], r["offset"]) for r in out.collect()) == [(0, 2), (0, 3)] + [(p, o) for p in (1, 2) for o in range(4)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
