import json

import pytest
from rows import values
from pyspark.sql import functions as F

from rillmark.functions.coerce import schema_of
from rillmark.session import work_path
from rillmark.sinks.keyed_table import KeyedTable
from rillmark.sources.changes import MESSAGE_SCHEMA
from rillmark.streaming import entities as jobs
from rillmark.streaming.jobs import rate_cap, run_batch, run_feeds


@pytest.fixture
def run(spark):
    def make(job, *texts, batch_id=0):
        df = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(texts)], MESSAGE_SCHEMA)
        job.loaded = "now"
        run_batch(job, df, batch_id)
        return job.target.read()

    return make


@pytest.fixture
def at(spark):
    return lambda cls, *args, **options: cls.at(spark, work_path(spark, cls.app), *args, buckets=2, **options)


def changes(table, *records):
    return json.dumps([{"tableName": table, **r} for r in records])


def one(df, *names):
    (row,) = df.select(*names).collect()
    return tuple(row)


def test_baby(run, at):
    job = at(jobs.BabyJob)
    job.as_of = "2019-03-01"
    got = run(job, changes("t_user_baby_07", {"FtenancyId": "7", "Fmid": "1", "Fbid": "2", "Fbirthday": "2018-01-15", "Fnickname": "a\nb"}), changes("other", {"FtenancyId": "8", "Fmid": "1", "Fbid": "2"}))
    assert one(got, "k_ftenancy_id", "fnickname", "fnext_birthday", "fbaby_age", "fbabyagestage", "etl_date") == ("7", "ab", "2020-01-15", 14, "7", "now")
    # A later record without a birthday leaves it alone.
    got = run(job, changes("t_user_baby", {"FtenancyId": "7", "Fmid": "1", "Fbid": "2", "Fnickname": "c"}), batch_id=1)
    assert one(got, "fnickname", "fbirthday", "fbaby_age") == ("c", "2018-01-15", 14)


def test_coupon(run, at):
    got = run(at(jobs.CouponJob), changes("t_user_coupon", {
        "Fplatform_id": "7", "Fuser_id": "1", "Fuse_user_id": "2", "Fcoupon_code": "c", "Fget_time": "2019-01-01 08:00:00", "Fuse_time": "2019-01-02 09:00:00", "Freturn_time": ""}))
    assert one(got, "k_fid", "fop_type", "k_fopt_time", "k_year_week_day", "k_hours") == ("2", 3, "2019-01-02 09:00:00", "2019-W01-3", "09")


def test_members_and_points_share_a_table(spark, frame):
    region = frame("fprovincesysno fcitysysno fdistrictsysno fprovincename fcityname fdistrictname", ("1", "2", "3", "P", "C", "D"))
    schema = jobs.target_schema(jobs.MemberJob.keys, [*jobs.MemberJob.texts, *jobs.ScoreJob.texts])
    table = KeyedTable(spark, work_path(spark, "members"), schema, jobs.MemberJob.keys, partial=True, buckets=2)
    member, score = jobs.MemberJob(table, region), jobs.ScoreJob(table)
    member.as_of = "2019-03-01"
    texts = [
        changes("t_user_buyer", {"FtenancyId": "7", "Fuid": "1", "Fregion": "1_2_3", "Fbirthday": "1990-05-06", "Fproperty": "20", "Faddtime": "2018-01-01 00:00:00"}),
        changes("t_score_new", {"fTenancyId": "7", "fUid": "1", "fAccountType": "2", "fAccountPoints": "5"}, {"fTenancyId": "7", "fUid": "1", "fAccountType": "3", "fAccountPoints": "9"}),
        changes("t_score_new", {"fTenancyId": "7", "fUid": "1", "fAccountType": "4", "fAccountPoints": "6"}, {"fTenancyId": "7", "fUid": "1", "fAccountType": "2", "fAccountPoints": "8"}),
    ]
    df = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(texts)], MESSAGE_SCHEMA)
    run_feeds([member, score], df, 0)
    got = one(table.read(), "fprovincename", "fdistrictname", "fbirthday_next", "fproperty_str", "fbindweichat", "faddtime", "faccountpoints", "fmlevelvalue")
    assert got == ("P", "D", "2019-05-06", "10100", "1", "2018-01-01 00:00:00", "8", "6")


def test_typed_member(run, at, frame):
    dims = {
        "region": frame("fprovincesysno fcitysysno fdistrictsysno fprovincename fcityname fdistrictname", ("1", "2", "3", "P", "C", "D")),
        "name": frame("k_ftenancy_id code name", ("7", "a", "Ann"), ("7", "b", "Bob"), ("8", "a", "Other")),
        "store": frame("k_ftenancy_id storecode storename", ("7", "s", "Shop")),
        "source": frame("k_ftenancy_id fmembersource fmembersource_name", ("7", "4", "Web")),
    }
    job = at(jobs.TypedMemberJob, dims)
    got = run(job, changes("t_user_buyer", {
        "FtenancyId": "7", "Fuid": "1", "Fmid": "x", "Frating": "3", "Fsex": "", "FrelationWithBaby": "2", "Freferrer": "a", "Fmanager": "b", "Fcreator": "zz",
        "FcreatorDepartment": "s", "FmemberSource": "4", "FregisterSource": "99", "Fproperty": "3", "Fstatus": "bad", "Fregion": "9_9_9", "Fbirthday": "short"}))
    names = ["fmid", "frating", "fsex", "fsex_name", "frelationwithbaby_name", "freferrer_name", "fmanager_name", "fcreator_name", "fcreatordepartment_name",
             "fmembersource_name", "fregistersource_name", "fproperty_str", "fbindweichat", "fstatus", "fmemberlevel", "fprovincename", "fbirthday_next"]
    assert one(got, *names) == (None, 3, "0", None, "母亲", "Ann", "Bob", None, "Shop", "Web", "其他", "11", None, None, 0, None, "")


def test_levels_are_dry_unless_asked(run, at):
    text = changes("t_level_config", {"fTenancyId": "7", "fLevelId": "1", "fLevelName": "gold", "fLevelGrowthFloor": "10"})
    job = at(jobs.LevelJob)
    assert run(job, text).count() == 0
    job.store = True
    assert one(run(job, text), "k_ftenancy_id", "flevelid", "flevelname", "flevelgrowthfloor") == ("7", "1", "gold", "10")
    source = at(jobs.SourceJob)
    source.store = True
    text = changes("t_user_source", {"fTenancyId": "7", "fMemberSource": "4", "fMemberSourceName": "Web", "fSourceStatus": "1"})
    assert one(run(source, text), "fmembersource", "fmembersource_name", "fsourcestatus") == ("4", "Web", "1")


def envelope(kind, *rows):
    return json.dumps([{"content": {"type": kind, "platformNum": "7", "data": list(rows)}}])


def test_batch_envelopes(run, at):
    line = {"orderNo": "1", "orderInId": "2", "skuNo": "3", "saleTime": "2019-01-05 08:00:00", "dealPrice": "9", "fuid": "u"}
    texts = [
        envelope(3, line, {**line, "orderNo": "old", "saleTime": "2018-10-31 23:00:00"}, {**line, "skuNo": ""}),
        envelope(3, {**line, "dealPrice": "10"}), envelope(2, {"skuNo": "3", "skuName": "S"}), envelope(5, {"storeCode": "4", "storeName": "T"}),
    ]
    order = at(jobs.OrderLineJob)
    order.as_of = "2019-01-20"
    assert one(run(order, *texts), "k_ftenancy_id", "orderno", "dealprice", "k_year_week", "k_fid") == ("7", "1", "10", "2019-W01", "u")
    every = at(jobs.OrderLineJob)
    every.retained = False
    assert run(every, *texts).count() == 2
    assert one(run(at(jobs.SkuJob), *texts), "k_ftenancy_id", "skuno", "skuname") == ("7", "3", "S")
    assert one(run(at(jobs.StoreJob), *texts), "storecode", "storename") == ("4", "T")


CONFIG = {"appName": "ev", "topic": "t#3#7", "configs": [
    {"eventId": "buy", "condition": "kind_=_buy", "mappping": [
        {"target": "_ftenancy_id", "source": "tenant", "defaultvalue": ""}, {"target": "_fopt_time", "source": "time", "defaultvalue": ""},
        {"target": "id", "source": "id", "defaultvalue": ""}, {"target": "amount", "source": "amount", "defaultvalue": ""}]},
    {"eventId": "any", "mappping": [
        {"target": "_ftenancy_id", "source": "tenant", "defaultvalue": ""}, {"target": "_fopt_time", "source": "time", "defaultvalue": ""},
        {"target": "id", "source": "id", "defaultvalue": ""}]}]}
EVENTS = schema_of([("id", "string", False), ("_event_id", "string", False), ("_ftenancy_id", "string", False), ("amount", "int32"), ("_dt", "string")])


@pytest.mark.parametrize("topic", ["t#3#7", "t"])
def test_configured(spark, run, topic):
    table = KeyedTable(spark, work_path(spark, "ev"), EVENTS, ["id", "_event_id"], buckets=2)
    row = {"kind": "buy", "time": "2019-01-05 08:00:00", "id": "1", "amount": "3"}
    if "#" in topic:
        texts = [envelope(3, row, {**row, "id": "2", "kind": "x"}, {**row, "id": ""}), envelope(2, row), envelope(3, {**row, "amount": "4"})]
    else:
        texts = [json.dumps([{"tenant": "7", "content": r} for r in (row, {**row, "id": "2", "kind": "x"}, {**row, "id": ""})]), json.dumps({"tenant": "7", "content": {**row, "amount": "4"}})]
    got = run(jobs.ConfiguredJob(table, {**CONFIG, "topic": topic}), *texts)
    assert sorted(values(got.select("id", "_event_id", "_ftenancy_id", "amount", "_dt"))) == [
        ("1", "any", "7", None, "2019-01-05"), ("1", "buy", "7", 4, "2019-01-05"), ("2", "any", "7", None, "2019-01-05")]


def test_dimension_with_cache(spark, run, at):
    cache = jobs.DimensionJob.cache_at(spark, work_path(spark, "cache"), buckets=2)
    store = at(jobs.StoreJob)
    job = jobs.DimensionJob(store, cache, "store_dim", "storecode", "storename", now=F.lit("2019-01-01").cast("timestamp"))
    run(job, envelope(5, {"storeCode": "4", "storeName": "T"}, {"storeCode": "5", "storeName": "U"}, {"storeCode": "", "storeName": "none"}))
    run(job, envelope(5, {"storeCode": "4", "storeName": "V"}), batch_id=1)
    got = cache.read().select("kv_table", "tenant", "key", "value", F.date_format("expires_at", "yyyy-MM-dd"))
    assert sorted(values(got)) == [("store_dim", "7", "4", "V", "2019-01-31"), ("store_dim", "7", "5", "U", "2019-01-31")]


def test_rate_cap():
    assert rate_cap(partitions=3) == {"maxOffsetsPerTrigger": "360"}
