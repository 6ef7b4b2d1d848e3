"""Ready jobs of the entities: which records they take, their mapping and their target.

A job is built with ``at(spark, path)``, which also makes its target table,
and run with ``run_job`` or ``run_batch`` of ``jobs``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import all_present, filter_envelope, table_matches
from ..plans import commerce, customers
from ..plans.configured import map_events, required_sources, source_fields, tenant_field
from ..sinks.keyed_table import KeyedTable
from ..sinks.stores import KV_SCHEMA, dry_run, kv_rows
from ..sources.decode import decode_batches, decode_content, fields, undecodable_batches, undecodable_content
from .jobs import ARRIVAL, EntityJob

CALENDAR = ["k_dt", "k_year", "k_year_quarter", "k_year_month", "k_year_week", "k_y_m_tenofmonth", "k_hours", "k_year_week_day"]


def target_schema(keys: list[str], texts: list[str], numbers: Mapping[str, str] = {}) -> T.StructType:
    """Required key columns, text columns and numbers, plus the load time."""
    fields_ = [T.StructField(k, T.StringType(), False) for k in keys]
    fields_ += [T.StructField(n.lower(), T.StringType()) for n in texts if n.lower() not in keys and n.lower() not in numbers]
    ddl = ", ".join(f"{n.lower()} {t}" for n, t in numbers.items())
    fields_ += T.StructType.fromDDL(ddl).fields if ddl else []
    return T.StructType([*fields_, T.StructField("etl_date", T.StringType())])


class StoredJob(EntityJob):
    """A job whose target follows from its columns.

    ``partial`` targets keep the stored value of an absent column.
    """

    keys: list[str] = []
    texts: list[str] = []
    numbers: dict[str, str] = {}
    partial = True
    loaded: str | None = None

    @classmethod
    def target_at(cls, spark: SparkSession, path: str, **options) -> KeyedTable:
        schema = target_schema(cls.keys, cls.texts, cls.numbers)
        return KeyedTable(spark, path, schema, cls.keys, partial=cls.partial, **options)

    @classmethod
    def at(cls, spark: SparkSession, path: str, **options):
        return cls(cls.target_at(spark, path, **options))


class BabyJob(StoredJob):
    app, table = "baby", "t_user_baby"
    keys = ["k_ftenancy_id", "k_fid", "k_fbid"]
    names = ["FtenancyId", "Fmid", "Fbid", *customers.BABY_FIELDS]
    texts = [*customers.BABY_FIELDS, "fexp_date_baby", "fnext_birthday", "fbabyagestage"]
    numbers = {"fbaby_age": "int"}
    as_of: str | None = None

    def map(self, records):
        return customers.map_baby(records, self.as_of, self.loaded)


class CouponJob(StoredJob):
    app, table = "coupon", "t_user_coupon"
    # One row per coupon and actor: the operation is part of what is stored.
    keys = ["k_ftenancy_id", "k_fid", "fcoupon_code"]
    names = ["Fuser_id", *commerce.COUPON_FIELDS]
    texts = ["k_fopt_time", *CALENDAR, *commerce.COUPON_FIELDS]
    numbers = {"fop_type": "int"}

    def map(self, records):
        return commerce.map_coupon(records, self.loaded)


class ScoreJob(StoredJob):
    """Points and level values of members; other accounts are not taken."""

    app, table = "score", "t_score_new"
    keys = ["k_ftenancy_id", "k_fid"]
    names = ["fTenancyId", "fUid", "fAccountType", "fAccountPoints"]
    texts = ["faccountpoints", "fmlevelvalue"]

    def validate(self, records):
        return F.col("fAccountType").isin("2", "4") & table_matches(self.table)

    def map(self, records):
        return customers.map_score(records, self.loaded)


class MemberJob(StoredJob):
    app, table = "member", "t_user_buyer"
    keys = ["k_ftenancy_id", "k_fid"]
    names = ["FtenancyId", "Fuid", "Faddtime", *customers.MEMBER_FIELDS]
    texts = [*customers.MEMBER_FIELDS, "faddtime", "fbirthday_next", "fproperty_str", "fbindweichat", "fprovincename", "fcityname", "fdistrictname"]
    as_of: str | None = None
    tz = "UTC"

    def __init__(self, target: KeyedTable, region: DataFrame):
        super().__init__(target)
        self.region = region

    @classmethod
    def at(cls, spark, path, region: DataFrame, **options):
        return cls(cls.target_at(spark, path, **options), region)

    def map(self, records):
        return customers.map_member(records, self.region, self.as_of, self.tz, self.loaded)


class TypedMemberJob(StoredJob):
    """Members with typed columns and names from the dimensions."""

    app, table = "member_typed", "t_user_buyer"
    keys = ["k_ftenancy_id", "k_fid"]
    names = list(dict.fromkeys([
        "FtenancyId", "Fuid", "Fsex", "Faddtime", *customers.MEMBER_TEXT, *customers.MEMBER_OPTIONAL_NUMBERS, *customers.MEMBER_NUMBERS,
    ]))
    texts = [
        *customers.MEMBER_TEXT, "frelationwithbaby_name", "fsex", "fsex_name", "fregistersource_name", "faddtime", "fbirthday_next",
        "fproperty_str", "fprovincename", "fcityname", "fdistrictname", *[f"{c}_name" for c in customers.MEMBER_NAME_CODES],
        "fcreatordepartment_name", "fmembersource_name",
    ]
    numbers = {**customers.MEMBER_OPTIONAL_NUMBERS, **customers.MEMBER_NUMBERS, "fbindweichat": "int"}
    numbers = {n.lower(): t for n, t in numbers.items()}
    as_of: str | None = None
    tz = "UTC"

    def __init__(self, target: KeyedTable, dims: dict[str, DataFrame]):
        super().__init__(target)
        self.dims = dims

    @classmethod
    def at(cls, spark, path, dims: dict[str, DataFrame], **options):
        return cls(cls.target_at(spark, path, **options), dims)

    def map(self, records):
        return customers.map_member_typed(records, self.dims, self.as_of, self.tz, self.loaded)


class LevelJob(StoredJob):
    """Member levels. ``store=False`` runs everything but the write."""

    app, table = "level", "t_level_config"
    keys = ["k_ftenancy_id", "flevelid"]
    names = ["fTenancyId", "fLevelId", "fLevelName", "fLevelGrowthFloor"]
    texts = ["flevelname", "flevelgrowthfloor"]
    store = False

    def map(self, records):
        return customers.map_level(records, self.loaded)

    def save(self, rows, batch_id):
        if self.store:
            super().save(rows, batch_id)
        else:
            dry_run(rows)


class SourceJob(LevelJob):
    """Member sources."""

    app, table = "source", "t_user_source"
    keys = ["k_ftenancy_id", "fmembersource"]
    names = ["fTenancyId", "fMemberSource", "fMemberSourceName", "fSourceStatus"]
    texts = ["fmembersource_name", "fsourcestatus"]

    def map(self, records):
        return customers.map_source(records, self.loaded)


class BatchEnvelopeJob(StoredJob):
    """Rows of one type of batch envelope, stored whole."""

    type_number = 0
    partial = False

    def parse(self, messages):
        return fields(decode_batches(messages, only_type=self.type_number), ["cal_platformNum", *self.names])

    def validate(self, records):
        return F.lit(True)


class OrderLineJob(BatchEnvelopeJob):
    """Order lines since the retention floor; ``retained = False`` takes all with a readable time."""

    app, type_number = "order_line", 3
    keys = ["k_ftenancy_id", "orderno", "orderinid", "skuno"]
    names = ["fuid", *commerce.ORDER_LINE_FIELDS]
    texts = ["k_fid", "k_fopt_time", *CALENDAR, *commerce.ORDER_LINE_FIELDS]
    as_of: str | None = None
    retained = True

    def map(self, records):
        return commerce.map_order_line(records, self.as_of, self.retained, self.loaded)


class SkuJob(BatchEnvelopeJob):
    app, type_number = "sku", 2
    keys = ["k_ftenancy_id", "skuno"]
    names = texts = commerce.SKU_FIELDS

    def map(self, records):
        return commerce.map_sku(records, self.loaded)


class StoreJob(BatchEnvelopeJob):
    app, type_number = "store", 5
    keys = ["k_ftenancy_id", "storecode"]
    names = texts = commerce.STORE_FIELDS

    def map(self, records):
        return commerce.map_store(records, self.loaded)


class DimensionJob(EntityJob):
    """A dimension table kept beside a cache of one of its columns by tenant and key.

    ``entity`` does the rest: any other job over the same messages.
    """

    def __init__(self, entity: EntityJob, cache: KeyedTable, name: str, key: str, value: str, tenant: str = "k_ftenancy_id", now: Column | None = None):
        super().__init__(entity.target)
        self.entity, self.cache, self.dim = entity, cache, name
        self.key, self.value, self.tenant, self.now = key, value, tenant, now
        self.app, self.table, self.names = entity.app, entity.table, entity.names

    @staticmethod
    def cache_at(spark: SparkSession, path: str, **options) -> KeyedTable:
        return KeyedTable(spark, path, KV_SCHEMA, ["kv_table", "tenant", "key"], **options)

    def parse(self, messages):
        return self.entity.parse(messages)

    def validate(self, records):
        return self.entity.validate(records)

    def map(self, records):
        return self.entity.map(records)

    def save(self, rows, batch_id):
        self.entity.save(rows, batch_id)
        # What was stored by this batch, one row per key, with its place: of
        # rows that share a cache entry the one that came last is kept.
        arrival = [c for c in ARRIVAL if c in rows.columns]
        last = rows.groupBy(*self.target.keys).agg(F.max(F.struct(*arrival)).alias("_at"))
        stored = self.target.read(rows).join(last, self.target.keys)
        entries = kv_rows(stored, self.dim, self.key, self.value, self.tenant, self.now, carry=["_at"])
        self.cache.write_batch(entries, batch_id, order=["_at"], feed=self.feed)


class ConfiguredJob(EntityJob):
    """Events mapped by a configuration.

    The configuration's topic may be ``topic#type#platform``: then messages
    are batch envelopes of that type and platform, else content envelopes.
    """

    def __init__(self, target: KeyedTable, config: Mapping, policy: str = "error"):
        super().__init__(target)
        self.config, self.policy, self.app = config, policy, config["appName"]
        self.spec = config["topic"]
        self.tenant = tenant_field(config)

    def parse(self, messages):
        wanted = source_fields(self.config)
        if "#" in self.spec:
            rows = decode_batches(messages, platform_field=self.tenant)
            return filter_envelope(fields(rows, [*wanted, "_cal_type_sel"]), self.spec, platform_col=self.tenant)
        return fields(decode_content(messages, self.tenant), wanted)

    def undecodable(self, messages):
        return undecodable_batches(messages) if "#" in self.spec else undecodable_content(messages, self.tenant)

    def validate(self, records):
        return all_present(required_sources(self.config, self.target.schema))

    def map(self, records):
        return map_events(records, self.config, self.target.schema, policy=self.policy)
