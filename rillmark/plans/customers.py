"""Mappings of customer entities: child, member, level, source, points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import coerce
from ..functions.labels import REGISTER_SOURCE_LABELS, REGISTER_SOURCE_OTHER, RELATION_LABELS, SEX_LABELS
from ..functions.person import age_months, age_stage, next_birthday
from ..functions.text import bit_flag, bit_string, blank, clean_text, decode_label, default_if_empty, keyed_list_lookup
from ..operators.enrich import enrich_name, enrich_region, enrich_source, enrich_store
from .common import carried, cleaned, etl_date, plain, source_columns

# Child fields kept under their lower-case names.
BABY_FIELDS = [
    "Ftruename", "Fnickname", "Flastupdatetime", "Fphoto", "Fbirthday",
    "Faddtime", "Fsex", "Fstatus", "Fproperty",
]

# Member text fields kept under their lower-case names.
MEMBER_FIELDS = [
    "Fmid", "Fmobile", "Femail", "Fphoto", "Faccount_type", "Flogin_account", "Fusertype",
    "Fproperty", "FdiffSrcRegTime", "Frating", "FbabyIdList", "FrelationWithBaby", "Fnickname",
    "Ftruename", "Fsex", "Fbirthday", "Fcommunity", "Faddress", "Fpostcode", "Flastupdatetime",
    "Freferrer", "FmemberLevel", "FmembercardList", "Frecruiter", "Fmanager", "Fcreator",
    "FcreatorDepartment", "FregisterSource", "FmemberSource", "FdiffChannelActiveTime",
    "FpromoteActive", "FuserLableList", "FuserLableRemarks", "FmobileStatus", "FmemberProperty",
    "FuserPictureLableList", "FpregnantPlan", "FnoteName", "FabcInviter", "Fstatus", "Fregion",
]

# Typed member table. Text fields, optional numbers (absent when
# unreadable or missing) and numbers that are 0 when missing.
MEMBER_TEXT = [
    "Fmobile", "Femail", "Fphoto", "Flogin_account", "FdiffSrcRegTime", "FbabyIdList", "Fnickname",
    "Ftruename", "Fbirthday", "Fregion", "Fcommunity", "Faddress", "Fpostcode", "Flastupdatetime",
    "Freferrer", "FmembercardList", "Frecruiter", "Fmanager", "Fcreator", "FcreatorDepartment",
    "FdiffChannelActiveTime", "FpromoteActive", "FuserLableList", "FuserLableRemarks",
    "FuserPictureLableList", "FpaidMemberLevel", "FnoteName", "FabcInviter",
]
MEMBER_OPTIONAL_NUMBERS = {
    "Fmid": "bigint", "Faccount_type": "int", "Fusertype": "int", "Fproperty": "bigint", "Frating": "bigint",
}
MEMBER_NUMBERS = {
    "FrelationWithBaby": "int", "FmemberLevel": "int", "FregisterSource": "int", "FmemberSource": "int",
    "FmobileStatus": "int", "FmemberProperty": "bigint", "FpregnantPlan": "int", "Fstatus": "int",
}
# Code columns looked up in the name dimension.
MEMBER_NAME_CODES = ["freferrer", "frecruiter", "fmanager", "fcreator", "fpromoteactive"]


def map_baby(df: DataFrame, as_of: str | None = None, loaded: str | None = None) -> DataFrame:
    """Child profile with next birthday, age in months and stage."""
    get = source_columns(df)
    birthday = clean_text(get("Fbirthday"))
    months = age_months(birthday, as_of)
    return df.select(
        clean_text(get("FtenancyId")).alias("k_ftenancy_id"),
        clean_text(get("Fmid")).alias("k_fid"),
        clean_text(get("Fbid")).alias("k_fbid"),
        *cleaned(get, BABY_FIELDS),
        birthday.alias("fexp_date_baby"),
        next_birthday(birthday, as_of).alias("fnext_birthday"),
        months.alias("fbaby_age"),
        age_stage(months).alias("fbabyagestage"),
        etl_date(loaded).alias("etl_date"),
        *carried(df),
    )


def map_member(df: DataFrame, region: DataFrame, as_of: str | None = None, tz: str = "UTC", loaded: str | None = None) -> DataFrame:
    """Member profile, all columns text, with region names."""
    get = source_columns(df)
    mapped = df.select(
        clean_text(get("FtenancyId")).alias("k_ftenancy_id"),
        clean_text(get("Fuid")).alias("k_fid"),
        *cleaned(get, MEMBER_FIELDS),
        keyed_list_lookup(get("FdiffSrcRegTime"), get("FregisterSource"), get("Faddtime"), tz, bad="").alias("faddtime"),
        next_birthday(get("Fbirthday"), as_of, short="").alias("fbirthday_next"),
        bit_string(get("Fproperty")).alias("fproperty_str"),
        bit_flag(get("Fproperty"), 5).alias("fbindweichat"),
        etl_date(loaded).alias("etl_date"),
        *carried(df),
    )
    return enrich_region(mapped, region)


def _number_or_zero(c, data_type: str):
    """0 for a missing value, absent for one that is no number."""
    return F.when(blank(c), F.lit(0).cast(data_type)).otherwise(coerce(c, data_type, "skip"))


def map_member_typed(df: DataFrame, dims: dict[str, DataFrame], as_of: str | None = None, tz: str = "UTC", loaded: str | None = None) -> DataFrame:
    """Member profile with typed columns, labels and dimension names.

    ``dims`` holds the frames ``region``, ``name``, ``store`` and ``source``.
    """
    get = source_columns(df)
    relation, source = get("FrelationWithBaby"), get("FregisterSource")
    source_label = decode_label(
        F.when(blank(source), "0").otherwise(source), REGISTER_SOURCE_LABELS, REGISTER_SOURCE_OTHER
    )
    mapped = df.select(
        get("FtenancyId").alias("k_ftenancy_id"),
        get("Fuid").alias("k_fid"),
        *plain(get, MEMBER_TEXT),
        *[coerce(get(n), t, "skip").alias(n.lower()) for n, t in MEMBER_OPTIONAL_NUMBERS.items()],
        *[_number_or_zero(get(n), t).alias(n.lower()) for n, t in MEMBER_NUMBERS.items()],
        decode_label(relation, RELATION_LABELS, "").alias("frelationwithbaby_name"),
        default_if_empty(get("Fsex"), "0").alias("fsex"),
        decode_label(get("Fsex"), SEX_LABELS, "").alias("fsex_name"),
        source_label.alias("fregistersource_name"),
        keyed_list_lookup(get("FdiffSrcRegTime"), source, get("Faddtime"), tz).alias("faddtime"),
        next_birthday(get("Fbirthday"), as_of, short="").alias("fbirthday_next"),
        bit_string(get("Fproperty")).alias("fproperty_str"),
        bit_flag(get("Fproperty"), 5, absent=None).cast("int").alias("fbindweichat"),
        get("FmemberSource").alias("_source_code"),
        etl_date(loaded).alias("etl_date"),
        *carried(df),
    )
    mapped = enrich_region(mapped, dims["region"])
    mapped = enrich_name(mapped, dims["name"], {c: f"{c}_name" for c in MEMBER_NAME_CODES})
    mapped = enrich_store(mapped, dims["store"], "fcreatordepartment", "fcreatordepartment_name")
    mapped = enrich_source(mapped, dims["source"], "_source_code", "fmembersource_name")
    return mapped.drop("_source_code")


def map_level(df: DataFrame, loaded: str | None = None) -> DataFrame:
    """Member level."""
    get = source_columns(df)
    return df.select(
        clean_text(get("fTenancyId")).alias("k_ftenancy_id"),
        *cleaned(get, ["fLevelId", "fLevelName", "fLevelGrowthFloor"]),
        etl_date(loaded).alias("etl_date"),
        *carried(df),
    )


def map_source(df: DataFrame, loaded: str | None = None) -> DataFrame:
    """Member source."""
    get = source_columns(df)
    return df.select(
        clean_text(get("fTenancyId")).alias("k_ftenancy_id"),
        clean_text(get("fMemberSource")).alias("fmembersource"),
        clean_text(get("fMemberSourceName")).alias("fmembersource_name"),
        clean_text(get("fSourceStatus")).alias("fsourcestatus"),
        etl_date(loaded).alias("etl_date"),
        *carried(df),
    )


def map_score(df: DataFrame, loaded: str | None = None) -> DataFrame:
    """Points (account 2) or level value (account 4); the other column stays absent."""
    get = source_columns(df)
    account, points = get("fAccountType").try_cast("int"), clean_text(get("fAccountPoints"))
    return df.select(
        clean_text(get("fTenancyId")).alias("k_ftenancy_id"),
        clean_text(get("fUid")).alias("k_fid"),
        F.when(account == 2, points).alias("faccountpoints"),
        F.when(account == 4, points).alias("fmlevelvalue"),
        etl_date(loaded).alias("etl_date"),
        *carried(df),
    )
