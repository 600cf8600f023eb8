"""Company reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions import live
from labwh.operators import (
    add_flags,
    attach_totals,
    conditional_measures,
    count_if,
    in_any,
    latest_values,
    lookup_levels,
    month_shift,
    outer_merge,
    rank_within,
    scaffold,
    split_by_membership,
    with_month_shift,
)
from labwh.plans.common import (
    CITY,
    COUNTY,
    OPEN_SUB_STATUSES,
    PROVINCE,
    RUNNING,
    add_names,
    areas_below,
    open_projects,
    text_shares,
    valid_deposits,
)

# Fixed values.
APPROVED = 3
LOCAL, OUTSIDE = 1, 2
COMPANY_TYPE_DICTIONARY = "companytype"
TYPE_NAMES = {
    "设计单位": "EPC_count",
    "施工单位": "company_construction_count",
    "劳务企业": "company_labour_count",
    "建设集团": "company_build_count",
}
OLD_TYPE_CODES = {13: "EPC_count", 4: "company_construction_count", 11: "company_labour_count"}
CITY_TYPE_CODES = {
    1: "EPC_count",
    2: "company_construction_count",
    3: "company_labour_count",
    4: "company_build_count",
}
SHARES = {
    "EPC_count": "epc_proportion",
    "company_construction_count": "construction_proportion",
    "company_build_count": "build_proportion",
    "company_labour_count": "labour_proportion",
}


def _locality(flag: str, prefix: str) -> dict[str, tuple[Column, None]]:
    """Local, outside and other companies; an unknown locality counts as other."""
    known = F.coalesce(F.col(flag).isin(LOCAL, OUTSIDE), F.lit(False))
    return {
        f"{prefix}local_count": (F.col(flag) == LOCAL, None),
        f"{prefix}nonlocal_count": (F.col(flag) == OUTSIDE, None),
        f"{prefix}other": (~known, None),
    }


def company_areas_by_name(
    companies: DataFrame, projects: DataFrame, types: DataFrame, areas: DataFrame, as_of: dt.date
) -> DataFrame:
    """Approved company × business area, by names: the areas of its unfinished projects."""
    rows = companies.where(live() & (F.col("status") == APPROVED))
    rows = rows.select(
        "cid", "company_name", "province_code", "city_code", "county_code", "company_type",
        "location", F.year("create_time").alias("year"), F.month("create_time").alias("month"),
        F.day("create_time").alias("day"),
    )
    kinds = types.where(F.col("type") == COMPANY_TYPE_DICTIONARY).withColumnRenamed("name", "type_name")
    rows = add_names(rows, kinds, "company_type", "code", "type_name")
    where = projects.where((F.col("is_completed") == "N") & (F.col("status") == APPROVED))
    where = where.select(
        "cid",
        F.col("province_code").alias("project_province_code"),
        F.col("city_code").alias("project_city_code"),
        F.col("county_code").alias("project_county_code"),
    ).distinct()
    rows = rows.join(where, "cid", "left")
    levels = {"province": PROVINCE, "city": CITY, "county": COUNTY}
    names = {}
    for prefix in ("", "project_"):
        for level, number in levels.items():
            names[f"{prefix}{level}_name"] = (f"{prefix}{level}_code", number)
    rows = lookup_levels(rows, areas, names)
    return rows.select(
        "cid", "company_name", "province_name", "city_name", "county_name",
        F.col("type_name").alias("company_type"), "location", "year", "month", "day",
        "project_province_name", "project_city_name", "project_county_name",
        F.lit(as_of).alias("create_time"),
    )


def company_areas(companies: DataFrame, projects: DataFrame, types: DataFrame) -> DataFrame:
    """Approved company × business area, by codes, with an ordinal per company.

    A company has at most as many rows as there are areas.
    """
    rows = companies.where(live() & (F.col("status") == APPROVED)).select(
        "cid", "company_name", "province_code", "city_code", "county_code", "company_type",
        "create_time", "checked_time", F.year("create_time").alias("year"),
        F.month("create_time").alias("month"), F.day("create_time").alias("day"),
        "register_capital", "is_location", "is_deleted", "status",
    )
    rows = add_names(
        rows, types.withColumnRenamed("name", "company_type_name"), "company_type", "code", "company_type_name"
    )
    running = open_projects(projects).where(F.col("project_condition") == RUNNING)
    where = running.select(
        "cid",
        F.col("province_code").alias("project_province_code"),
        F.col("city_code").alias("project_city_code"),
        F.col("county_code").alias("project_county_code"),
    ).distinct()
    order = [F.col(f"project_{x}_code") for x in ("province", "city", "county")]
    return rank_within(rows.join(where, "cid", "left"), ["cid"], order, "rank")


def company_counts(
    companies: DataFrame,
    areas_by_name: DataFrame,
    areas: DataFrame,
    as_of: dt.date,
    city: str,
    city_name: str,
) -> DataFrame:
    """County: registered companies by type and locality, and companies doing business there,
    with shares."""
    measures = {"xz_companys_sum": (F.col("cid").isNotNull(), None)}
    for code, name in OLD_TYPE_CODES.items():
        measures[name] = (F.col("company_type") == code, None)
    measures.update(
        {
            "company_local_count": (F.col("location") == LOCAL, None),
            "company_nonlocal_count": (F.col("location") == OUTSIDE, None),
            "other": _locality("location", "")["other"],
        }
    )
    counts = conditional_measures(companies.where(live()), ["county_code"], measures)
    shares = {SHARES[n]: n for n in OLD_TYPE_CODES.values()}
    shares.update(
        {
            "local_proportion": "company_local_count",
            "nonlocal_proportion": "company_nonlocal_count",
            "other_proportion": "other",
        }
    )
    counts = text_shares(counts, {o: (p, "xz_companys_sum") for o, p in shares.items()})
    counties = areas_below(areas.where(live()), city)
    registered = scaffold(counties, counts, [("code", "county_code")], fill=None).drop("code")
    registered = registered.withColumn("create_time", F.lit(as_of))

    here = areas_by_name.where(
        (F.col("project_city_name") == city_name) & F.col("project_county_name").isNotNull()
    )
    local = _locality("location", "")
    business = conditional_measures(
        here.withColumnRenamed("project_county_name", "name"),
        ["name"],
        {
            "yw_companys_sum": (F.col("cid").isNotNull(), None),
            "yw_company_local_count": local["local_count"],
            "yw_company_nonlocal_count": local["nonlocal_count"],
            "yw_other": local["other"],
        },
    )
    business = text_shares(
        business,
        {
            "yw_local_proportion": ("yw_company_local_count", "yw_companys_sum"),
            "yw_nonlocal_proportion": ("yw_company_nonlocal_count", "yw_companys_sum"),
            "yw_other_proportion": ("yw_other", "yw_companys_sum"),
        },
    )
    return registered.join(business, ["name"], "left")


DAY_COUNTS = (
    "xz_companys_sum", *TYPE_NAMES.values(), "xz_local_count", "xz_nonlocal_count", "xz_other",
    "yw_companys_sum", "yw_local_count", "yw_nonlocal_count", "yw_other",
)


def _day_shares(df: DataFrame, types: list[str]) -> DataFrame:
    parts = {SHARES[t]: (t, "xz_companys_sum") for t in types}
    for side in ("xz", "yw"):
        for kind, out in (("local_count", "local"), ("nonlocal_count", "nonlocal"), ("other", "other")):
            parts[f"{side}_{out}_proportion"] = (f"{side}_{kind}", f"{side}_companys_sum")
    return text_shares(df, parts)


def company_days(company_area: DataFrame, areas: DataFrame, city: str) -> DataFrame:
    """County × day: companies registered and companies doing business, by type and locality."""
    by = ["code", "year", "month", "day"]
    own = company_area.where(
        live() & (F.col("status") == APPROVED) & (F.col("rank") == 1) & F.col("county_code").isNotNull()
    )
    measures = {"xz_companys_sum": (F.col("cid").isNotNull(), None)}
    for label, name in TYPE_NAMES.items():
        measures[name] = (F.col("company_type_name") == label, None)
    measures.update(_locality("is_location", "xz_"))
    registered = conditional_measures(own.withColumnRenamed("county_code", "code"), by, measures)
    here = company_area.where(
        F.col("project_county_code").isNotNull() & (F.col("project_city_code") == city)
    )
    business = conditional_measures(
        here.withColumnRenamed("project_county_code", "code"),
        by,
        {"yw_companys_sum": (F.col("cid").isNotNull(), None), **_locality("is_location", "yw_")},
    )
    merged = outer_merge(by, registered, business, fill=None)
    counties = areas_below(areas.where(live()), city).withColumnsRenamed(
        {"code": "county_code", "name": "county_name"}
    )
    rows = scaffold(counties, merged, [("county_code", "code")], fill=None)
    return _day_shares(rows, list(TYPE_NAMES.values()))


def company_totals_from_days(days: DataFrame, as_of: dt.date) -> DataFrame:
    """County totals of the daily report, keyed by county and run date."""
    rows = days.groupBy("county_code", "county_name").agg(
        *[F.sum(c).alias(c) for c in DAY_COUNTS if c != "company_build_count"]
    )
    types = [t for t in TYPE_NAMES.values() if t != "company_build_count"]
    key = F.concat("county_code", F.lit(as_of.strftime("%Y%m%d")))
    return (
        _day_shares(rows, types)
        .withColumns({"pkid": key, "create_time": F.lit(as_of)})
        .orderBy(F.col("county_code").desc())
    )


def company_detail(
    companies: DataFrame,
    deposits: DataFrame,
    batches: DataFrame,
    special_accounts: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Approved company: deposit status (latest valid one), wages of last month, this month and
    the label of the latest month, account flag, number of projects."""
    rows = companies.where(live() & (F.col("status") == APPROVED)).select(
        "cid", "company_name", "county_code", "company_type"
    )
    deposit = latest_values(
        valid_deposits(deposits), ["cid"], {"d": (F.lit(True), ["create_time", "status", "type"])}
    ).select("cid", F.col("d.type").alias("type"), F.col("d.status").alias("safeguard_status"))
    paid = batches.where((F.col("status") == 1) & live())
    wages = month_shift(paid, "cid", "year", "month", "amt", as_of, "amt")
    rows = with_month_shift(rows.join(deposit, "cid", "left"), wages, "cid", "amt")
    account = special_accounts.where((F.col("status") == 1) & live())
    rows = add_flags(rows, "cid", [(account, "cid", {"account_status": F.lit(True)})])
    own = projects.where(live()).select("cid", "pid")
    below = sub_projects.where(live()).select(F.col("unit_cid").alias("cid"), "pid")
    counts = own.union(below).distinct().groupBy("cid").agg(F.count("*").alias("project_count"))
    rows = rows.join(counts, "cid", "left")
    return rows.select(
        "cid",
        "company_name",
        "company_type",
        "county_code",
        "type",
        F.coalesce("safeguard_status", F.lit(1)).alias("safeguard_status"),
        F.col("amt_last_month").alias("last_month_amt"),
        F.col("amt_this_month").alias("this_month_amt"),
        F.col("amt_latest_label").alias("year_month"),
        "account_status",
        F.when(F.col("amt_this_month") > 0, 1).otherwise(0).alias("is_salary"),
        F.coalesce("project_count", F.lit(0)).alias("project_count"),
        F.lit(as_of).alias("create_time"),
    )


def company_project_types(
    companies: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
    areas: DataFrame,
    city: str,
) -> DataFrame:
    """Approved company × project type and area with type rank, kept when the company or the
    project is in the city. Rows per company are bounded by types × areas."""
    rows = companies.where(live() & (F.col("status") == APPROVED)).select("cid", "county_code", "company_type")
    site = [
        "project_type",
        "province_code",
        F.col("city_code").alias("project_city_code"),
        F.col("county_code").alias("project_county_code"),
    ]
    own = open_projects(projects).select("cid", *site)
    below = sub_projects.where(F.col("status").isin(*OPEN_SUB_STATUSES) & live())
    below = below.select(F.col("unit_cid").alias("cid"), *site)
    rows = rows.join(own.union(below).distinct(), "cid", "left")
    order = [
        F.col(c)
        for c in ("project_type", "province_code", "project_city_code", "project_county_code")
    ]
    rows = rank_within(rows, ["cid", "company_type"], order, "type_top").drop("province_code")
    codes = areas_below(areas, city).select("code")
    return in_any(rows, [("project_county_code", codes, "code"), ("county_code", codes, "code")])


def company_totals(
    project_types: DataFrame, areas: DataFrame, as_of: dt.date, city: str
) -> DataFrame:
    """One row: companies by type and locality with shares."""
    first = project_types.where(F.col("type_top") == 1)
    unknown = F.col("county_code").isNull() | (F.col("county_code") == "")
    counts = first.agg(
        F.countDistinct("cid").alias("company_total"),
        *[count_if(F.col("company_type") == k).alias(n) for k, n in CITY_TYPE_CODES.items()],
        count_if(unknown).alias("other_company_count"),
    )
    local = split_by_membership(
        first,
        [],
        "county_code",
        areas_below(areas, city),
        "code",
        "cid",
        {"local": "local_company_total", "outside": "nolocal_company_total"},
    )
    shares = {SHARES[n]: (n, "company_total") for n in CITY_TYPE_CODES.values()}
    shares.update(
        {
            "other_company_proportion": ("other_company_count", "company_total"),
            "local_company_proportion": ("local_company_total", "company_total"),
            "nonlocal_company_proportion": ("nolocal_company_total", "company_total"),
        }
    )
    row = text_shares(attach_totals(counts, local), shares)
    return row.withColumn("create_time", F.lit(as_of))


def company_area_totals(
    project_types: DataFrame, areas: DataFrame, as_of: dt.date, city: str
) -> DataFrame:
    """County: companies registered there and doing business there, their share of the grand
    total, types, and locality of those doing business."""
    counties = areas_below(areas, city)
    first = project_types.where(F.col("type_top") == 1)
    per_company = first.groupBy("county_code", "cid").agg(
        *[count_if(F.col("company_type") == k).alias(n.lower()) for k, n in CITY_TYPE_CODES.items()]
    )
    registered = per_company.groupBy("county_code").agg(
        F.count("cid").alias("xz_company_county_total"),
        *[F.sum(n.lower()).alias(n.lower()) for n in CITY_TYPE_CODES.values()],
    )
    business = split_by_membership(
        project_types,
        ["project_county_code"],
        "county_code",
        counties,
        "code",
        "cid",
        {
            "local": "local_company_total",
            "outside": "nolocal_company_total",
            "unknown": "other_company_total",
        },
    )
    doing = project_types.where(F.col("cid").isNotNull()).select("project_county_code", "cid").distinct()
    doing = doing.groupBy("project_county_code").agg(F.count("*").alias("yw_company_county_total"))
    rows = scaffold(counties, registered, [("code", "county_code")])
    rows = scaffold(rows, doing, [("code", "project_county_code")])
    rows = scaffold(rows, business, [("code", "project_county_code")])
    grand = rows.agg(
        F.sum("xz_company_county_total").alias("xz_company_total"),
        F.sum("yw_company_county_total").alias("yw_company_total"),
    )
    rows = text_shares(
        attach_totals(rows, grand),
        {
            "xz_company_proportion": ("xz_company_county_total", "xz_company_total"),
            "yw_company_proportion": ("yw_company_county_total", "yw_company_total"),
            "yw_local_proportion": ("local_company_total", "yw_company_total"),
            "yw_nolocal_proportion": ("nolocal_company_total", "yw_company_total"),
            "yw_other_proportion": ("other_company_total", "yw_company_total"),
        },
    )
    return rows.withColumn("create_time", F.lit(as_of))
