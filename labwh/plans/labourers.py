"""Worker reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions import MISSING_NAME, live
from labwh.operators import (
    By,
    attach_totals,
    conditional_measures,
    count_if,
    join_ranked,
    keyed_join,
    latest_per_key,
    latest_values,
    lookup_levels,
    numbered_rows,
    scaffold,
)
from labwh.plans.common import COUNTY, UNVERIFIED_GRADE, add_names, date_text, stamp, text_shares
from labwh.sources.staging import staged

# Fixed values.
MALE, FEMALE = "男", "女"
AGE_EDGES = (15, 20, 25, 30, 35, 40, 45, 50)
AGE_NAMES = ("one", "two", "three", "four", "five", "six", "seven", "eight")
JOB_UNKNOWN = 99


def _age(birthday: str, as_of: dt.date) -> Column:
    """Difference of the calendar years."""
    return F.lit(as_of.year) - F.year(birthday)


def _on_job(flag: str) -> Column:
    return F.when(F.col(flag), 1).otherwise(0)


def _arrears(arrears_amounts: DataFrame) -> DataFrame:
    """Arrears per worker."""
    rows = arrears_amounts.where(live()).groupBy("lid").agg(F.sum("real_amt").alias("real_amt"))
    return rows.withColumn("arrears_status", F.lit(1))


def labourer_day(
    labourers: DataFrame, employments: DataFrame, arrears_amounts: DataFrame, as_of: dt.date
) -> DataFrame:
    """Live worker with age, first live job still held, and arrears."""
    held = employments.where(live() & F.col("is_job"))
    job_cols = [
        "job_date", "current_city_code", "current_county_code", "current_county_name",
        "create_time", "worktype_no", "worktype_name", "is_job",
    ]
    first = latest_per_key(
        held.select("lid", *job_cols),
        ["lid"],
        [F.col("create_time").asc_nulls_last(), F.col("job_date"), F.col("current_county_code"), F.col("worktype_no")],
    )
    people = labourers.where(live()).select(
        "lid",
        "gender",
        date_text("birthday", "yyyy-M-d").alias("birthday"),
        _age("birthday", as_of).alias("age"),
        "real_name",
    )
    rows = people.join(first, "lid", "left").join(_arrears(arrears_amounts), "lid", "left")
    return rows.withColumns(
        {"is_job": _on_job("is_job"), "arrears_status": F.coalesce("arrears_status", F.lit(0))}
    )


def labourer_history(
    labourers: DataFrame,
    employments: DataFrame,
    arrears_amounts: DataFrame,
    areas: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Live worker × job with rank, county name and arrears of the worker.

    Jobs are ranked held first, live first, oldest first, unknown times last.
    """
    order = [
        By("is_job", descending=True), By("is_deleted"), By("create_time", nulls_first=False),
        By("job_date"), By("current_county_code"), By("worktype_no"),
    ]
    jobs = employments.select(
        "lid", "job_date", "current_city_code", "current_county_code", "current_county_name",
        "create_time", "worktype_no", "worktype_name", "is_job", "is_deleted",
    )
    jobs = numbered_rows(jobs, "_row", "jobs")
    people = labourers.where(live()).select(
        "lid", "nation_id", "real_name", "id_card_no", "gender",
        date_text("birthday", "yyyy-M-d").alias("birthday"),
        _age("birthday", as_of).alias("age"), "married", "real_grade", "province_code",
        "city_code", "county_code", "culture_level_type", "politics_type", "source_type",
    )
    people = people.join(_arrears(arrears_amounts), "lid", "left")
    rows = join_ranked(people, jobs, ["lid"], order, "top", row="_row")
    rows = lookup_levels(rows, areas, {"area_county_name": ("current_county_code", COUNTY)})
    return rows.withColumns(
        {
            "top": F.coalesce("top", F.lit(1)),
            "is_deleted": F.coalesce("is_deleted", F.lit(1)),
            "is_job": _on_job("is_job"),
            "arrears_status": F.coalesce("arrears_status", F.lit(0)),
        }
    )


def onjob_share(history: DataFrame, areas: DataFrame, city: str) -> DataFrame:
    """County: workers on the job, with and without arrears, beside the city's totals and as
    shares of them. Counties without workers keep NULL."""
    on_job = history.where(
        (F.col("top") == 1)
        & (F.col("is_job") == 1)
        & live()
        & (F.col("current_city_code") == city)
        & (F.col("real_grade") != UNVERIFIED_GRADE)
    )
    owing, clear = F.col("arrears_status") == 1, F.col("arrears_status") == 0
    total = on_job.agg(
        F.count("lid").alias("person_total"),
        count_if(owing).alias("arrears_total"),
        count_if(clear).alias("no_arrears_total"),
    )
    county = conditional_measures(
        on_job,
        ["current_county_code"],
        {
            "county_person_total": (F.col("lid").isNotNull(), None),
            "county_arrears_total": (owing, None),
            "county_no_arrears_total": (clear, None),
        },
    )
    rows = text_shares(
        attach_totals(county, total),
        {
            "person_proportion": ("county_person_total", "person_total"),
            "arrears_proportion": ("county_arrears_total", "arrears_total"),
            "no_arrears_proportion": ("county_no_arrears_total", "no_arrears_total"),
        },
    )
    counties = areas.where((F.col("parent_code") == city) & (F.col("level") == COUNTY))
    counties = counties.select("code", F.col("name").alias("county_name"))
    return scaffold(counties, rows, [("code", "current_county_code")], fill=None)


def onjob_totals(
    labourers: DataFrame,
    employments: DataFrame,
    arrears_cases: DataFrame,
    arrears_amounts: DataFrame,
    areas: DataFrame,
    city: str,
) -> DataFrame:
    """County: all verified workers, workers on the job by their latest record, arrears cases
    in all and in the county."""
    people = labourers.where((F.col("real_grade") != UNVERIFIED_GRADE) & live())
    latest = latest_per_key(
        employments.where(live() & F.col("is_job") & (F.col("current_city_code") == city)),
        ["lid"],
        [F.col("create_time").desc_nulls_last(), F.col("current_county_code").desc(), F.col("job_date").desc()],
    )
    on_job = latest.groupBy("current_county_code").agg(F.count("*").alias("onjob_labourer_total"))
    cases = arrears_cases.where((F.col("status") == 3) & live() & (F.col("pid") != 0))
    cases = cases.select(F.col("id").alias("arrears_salary_id"), "city_code", "county_code")
    owed = arrears_amounts.where(live()).select("lid", "arrears_salary_id", "pid").distinct()
    by_county = (
        cases.join(owed, "arrears_salary_id")
        .groupBy("city_code", "county_code")
        .agg(F.count("*").alias("arrears_total"))
    )
    ours = by_county.where(F.col("city_code") == city).select(
        "county_code", F.col("arrears_total").alias("county_arrears_total")
    )
    counties = areas.where((F.col("parent_code") == city) & (F.col("level") == COUNTY))
    rows = counties.select("code", F.col("name").alias("county_name"))
    rows = keyed_join(rows, on_job, [("code", "current_county_code")])
    rows = keyed_join(rows, ours, [("code", "county_code")])
    return attach_totals(
        rows,
        people.agg(F.count("*").alias("labourer_total")),
        by_county.agg(F.sum("arrears_total").alias("arrears_total")),
    ).drop("code")


def labourer_totals(history: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: workers, on and off the job, by gender and by age band."""
    rows = history.where((F.col("top") == 1) & (F.col("real_grade") != UNVERIFIED_GRADE))
    age = F.col("age")
    bands = []
    for i, (lo, name) in enumerate(zip(AGE_EDGES, AGE_NAMES)):
        inside = age >= lo
        if i + 1 < len(AGE_EDGES):
            inside = inside & (age < AGE_EDGES[i + 1])
        bands.append(count_if(inside).alias(f"age_dist_{name}"))
    return rows.agg(
        F.count("lid").alias("labourer_total"),
        count_if((F.col("is_job") == 1) & live()).alias("is_job_total"),
        count_if((F.col("is_job") == 0) | (F.col("is_deleted") == 2)).alias("no_job_total"),
        count_if(F.col("gender") == MALE).alias("man_total"),
        count_if(F.col("gender") == FEMALE).alias("woman_total"),
        *bands,
    ).withColumn("create_time", F.lit(as_of))


def arrears_detail(
    arrears_cases: DataFrame, arrears_amounts: DataFrame, projects: DataFrame, as_of: dt.date
) -> DataFrame:
    """Arrears case × worker with the project of the case and the amount owed."""
    site = projects.where(live()).select(
        "pid", "province_code", "city_code", "county_code", "project_name", "project_type"
    )
    cases = arrears_cases.where(F.col("status").isin(3, 4) & live() & (F.col("pid") != 0))
    cases = cases.select(F.col("id").alias("arrears_salary_id"), "pid").join(site, "pid")
    owed = (
        arrears_amounts.where(live())
        .groupBy("lid", "real_name", "arrears_salary_id", F.col("pid").alias("_pid"))
        .agg(F.sum("real_amt").alias("real_amt"))
        .drop("_pid")
    )
    return cases.join(owed, "arrears_salary_id").select(
        "province_code", "city_code", "county_code", "project_name", "pid", "project_type", "lid",
        "real_name", "real_amt", F.lit(as_of).alias("create_time"),
    )


def resume_detail(
    labourers: DataFrame,
    employments: DataFrame,
    projects: DataFrame,
    companies: DataFrame,
    blacklist: DataFrame,
    labourer_banks: DataFrame,
    employment_intervals: DataFrame,
    areas: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Verified worker × job with rank, latest blacklist grade, latest bank card and number of
    projects. ``is_job``: 1 held, 0 left, 99 no job."""
    site = projects.where(live()).select(
        "pid",
        "project_name",
        F.col("province_code").alias("project_province_code"),
        F.col("city_code").alias("project_city_code"),
        F.col("county_code").alias("project_county_code"),
        "project_type",
    )
    jobs = employments.where(live()).select(
        "lid", F.col("source_pid").alias("pid"), "current_cid", "job_date", "job_end_date",
        "worktype_no", "worktype_name", "is_job",
    )
    # The site is the wider of the two, so it joins last.
    jobs = add_names(jobs, companies, "current_cid", "cid", "company_name").join(site, "pid")
    jobs = jobs.select("pid", *[c for c in jobs.columns if c not in ("pid", "company_name")], "company_name")
    order = [
        By("is_job", descending=True), By("job_date", descending=True), By("pid"), By("worktype_no"),
        By("current_cid"), By("job_end_date"),
    ]
    jobs = numbered_rows(jobs, "_row", "jobs")

    bad = latest_values(
        blacklist.where(live()), ["lid"], {"bad": (F.lit(True), ["create_time", "bad_grade"])}
    ).select("lid", F.col("bad.bad_grade").alias("bad_grade"))
    card = latest_values(
        labourer_banks.where(live()),
        ["id_card_no"],
        {"card": (F.lit(True), ["create_time", "bank_no", "bank_name"])},
    ).select("id_card_no", F.col("card.bank_no").alias("bank_no"), F.col("card.bank_name").alias("bank_name"))
    worked = employment_intervals.where(live() & F.col("source_pid").isNotNull())
    worked = worked.select("lid", "source_pid").distinct()
    worked = worked.groupBy("lid").agg(F.count("*").alias("project_count"))

    people = labourers.where(live() & (F.col("real_grade") != UNVERIFIED_GRADE)).select(
        "lid", "nation_id", "real_name", "id_card_no", "gender",
        date_text("birthday", "yyyy-M-d").alias("birthday"),
        _age("birthday", as_of).alias("age"), "married", "mobilephone", "real_grade",
        "province_code", "city_code", "county_code", "culture_level_type", "politics_type",
        "source_type", "nativeplace_id",
    )
    people = people.join(bad, "lid", "left").join(worked, "lid", "left")
    # Stored, as the shuffles behind it take more disk than the few columns left of them.
    people = staged(people.join(card, "id_card_no", "left"), "people")
    rows = join_ranked(people, jobs, ["lid"], order, "lab_top", row="_row").drop("current_cid")
    rows = lookup_levels(rows, areas, {"project_county_name": ("project_county_code", COUNTY)})
    is_job = F.when(F.col("is_job").isNull(), JOB_UNKNOWN).when(F.col("is_job"), 1).otherwise(0)
    return rows.withColumns(
        {
            "lab_top": F.coalesce("lab_top", F.lit(1)),
            "is_job": is_job,
            "bad_grade": F.coalesce("bad_grade", F.lit(0)),
            "project_count": F.coalesce("project_count", F.lit(0)),
        }
    )


def onjob_by_type(resumes: DataFrame) -> DataFrame:
    """County × project type: workers whose latest job is held."""
    rows = resumes.where((F.col("lab_top") == 1) & (F.col("is_job") == 1))
    return rows.groupBy("project_county_code", "project_county_name", "project_type").agg(
        F.count("*").alias("labourer_count")
    )


def current_labourers(
    projects: DataFrame,
    employments: DataFrame,
    labourers: DataFrame,
    blacklist: DataFrame,
    companies: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Worker at the latest live job: project areas, company, blacklist flag."""
    latest = latest_per_key(
        employments.select(
            "lid", "real_name", "id_card_no", "source_pid", "source_project_name", "current_cid",
            "worktype_no", "worktype_name", "is_job", "is_deleted", "job_date",
        ),
        ["lid"],
        [F.col("is_deleted").asc(), F.col("job_date").desc_nulls_last(), F.col("source_pid"),
         F.col("worktype_no"), F.col("current_cid")],
    )
    person = labourers.groupBy("lid").agg(
        F.min("real_name").alias("_name"),
        F.min("id_card_no").alias("_card"),
        F.min("mobilephone").alias("mobilephone"),
    )
    flagged = blacklist.where(live()).select("lid").distinct().withColumn("bad_status", F.lit(True))
    rows = latest.drop("is_deleted", "job_date")
    rows = rows.join(person, "lid", "left").join(flagged, "lid", "left")
    rows = add_names(rows, companies, "current_cid", "cid", "company_name")
    site = projects.where(live()).select(
        F.col("pid").alias("source_pid"), "province_code", "city_code", "county_code",
        "project_type", "industry_type",
    )
    rows = rows.join(site, "source_pid")
    return rows.select(
        F.col("lid").alias("id"),
        "industry_type",
        "project_type",
        "province_code",
        "city_code",
        "county_code",
        "lid",
        F.coalesce("real_name", "_name").alias("real_name"),
        F.coalesce("id_card_no", "_card").alias("id_card_no"),
        "worktype_no",
        "worktype_name",
        F.col("source_pid").alias("current_pid"),
        F.col("source_project_name").alias("current_project_name"),
        "current_cid",
        F.coalesce("company_name", F.lit(MISSING_NAME)).alias("current_company_name"),
        "is_job",
        F.coalesce("mobilephone", F.lit(MISSING_NAME)).alias("mobilephone"),
        F.coalesce("bad_status", F.lit(False)).alias("bad_status"),
        *[c.alias(n) for n, c in stamp(as_of).items()],
    )


