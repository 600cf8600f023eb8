"""Compliance reports: month series per project, the six rules, area statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions import (
    MET,
    MISSING_NAME,
    MISSING_TEXT,
    NOT_MET,
    grace_month,
    in_range,
    in_unit,
    live,
    month_of,
    month_start,
    proportion,
    same_year_month,
    text_key,
    unit_range,
)
from labwh.operators import (
    active_in_period,
    add_flags,
    add_measures,
    conditional_measures,
    count_if,
    covered_status,
    flag_exists,
    keyed_join,
    latest_per_key,
    latest_up_to,
    merge_latest,
    met_if,
    null_safe_join,
    outer_merge,
    period_series,
    score_rules,
    spread_join,
    sum_once,
)
from labwh.plans.attendance import month_report
from labwh.plans.common import (
    OPEN_SUB_STATUSES,
    add_names,
    located_deposits,
    stamp,
    valid_deposits,
)

# Fixed values.
INCOME = 1
BUILDING_INDUSTRY = 1
AREA = ["province_code", "city_code", "county_code", "industry_type"]
RULES = {
    "real": "real_status",
    "bail": "bail_status",
    "accoun": "account_status",
    "proxy_pay": "proxy_pay_status",
    "billboard": "billboard_status",
    "pay": "pay_status",
}


def income_months(
    projects: DataFrame,
    transfers: DataFrame,
    months: Sequence[dt.date],
    as_of: dt.date,
    only_valid: bool = True,
) -> DataFrame:
    """Project × month: income into the project account, 0 when none; status 3 when there is
    some. ``only_valid`` counts transfers marked valid only."""
    rows = transfers.where((F.col("jtype") == INCOME) & live())
    if only_valid:
        rows = rows.where(F.col("is_pro_valid") > 0)
    series = period_series(
        projects.select("pid", "is_deleted"), rows, "pid", "trans_time", months, {"amt": F.sum("amt")}
    )
    return month_report(series, as_of).withColumn("status", met_if(F.col("amt") > 0))


def billboard_months(projects: DataFrame, billboards: DataFrame, as_of: dt.date) -> DataFrame:
    """Project × month with a billboard: the latest one of the month."""
    rows = billboards.select("pid", F.col("create_time").alias("up_time"))
    rows = rows.withColumn("cur_date", month_of("up_time"))
    latest = latest_per_key(rows, ["pid", "cur_date"], [F.col("up_time").desc()])
    out = latest.join(projects.select("pid", "is_deleted"), "pid")
    return month_report(out, as_of).withColumn("status", F.lit(MET)).drop("date_year", "date_month")


def billboard_as_of(
    projects: DataFrame, billboards: DataFrame, dates: Sequence[dt.date], as_of: dt.date
) -> DataFrame:
    """Project × date: latest live billboard up to the date; status 3 when there is one."""
    facts = billboards.where(live()).select("pid", F.col("create_time").alias("up_time"))
    rows = latest_up_to(
        projects.select("pid", "is_deleted"), facts, "pid", "up_time", dates, [], "at"
    )
    rows = rows.withColumn("cur_date", month_of("at")).drop("at")
    return month_report(rows, as_of).withColumn("status", met_if(F.col("up_time").isNotNull()))


def payroll_months(
    projects: DataFrame,
    employment_intervals: DataFrame,
    batches: DataFrame,
    wages: DataFrame,
    months: Sequence[dt.date],
    as_of: dt.date,
) -> DataFrame:
    """Project × month: people employed, people paid, amount paid; status 3 when some was. Dates
    inside a month stand for the month, so the overlap test starts at its first day."""
    months = [month_start(m) for m in months]
    own = projects.select("pid")
    spans = employment_intervals.where(live())
    spans = keyed_join(spans, own, [("source_pid", "pid")], "left_semi")
    employed = active_in_period(
        spans, ["source_pid"], "id_card_no", "starttime", "endtime", months, "real_count"
    )
    listed = reduce(lambda a, b: a | b, [(F.col("year") == m.year) & (F.col("month") == m.month) for m in months])
    paid = batches.where((F.col("status") == 1) & live() & listed)
    paid = paid.withColumn("cur_date", F.make_date("year", "month", F.lit(1)))
    lines = wages.where((F.col("status") == 1) & live()).select("batch_no", "id_card_no")
    people = paid.select("batch_no", "source_pid", "cur_date").join(lines, "batch_no")
    people = people.select("source_pid", "cur_date", "id_card_no").distinct()
    payees = people.groupBy("source_pid", "cur_date").agg(F.count("*").alias("pay_count"))
    amounts = paid.groupBy("source_pid", "cur_date").agg(F.sum("real_amt").alias("amt"))
    merged = outer_merge(["source_pid", "cur_date"], employed, payees, amounts)
    dates = F.explode(F.array(*[F.lit(m) for m in months]))
    grid = projects.select("pid", "is_deleted", dates.alias("cur_date"))
    rows = grid.join(merged.withColumnRenamed("source_pid", "pid"), ["pid", "cur_date"], "left")
    rows = rows.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in ("real_count", "pay_count", "amt")}
    )
    return month_report(rows, as_of).withColumn("status", met_if(F.col("amt") > 0))


def rule_scores(
    projects: DataFrame,
    companies: DataFrame,
    employment_intervals: DataFrame,
    deposits: DataFrame,
    special_accounts: DataFrame,
    transfers: DataFrame,
    agreements: DataFrame,
    billboards: DataFrame,
    sub_projects: DataFrame,
    commissions: DataFrame,
    batches: DataFrame,
    as_of: dt.date,
    entrust_city: str,
) -> DataFrame:
    """Project with rule statuses: components 1 not met, 3 met, 4 partly met, and composites.

    Payment and account income are judged for the month that the grace rule selects; both
    candidate months are read in one pass. In ``entrust_city`` building projects need a
    commission for each company with a sub-project.
    """
    last, second_last = month_start(as_of, -1), month_start(as_of, -2)
    base = projects.select(
        F.col("pid").alias("id"), "pid", "industry_type", "project_type", "project_name",
        F.col("project_condition").alias("p_status"), "cid", "investment_nature", "province_code",
        "city_code", "county_code", "construct_cost", "is_deleted",
        grace_month("pay_day", as_of).alias("judged"),
    )
    # A company may run very many projects: this join is spread, and done while the rows are
    # still a plain scan.
    secured = located_deposits(deposits).select("cid", "province_code", "city_code")
    place = ["cid", "province_code", "city_code"]
    base = flag_exists(base, secured, place, "secured", spread=["pid"])
    base = add_names(base, companies, "cid", "cid", "company_name")
    hit = F.lit(True)
    held = employment_intervals.where(F.col("is_job") & live())
    account = special_accounts.where(live() & (F.col("status") == 1))
    partners = companies.where(live()).select(F.col("cid").alias("sg_cid"))
    three_party = agreements.where(live()).join(partners, "sg_cid", "left_semi")
    paid = batches.where(live() & (F.col("status") == 1))
    rows = add_flags(
        base,
        "pid",
        [
            (held, "source_pid", {"booked": hit}),
            (account, "pid", {"special": hit}),
            (three_party, "pid", {"three": hit}),
            (billboards, "pid", {"board": hit}),
            (
                paid,
                "source_pid",
                {
                    "paid_last": same_year_month("year", "month", last),
                    "paid_before": same_year_month("year", "month", second_last),
                },
            ),
        ],
    )

    income = transfers.where(
        (F.col("jtype") == INCOME) & live() & (F.col("is_pro_valid") > 0)
        & in_range("trans_time", (second_last, month_start(as_of)))
    )
    is_last = in_range("trans_time", unit_range(last, "month"))
    income = income.groupBy("pid").agg(
        F.sum(F.when(is_last, F.col("amt"))).alias("in_last"),
        F.sum(F.when(~is_last, F.col("amt"))).alias("in_before"),
    )
    units = companies.where(live()).select(F.col("cid").alias("unit_cid"), "organization_code")
    subs = sub_projects.where(live() & F.col("status").isin(*OPEN_SUB_STATUSES))
    subs = subs.select(F.col("source_pid").alias("pid"), "unit_cid").join(units, "unit_cid")
    needed = subs.select("pid", "organization_code").distinct().groupBy("pid")
    needed = needed.agg(F.count("organization_code").alias("wta_count"), F.lit(1).alias("has_sub"))
    code = "subcontract_company_organization_code"
    done = commissions.where(live()).select("pid", code).distinct()
    done = done.groupBy("pid").agg(F.count(code).alias("wtb_count"))
    rows = add_measures(rows, "pid", income, needed, done)
    rows = rows.fillna(0, subset=["wta_count", "wtb_count", "has_sub"])

    by_last = F.col("judged") == F.lit(last)
    pay = met_if(F.when(by_last, F.col("paid_last")).otherwise(F.col("paid_before")) == 1)
    received = met_if(F.when(by_last, F.col("in_last")).otherwise(F.col("in_before")) > 0)
    strict = (F.col("city_code") == entrust_city) & (F.col("industry_type") == BUILDING_INDUSTRY)
    strict = F.coalesce(strict, F.lit(False))
    committed = F.col("wtb_count") > 0
    entrust = (
        F.when(strict & (F.col("has_sub") == 0), F.lit(NOT_MET))
        .when(strict, covered_status(F.col("wtb_count"), F.col("wta_count")))
        .otherwise(met_if(committed))
    )
    rows = score_rules(
        rows,
        {
            "company_name": F.coalesce("company_name", F.lit(MISSING_NAME)),
            "real_book_status": met_if(F.col("booked") == 1),
            "real_contract_status": F.lit(MET),
            "real_pay_status": pay,
            "bail_status": met_if(F.col("secured") == 1),
            "account_special_status": met_if(F.col("special") == 1),
            "account_in_status": received,
            "account_three_status": met_if(F.col("three") == 1),
            "proxy_pay_payroll_status": pay,
            "proxy_pay_entrustl_status": entrust,
            "proxy_pay_islw": F.when(strict, F.col("has_sub")).otherwise(
                F.when(committed, 1).otherwise(0)
            ),
            "billboard_status": met_if(F.col("board") == 1),
            "pay_status": pay,
        },
        {
            "real_status": ["real_book_status", "real_pay_status"],
            "account_status": ["account_special_status", "account_three_status"],
        },
    )
    entrusted = F.when(F.col("proxy_pay_islw") == 1, MET).otherwise(NOT_MET)
    proxy = (F.col("proxy_pay_payroll_status") == MET) & (
        F.col("proxy_pay_entrustl_status") == entrusted
    )
    rows = rows.withColumn("proxy_pay_status", met_if(proxy))
    return rows.select(
        "id", "pid", "industry_type", "project_type", "project_name", "p_status", "cid",
        "company_name", "investment_nature", "province_code", "city_code", "county_code",
        "construct_cost", "real_status", "real_book_status", "real_contract_status",
        "real_pay_status", "bail_status", "account_status", "account_special_status",
        "account_in_status", "account_three_status", "proxy_pay_status",
        "proxy_pay_payroll_status", "proxy_pay_entrustl_status", "proxy_pay_islw",
        "billboard_status", "pay_status",
        *[c.alias(n) for n, c in stamp(as_of, is_deleted=False).items()], "is_deleted",
        F.lit(as_of.year).alias("date_year"), F.lit(as_of.month).alias("date_month"),
    )


def rule_statistics(scores: DataFrame, as_of: dt.date) -> DataFrame:
    """Area × industry: running projects that meet each rule, and all six, with shares."""
    rows = scores.where(live() & (F.col("p_status") == 3))
    complete: Column = F.lit(True)
    for status in RULES.values():
        complete = complete & (F.col(status) == MET)
    counts = conditional_measures(
        rows,
        AREA,
        {
            "project_count": (F.lit(True), None),
            **{f"{r}_count": (F.col(s) == MET, None) for r, s in RULES.items()},
            "complete_count": (complete, None),
        },
    )
    shares = {
        f"{r}_proportion": proportion(f"{r}_count", "project_count") for r in [*RULES, "complete"]
    }
    key = text_key(
        "city_code", "county_code", F.lit(as_of.year), F.lit(as_of.month), "industry_type"
    )
    return counts.withColumns(
        {
            "id": key,
            "cur_date": F.lit(month_start(as_of)),
            "cur_date_year": F.lit(as_of.year),
            "cur_date_month": F.lit(as_of.month),
            **shares,
            **stamp(as_of),
            "sync_flag": F.lit(MISSING_TEXT),
        }
    )


def _industry_projects(projects: DataFrame) -> DataFrame:
    return projects.where(live() & (F.col("industry_type") != 0))


def area_statistics(
    projects: DataFrame,
    billboards: DataFrame,
    deposits: DataFrame,
    special_accounts: DataFrame,
    batches: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Area × industry: projects by state, billboards, accounts, wages, and deposits; a
    company's deposit in a city counts once, on its largest project id."""
    base = _industry_projects(projects).select("pid", "cid", "project_condition", *AREA)
    hit = F.lit(True)
    account = special_accounts.where(live() & (F.col("status") == 1))
    rows = add_flags(
        base,
        "pid",
        [
            (billboards.where(live()), "pid", {"billboard_count": hit}),
            (account, "pid", {"account_count": hit}),
        ],
    )
    paid = batches.where((F.col("status") == 1) & (F.col("type") == 1))
    wages = paid.groupBy(F.col("source_pid").alias("pid")).agg(F.sum("real_amt").alias("salary"))
    rows = add_measures(rows, "pid", wages)
    state = F.col("project_condition")
    counts = conditional_measures(
        rows,
        AREA,
        {
            "project_count": (F.lit(True), None),
            "project_construction": (state == 3, None),
            "project_stop": (state == 5, None),
            "project_completed": (state == 6, None),
            "project_complete": (state == 4, None),
            "billboard_count": (F.lit(True), "billboard_count"),
            "account_count": (F.lit(True), "account_count"),
            "salary_amt_total": (F.lit(True), "salary"),
        },
    )
    place = ["cid", "province_code", "city_code"]
    secured = located_deposits(deposits).groupBy(*place).agg(F.sum("assure_amt").alias("amt"))
    owned = spread_join(base, secured, place, "inner", unique=["pid"])
    once = sum_once(owned, AREA, place, "amt", [F.col("pid").desc()], "bail_amt_total")
    out = null_safe_join(counts, once, AREA, "left")
    return out.withColumns(
        {
            "id": text_key(*AREA),
            "bail_amt_total": F.coalesce("bail_amt_total", F.lit(0)),
            **stamp(as_of),
        }
    )


def city_statistics(
    projects: DataFrame,
    companies: DataFrame,
    deposits: DataFrame,
    billboards: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Province × city: projects by state, distinct known companies, companies with a deposit,
    billboards."""
    by = ["province_code", "city_code"]
    known = companies.select("cid").distinct().withColumn("known", F.lit(1))
    boards = billboards.where(live()).groupBy("pid").agg(F.count("*").alias("boards"))
    rows = projects.where(live()).select("pid", "cid", "project_condition", *by)
    rows = rows.join(boards, "pid", "left")
    state = F.col("project_condition")
    per_company = rows.groupBy(*by, "cid").agg(
        F.count("*").alias("project_count"),
        count_if(state == 3).alias("project_construction"),
        count_if(state == 5).alias("project_stop"),
        count_if(state == 6).alias("project_completed"),
        F.sum("boards").alias("billboard_count"),
    )
    # Rows per company are bounded by the number of cities.
    per_company = per_company.join(known, "cid", "left")
    sums = ["project_count", "project_construction", "project_stop", "project_completed", "billboard_count"]
    out = per_company.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in sums], F.count("known").alias("company_count")
    )
    secured = valid_deposits(deposits).select(*by, "cid").distinct().groupBy(*by)
    out = out.join(secured.agg(F.count("cid").alias("company_bond_count")), by, "left")
    return out.withColumns({"id": F.concat(*by), **stamp(as_of)})


def month_statistics(
    projects: DataFrame,
    special_accounts: DataFrame,
    deposits: DataFrame,
    batches: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Area × industry for the month of ``as_of``: wages paid, projects with a new account, new
    deposits; each company's deposit in a city counts once, on its highest industry."""
    sites = _industry_projects(projects).select("pid", "cid", *AREA)
    paid = batches.where(
        (F.col("status") == 1) & (F.col("type") == 1) & same_year_month("year", "month", as_of)
    )
    wages = paid.groupBy(F.col("source_pid").alias("pid")).agg(F.sum("real_amt").alias("amt"))
    salary = sites.join(wages, "pid").groupBy(*AREA).agg(F.sum("amt").alias("salary_amt"))
    opened = special_accounts.where(
        live() & (F.col("status") == 1) & in_unit("create_time", as_of, "month")
    )
    accounts = sites.join(opened.select("pid").distinct(), "pid", "left_semi")
    accounts = accounts.groupBy(*AREA).agg(F.countDistinct("pid").alias("company_safeguard_count"))
    place = ["cid", "province_code", "city_code"]
    fresh = located_deposits(deposits).where(in_unit("create_time", as_of, "month"))
    fresh = fresh.select(*place, "assure_amt")
    # One row per company, place and industry area is enough to find the first one.
    targets = sites.select("cid", *AREA).distinct()
    bail = sum_once(
        targets.join(fresh, place),
        AREA,
        place,
        "assure_amt",
        [F.col("industry_type").desc(), F.col("county_code"), F.col("assure_amt").desc()],
        "bail_amt",
    )
    rows = outer_merge(AREA, salary, accounts, bail)
    month = month_start(as_of)
    return rows.withColumns(
        {
            "id": text_key("county_code", F.lit(as_of.year), F.lit(as_of.month), "industry_type").try_cast("long"),
            "cur_date": F.lit(month),
            "cur_date_year": F.lit(as_of.year),
            "cur_date_month": F.lit(as_of.month),
            **stamp(as_of),
        }
    )


def merge_month_statistics(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The stored month report with fresh months on top, by area, industry and month; the report's
    id names neither province nor city and is NULL without a county."""
    return merge_latest(stored, fresh, [*AREA, "cur_date_year", "cur_date_month"])
