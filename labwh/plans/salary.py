"""Wage reports: batches, banks, areas, months."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions import (
    add_months,
    in_ten_thousands,
    live,
    month_of,
    same_year_month,
    text_key,
)
from labwh.operators import (
    By,
    attach_totals,
    count_if,
    cumulative_distinct,
    cumulative_sums,
    dense_rank_within,
    heavy_keys,
    lookup_levels,
    met_if,
    numbered_rows,
    rank_by_ranges,
    rank_within,
    running_total,
    scaffold,
    split_amounts,
    sum_if,
    unpivot_metrics,
    with_children,
)
from labwh.operators.heavy import with_parts
from labwh.plans.common import (
    CITY,
    COMPLETED,
    COUNTY,
    OPEN_STATUSES,
    PROJECT_TYPES,
    PROVINCE,
    RUNNING,
    STOPPED,
    add_names,
    areas_below,
    open_projects,
    stamp,
    text_shares,
    valid_deposits,
)
from labwh.sources.staging import staged

# Fixed values.
PAID, AWAITING = 1, 6
COMPANY_TYPES = {1: "build", 2: "construction", 3: "labour", 4: "epc"}
CONSTRUCTION, LABOUR = 2, 3


def paid_batches(
    batches: DataFrame,
    companies: DataFrame,
    bank_accounts: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
) -> DataFrame:
    """Paid wage batch with company, bank and the project or sub-project it was paid for."""
    rows = batches.where((F.col("status") == PAID) & (F.col("type") == 1)).select(
        "batch_no", "cid", "source_pid", "pid", "bkid", "year", "month", "year_month",
        "real_number", "real_amt",
    )
    rows = add_names(rows, companies, "cid", "cid", "company_name", "company_type")
    rows = add_names(rows, bank_accounts, "bkid", "bkid", "bank_name")
    site = ["pid", "project_name", "county_code", "project_condition"]
    sites = projects.select(*site).union(sub_projects.select(*site)).distinct()
    return rows.join(sites, "pid", "left")


def salary_batches(
    batches: DataFrame,
    wages: DataFrame,
    companies: DataFrame,
    bank_accounts: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
    areas: DataFrame,
) -> DataFrame:
    """Wage batch of an open project or one of its live sub-projects: payees, amount paid,
    company, bank and area names."""
    rows = batches.where((F.col("source_pid") != 0) & live()).select(
        "batch_no", "cid", "source_pid", "pid", "bkid", "year", "month", "year_month",
        "real_number", "real_amt", "status", "type",
    )
    # Two steps: one row per payee, then one per batch; no row expansion for the distinct count.
    payees = wages.where((F.col("status") == PAID) & live()).groupBy("batch_no", "real_name")
    per_batch = (
        payees.agg(F.sum("real_amt").alias("amt"))
        .groupBy("batch_no")
        .agg(F.count("real_name").alias("person_sum"), F.sum("amt").alias("ss_real_amt"))
    )
    # The narrowest joins come first, as every join shuffles what the ones before it added.
    rows = rows.join(per_batch, "batch_no", "left")
    rows = add_names(rows, companies, "cid", "cid", "company_name", "company_type", "is_location")
    rows = add_names(rows, bank_accounts, "bkid", "bkid", "bank_name")
    opened = open_projects(projects)
    tree = with_children(opened, "pid", sub_projects.where(live()), "pid", "source_pid")
    facts = opened.select(
        F.col("pid").alias("source_pid"), "project_name", "project_condition",
        F.col("status").alias("project_status"), "is_deleted", "province_code", "city_code",
        "county_code",
    )
    facts = lookup_levels(
        facts,
        areas,
        {
            "province_name": ("province_code", PROVINCE),
            "city_name": ("city_code", CITY),
            "county_name": ("county_code", COUNTY),
        },
    )
    rows = rows.join(tree.join(facts, "source_pid"), ["source_pid", "pid"])
    counts = ["person_sum", "ss_real_amt"]
    columns = [c for c in rows.columns if c not in ("batch_no", *counts)]
    return rows.select("batch_no", *columns, *counts)


def bank_area_month(salary: DataFrame) -> DataFrame:
    """Month × county × bank: amount, people, distinct projects."""
    by = ["year", "month", "city_name", "county_code", "county_name", "bank_name"]
    per_project = salary.groupBy(*by, "pid").agg(
        F.sum("ss_real_amt").alias("amt"), F.sum("person_sum").alias("n")
    )
    return per_project.groupBy(*by).agg(
        F.sum("amt").alias("real_amt"),
        F.sum("n").alias("real_number"),
        F.count("pid").alias("project_total"),
    )


def bank_rank(bank_months: DataFrame, year: int, county_code: str) -> DataFrame:
    """League table of banks for a year and a county."""
    rows = bank_months.where((F.col("year") == year) & (F.col("county_code") == county_code))
    sums = rows.groupBy("bank_name").agg(
        *[F.sum(c).alias(c) for c in ("real_amt", "real_number", "project_total")]
    )
    order = [By("real_amt", True), By("real_number", True), By("project_total", True), By("bank_name")]
    return rank_by_ranges(sums, [], order, "rank")


def project_bank_rank(salary: DataFrame) -> DataFrame:
    """Project × bank: amount, people, rank of the bank inside the project. A project has as many rows
    here as it has banks, so it is ranked by one task."""
    sums = salary.groupBy("pid", "project_name", "county_name", "bank_name").agg(
        F.sum("ss_real_amt").alias("amt_total"), F.sum("person_sum").alias("person_total")
    )
    order = [F.col("amt_total").desc_nulls_last(), F.col("bank_name"), F.col("project_name"), F.col("county_name")]
    return rank_within(sums, ["pid"], order, "rank")


def area_months(salary: DataFrame) -> DataFrame:
    """Month × county: amounts by company type, batches, people."""
    rows = salary.where(F.col("status").isin(PAID, AWAITING))
    return rows.groupBy("province_name", "city_name", "county_name", "year", "month").agg(
        F.sum("ss_real_amt").alias("real_amt_total"),
        F.count("batch_no").alias("batch_total"),
        F.sum("person_sum").alias("labourer_total"),
        *split_amounts(
            "ss_real_amt", "company_type", {k: f"{n}_amt_total" for k, n in COMPANY_TYPES.items()}
        ),
    )


def area_totals(area_month: DataFrame, areas: DataFrame, as_of: dt.date, city: str) -> DataFrame:
    """County: all-time amounts beside last month's, with shares by company type. Each share is
    taken of its own period's total."""
    last = add_months(as_of, -1)
    is_last = same_year_month("year", "month", last)
    sums = ["real_amt_total", "batch_total", "labourer_total"]
    sums += [f"{n}_amt_total" for n in COMPANY_TYPES.values()]
    both = area_month.groupBy("county_name").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max(F.when(is_last, F.col("year"))).alias("year"),
        F.max(F.when(is_last, F.col("month"))).alias("month"),
        *[F.sum(F.when(is_last, F.col(c))).alias(f"lastmonth_{c}") for c in sums],
    )
    shares = {}
    for p in ("", "lastmonth_"):
        for n in COMPANY_TYPES.values():
            shares[f"{p}{n}_proportion"] = (f"{p}{n}_amt_total", f"{p}real_amt_total")
    both = text_shares(both, shares)
    counties = areas_below(areas.where(live()), city).select(F.col("name").alias("county"))
    rows = scaffold(counties, both, [("county", "county_name")], fill=None)
    return rows.withColumnRenamed("county", "county_name")


def salary_snapshot(salary: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: wages by company type, and projects by state."""
    rows = salary.where(F.col("status").isin(PAID, AWAITING))
    wages = rows.agg(
        F.sum("real_amt").alias("real_amt_total"),
        F.count("batch_no").alias("batch_total"),
        F.sum("real_number").alias("labourer_total"),
        *split_amounts(
            "real_amt",
            "company_type",
            {CONSTRUCTION: "construction_amt_total", LABOUR: "labour_amt_total"},
        ),
    )
    states = rows.select("pid", "project_condition").distinct()
    projects = states.agg(
        F.count("pid").alias("project_total"),
        count_if(F.col("project_condition") == RUNNING).alias("build_project_total"),
        count_if(F.col("project_condition") == COMPLETED).alias("completed_project_total"),
    )
    row = text_shares(
        attach_totals(wages, projects),
        {
            "construction_amt_proportion": ("construction_amt_total", "real_amt_total"),
            "labour_amt_proportion": ("labour_amt_total", "real_amt_total"),
            "build_project_proportion": ("build_project_total", "project_total"),
            "completed_project_proportion": ("completed_project_total", "project_total"),
        },
    )
    return row.withColumn("create_time", F.lit(as_of))


def _payment_sites(
    batches: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
    companies: DataFrame,
    bank_accounts: DataFrame,
    areas: DataFrame,
) -> DataFrame:
    """Batch with project, parent project, companies and bank: what all wage lines of a batch share."""
    opened = open_projects(projects)
    parent = opened.select(
        F.col("pid").alias("source_pid"),
        F.col("project_name").alias("source_project_name"),
        F.col("project_type").alias("source_project_type"),
        F.col("project_condition").alias("source_project_condition"),
        F.col("county_code").alias("source_county_code"),
        F.col("cid").alias("source_cid"),
    )
    site = ["pid", "project_name", "county_code", "cid"]
    own = opened.select(F.col("pid").alias("source_pid"), *site)
    below = sub_projects.where(live()).select("source_pid", *site)
    sites = parent.join(own.union(below).distinct(), "source_pid")
    owner = companies.withColumnsRenamed(
        {"company_name": "pro_company_name", "company_type": "pro_company_type"}
    )
    sites = add_names(sites, owner, "cid", "cid", "pro_company_name", "pro_company_type")
    sites = lookup_levels(sites, areas, {"county_name": ("county_code", COUNTY)})

    paid = batches.where(live()).select(
        "batch_no", "pid", F.col("cid").alias("salary_cid"), "bkid",
        F.col("status").alias("batch_status"), F.col("real_amt").alias("batch_real_amt"),
        F.col("amt").alias("batch_amt"), F.col("number").alias("batch_number"), "year", "month",
        "year_month", F.col("create_time").alias("batch_create_time"),
    )
    payer = companies.where(live()).withColumnsRenamed(
        {"company_name": "salary_company_name", "company_type": "salary_company_type"}
    )
    paid = add_names(paid, payer, "salary_cid", "cid", "salary_company_type", "salary_company_name")
    paid = add_names(paid, bank_accounts, "bkid", "bkid", "bank_name")
    return paid.join(sites, "pid")


LINE = ["batch_no", "real_name", "id_card_no", "real_amt", "total_amt", "status"]
PAYROLL = ["batch_no", "id_card_no", "worktype_name", "group_name"]


def _wage_lines(wages: DataFrame, payroll_lines: DataFrame) -> DataFrame:
    """Wage line with work type and group."""
    lines = wages.where(live()).select(*LINE)
    return lines.join(payroll_lines.select(*PAYROLL), ["batch_no", "id_card_no"], "left")


def _shown_lines(rows: DataFrame, as_of: dt.date, *more: str) -> DataFrame:
    return rows.select(
        "source_county_code", "county_code", "county_name", "source_pid", "source_project_name",
        "source_project_type", "source_project_condition", "source_cid", "pid", "project_name",
        "cid", "pro_company_name", "pro_company_type", "salary_cid",
        F.coalesce("salary_company_type", F.lit(0)).alias("salary_company_type"),
        "salary_company_name", "year", "month", "year_month", "batch_no", "batch_status",
        "batch_real_amt", "batch_amt", "batch_number", "batch_create_time", "id_card_no",
        "real_name", "real_amt", "total_amt", "status",
        F.months_between(F.lit(as_of), "year_month").alias("new_salary"), "worktype_name",
        "group_name", "bank_name", *more,
    )


def salary_lines(
    batches: DataFrame,
    wages: DataFrame,
    payroll_lines: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
    companies: DataFrame,
    bank_accounts: DataFrame,
    areas: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Wage line with batch, project, parent project, companies and bank."""
    sites = _payment_sites(batches, projects, sub_projects, companies, bank_accounts, areas)
    return _shown_lines(_wage_lines(wages, payroll_lines).join(sites, "batch_no"), as_of)


#: Order of the lines of a batch, and of the months of a parent project.
LINE_ORDER = [By(c) for c in ("id_card_no", "real_name", "real_amt", "total_amt", "status", "worktype_name", "pid", "source_pid")]
MONTH = ["batch_status", "year", "month"]


def _month_order() -> list[Column]:
    return [F.col("batch_status").asc(), F.col("year").desc(), F.col("month").desc()]


def salary_detail(
    batches: DataFrame,
    wages: DataFrame,
    payroll_lines: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
    companies: DataFrame,
    bank_accounts: DataFrame,
    areas: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """:func:`salary_lines` with the ordinal of the line in its batch, and the dense rank of the
    parent project's months (latest first, per batch status).

    Wage lines, payroll and sites are dealt by batch once, and joined and numbered where they are, so the wide lines
    are not shuffled. Batches that hold more than a quarter of an average task's lines are left out of this; they are few by
    definition. Their lines are stored and numbered by many tasks with the number of their site alone.
    """
    sites = numbered_rows(
        _payment_sites(batches, projects, sub_projects, companies, bank_accounts, areas), "_site", "salary-sites")
    lines = wages.where(live() & F.col("batch_no").isNotNull())
    heavy = staged(heavy_keys(lines, ["batch_no"], "_parts"), "heavy-batches")

    def of(df: DataFrame, large: bool) -> DataFrame:
        marked = with_parts(df, ["batch_no"], heavy, "_parts")
        return marked.where(F.col("_parts").isNotNull() if large else F.col("_parts").isNull()).drop("_parts")

    months = sites.select("_site", "batch_no", "source_pid", *MONTH)
    paid = months.join(lines.select("batch_no").distinct(), "batch_no", "left_semi")
    months = dense_rank_within(months, ["source_pid"], MONTH, _month_order(), "salary_top", among=paid)
    months = staged(months.select("_site", "batch_no", "salary_top"), "salary-months")

    def dealt(df: DataFrame) -> DataFrame:
        return of(df, large=False).repartition("batch_no")

    rows = dealt(lines.select(*LINE)).join(dealt(payroll_lines.select(*PAYROLL)), ["batch_no", "id_card_no"], "left")
    rows = rows.join(dealt(sites).join(dealt(months), ["batch_no", "_site"]), "batch_no")
    rows = rank_within(rows, ["batch_no"], [by.sort for by in LINE_ORDER], "batch_top")

    # Without such batches the facts are not read for them.
    some = F.lit(not heavy.isEmpty())
    few_wages, few_payroll = (of(x.where(some), large=True) for x in (wages, payroll_lines))
    few_sites, few_months = of(sites, large=True), of(months, large=True)
    few = _wage_lines(few_wages, few_payroll).join(few_sites.select("_site", "batch_no", "pid", "source_pid"), "batch_no")
    few = numbered_rows(few, "_row", "salary-lines")
    few = rank_by_ranges(few, ["batch_no"], LINE_ORDER, "batch_top", row="_row").drop("batch_no", "pid", "source_pid")
    few = few.join(few_sites.join(few_months.drop("batch_no"), "_site"), "_site")
    shown = [_shown_lines(x, as_of, "batch_top", "salary_top") for x in (rows, few)]
    return shown[0].unionByName(shown[1])


def salary_total(details: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: all-time and last-month wages by company type, people, batches, projects."""
    paid = F.col("status") == PAID
    last = same_year_month("year", "month", add_months(as_of, -1))

    def wages(cond: Column, prefix: str) -> list[Column]:
        kind = F.col("salary_company_type")
        return [
            F.sum(F.when(cond, F.col("real_amt"))).alias(f"{prefix}real_amt"),
            sum_if(cond & (kind == CONSTRUCTION), "real_amt").alias(f"{prefix}Construction_Amt"),
            sum_if(cond & (kind == LABOUR), "real_amt").alias(f"{prefix}labourer_Amt"),
        ]

    sums = details.where(paid).agg(*wages(F.lit(True), ""), *wages(last, "last_"))
    people = details.where(paid & F.col("id_card_no").isNotNull()).groupBy("id_card_no")
    heads = people.agg(F.max(last.cast("int")).alias("recent")).agg(
        F.count("*").alias("labourer_count"), F.coalesce(F.sum("recent"), F.lit(0)).alias("last_labourer_count")
    )
    per_batch = details.where(F.col("batch_no").isNotNull()).groupBy("batch_no")
    batch = per_batch.agg(F.max(last.cast("int")).alias("recent")).agg(
        F.count("*").alias("batch_sum"), F.coalesce(F.sum("recent"), F.lit(0)).alias("last_batch_sum")
    )
    state = F.col("source_project_condition")
    projects = details.select("source_pid", "source_project_condition").distinct()
    projects = projects.agg(
        F.count("source_pid").alias("project_total"),
        count_if(state == RUNNING).alias("build_project_total"),
        count_if(state.isin(COMPLETED, STOPPED)).alias("complete_project_total"),
    )
    return text_shares(
        attach_totals(sums, heads, batch, projects),
        {
            "Construction_Amt_proportion": ("Construction_Amt", "real_amt"),
            "labourer_Amt_proportion": ("labourer_Amt", "real_amt"),
            "build_project_proportion": ("build_project_total", "project_total"),
            "complete_project_proportion": ("complete_project_total", "project_total"),
            "last_Construction_Amt_proportion": ("last_Construction_Amt", "last_real_amt"),
            "last_labourer_Amt_proportion": ("last_labourer_Amt", "last_real_amt"),
        },
    )


def monthly_metrics(
    projects: DataFrame,
    sub_projects: DataFrame,
    deposits: DataFrame,
    details: DataFrame,
    as_of: dt.date,
    offsets: int = 12,
) -> DataFrame:
    """Month × metric, long: 1 companies with a deposit, 2 running deposit by registration
    month, 3 paying companies, 4 projects paid for, 5 people paid, 6 wages in ten-thousands.

    Metrics 1 and 3-6 are cumulative up to the same day of the month at each offset.
    """
    cutoffs = [add_months(as_of, -k) for k in range(offsets)]
    kinds = F.col("project_type").isin(*PROJECT_TYPES)
    opened = F.col("status").isin(*OPEN_STATUSES) & live() & kinds
    owners = projects.where(opened).select("cid")
    owners = owners.union(sub_projects.where(opened).select(F.col("unit_cid"))).distinct()
    ours = valid_deposits(deposits).join(owners, "cid", "left_semi")
    companies = cumulative_distinct(ours, "reg_date", cutoffs, {"company_sum": "cid"})
    paid = details.where(F.col("status") == PAID)
    ids = {
        "company_salary_sum": "salary_cid",
        "project_count": "source_pid",
        "labourer_sum": "id_card_no",
    }
    seen = cumulative_distinct(paid, "year_month", cutoffs, ids)
    amounts = cumulative_sums(paid, "year_month", cutoffs, {"real_amt": "real_amt"})
    wide = companies.join(seen, "cutoff").join(amounts, "cutoff")
    wide = wide.withColumns(
        {
            "year": F.year("cutoff"),
            "month": F.month("cutoff"),
            "amount_units": in_ten_thousands("real_amt"),
        }
    )
    metrics = {
        1: "company_sum", 3: "company_salary_sum", 4: "project_count", 5: "labourer_sum",
        6: "amount_units",
    }
    long = unpivot_metrics(wide, ["year", "month"], metrics, "type", "amount")
    registered = ours.groupBy(F.year("reg_date").alias("year"), F.month("reg_date").alias("month"))
    running = running_total(
        registered.agg(F.sum("assure_amt").alias("amt")), ["year", "month"], "amt", "amount"
    )
    running = running.select("year", "month", F.lit(2).alias("type"), F.col("amount").cast("long"))
    rows = long.unionByName(running)
    return rows.withColumns({"date_year": F.col("year"), "date_month": F.col("month")})


def monthly_metrics_export(metrics: DataFrame, years: list[int]) -> DataFrame:
    """The metrics of listed years with a ``yyyyMM`` label."""
    rows = metrics.where(F.col("date_year").isin(years))
    return rows.select("year", "month", "amount", "type", text_key("year", "month").alias("year_month"))


def proxy_pay(batches: DataFrame, as_of: dt.date) -> DataFrame:
    """Project × month: amount paid and status 3 when there is some."""
    rows = batches.where(live() & (F.col("status") == PAID))
    sums = rows.groupBy(
        F.col("source_pid").alias("pid"), month_of("year_month").alias("cur_date"), "year", "month"
    ).agg(F.sum("amt").alias("amt"))
    return sums.select(
        text_key("pid", "year", "month").alias("id"),
        "pid",
        met_if(F.col("amt") > 0).alias("status"),
        "cur_date",
        F.col("year").alias("cur_date_year"),
        F.col("month").alias("cur_date_month"),
        "amt",
        *[c.alias(n) for n, c in stamp(as_of).items()],
    )
