"""Project reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions import any_filled, filled, live, money, null_bucket, same_year_month
from labwh.operators import (
    add_flags,
    add_measures,
    attach_totals,
    conditional_measures,
    count_if,
    keyed_join,
    label_list,
    lookup_levels,
    outer_merge,
    spread_join,
    sum_if,
)
from labwh.plans.common import (
    CITY,
    COMPLETED,
    COUNTY,
    OPEN_STATUSES,
    OPEN_SUB_STATUSES,
    PROJECT_TYPES,
    PROVINCE,
    RUNNING,
    STOPPED,
    UNVERIFIED_GRADE,
    add_names,
    date_text,
    open_projects,
    text_shares,
    valid_deposits,
)

# Fixed values.
CONTRACT_AUDIT, AGREEMENT_AUDIT = 4, 5
CONTRACTS = ("contract1", "contract2", "contract3", "contract4", "contract5")
COMPANY_GROUPS = {1: "epc", 2: "construction", 3: "labour", 4: "design"}
PAID_LABEL, EXEMPT_LABEL, UNPAID_LABEL = "在缴", "免缴", "未缴"
FILED_LABEL, UNFILED_LABEL = "已备案", "未备案"
AMOUNT_UNIT = "万元"

AREA_NAMES = {
    "province_name": ("province_code", PROVINCE),
    "city_name": ("city_code", CITY),
    "county_name": ("county_code", COUNTY),
}
FLAG_SUMS = {
    "is_realname": "realname_total",
    "project_account_status": "account_total",
    "safeguard_status": "safeguard_total",
    "is_attendance": "attendance_total",
    "contract_status": "contract_total",
    "is_agreement": "agreement_total",
}


def _dated(df: DataFrame, pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Creation day as text, with year, month and day columns."""
    return df.withColumns(
        {
            "year": F.year("create_time"),
            "month": F.month("create_time"),
            "day": F.day("create_time"),
            "create_time": date_text("create_time", pattern),
        }
    )


def _billboards(billboards: DataFrame) -> DataFrame:
    return billboards.where(live()).groupBy("pid").agg(F.count("pid").alias("billboards"))


def _audited(rows: DataFrame, audits: DataFrame, kind: int) -> DataFrame:
    """Rows whose project has an accepted audit of the kind."""
    ok = audits.where(live() & (F.col("status") == 1) & (F.col("type") == kind))
    return keyed_join(rows, ok.select("bus_id"), [("pid", "bus_id")], "left_semi")


def project_day_old(
    projects: DataFrame,
    areas: DataFrame,
    employments: DataFrame,
    labourers: DataFrame,
    special_accounts: DataFrame,
    bank_accounts: DataFrame,
    deposits: DataFrame,
    billboards: DataFrame,
    attendance_ext: DataFrame,
    contracts: DataFrame,
    agreements: DataFrame,
) -> DataFrame:
    """Project of the older source with state, area names, flags, billboards and deposit; one
    row per project."""
    state = F.when(F.col("is_completed") == "Y", 3).when(F.col("is_lock") == "Y", 2).otherwise(1)
    rows = _dated(
        projects.select(
            "pid", "cid", "project_type", state.alias("project_status"), "province_code",
            "city_code", "county_code", "create_time",
        ),
        "yyyy-M-d",
    )
    rows = add_measures(rows, "cid", _deposit_by_company(deposits), spread=["pid"])
    rows = lookup_levels(rows, areas, AREA_NAMES)
    verified = labourers.where(F.col("real_grade") != UNVERIFIED_GRADE).select("lid")
    named = employments.join(verified, "lid", "left_semi")
    valid = special_accounts.where(live() & (F.col("status") == 1))
    valid = valid.select(F.col("account_no").alias("bank_account_no"), "cid")
    accounts = bank_accounts.where(F.col("pid") != 0).join(valid, ["bank_account_no", "cid"], "left_semi")
    signed = contracts.where(F.col("pid").isNotNull() & live() & ~F.col("is_stop"))
    hit = F.lit(True)
    rows = add_flags(
        rows,
        "pid",
        [
            (named, "source_pid", {"is_realname": hit}),
            (accounts, "pid", {"project_account_status": hit}),
            (attendance_ext.where(live()), "pid", {"is_attendance": F.col("is_attendance") == 1}),
            (signed, "pid", {"contract_status": hit}),
            (agreements, "pid", {"is_agreement": hit}),
        ],
    )
    rows = add_measures(rows, "pid", _billboards(billboards))
    return rows.withColumns(
        {
            "billboards": F.coalesce("billboards", F.lit(0)),
            "safeguard_status": F.coalesce("safeguard_status", F.lit(0)),
            "assure_amt": F.coalesce("assure_amt", F.lit(0)),
        }
    )


def _deposit_by_company(deposits: DataFrame) -> DataFrame:
    sums = valid_deposits(deposits).groupBy("cid").agg(F.sum("assure_amt").alias("assure_amt"))
    return sums.withColumn("safeguard_status", F.lit(1))


def _company_facts(deposits: DataFrame, special_accounts: DataFrame) -> DataFrame:
    """Deposit sum, deposit flag and account flag, one row per company that has any."""
    filed = special_accounts.where(live() & (F.col("status") == 1)).select("cid").distinct()
    filed = filed.withColumn("project_account_status", F.lit(1))
    return outer_merge(["cid"], _deposit_by_company(deposits), filed)


def _paid_wages(batches: DataFrame, *extra: Column) -> DataFrame:
    rows = batches.where((F.col("status") == 1) & (F.col("type") == 1))
    return rows.groupBy(F.col("source_pid").alias("pid")).agg(F.sum("real_amt").alias("real_amt"), *extra)


def project_day(
    projects: DataFrame,
    areas: DataFrame,
    employments: DataFrame,
    special_accounts: DataFrame,
    deposits: DataFrame,
    billboards: DataFrame,
    devices: DataFrame,
    attachments: DataFrame,
    audits: DataFrame,
    agreements: DataFrame,
    batches: DataFrame,
) -> DataFrame:
    """Project with area names, six 0/1 flags, billboards, deposit and wages; one row per
    project. The flags on the project cost one aggregation and one join."""
    rows = _dated(
        projects.select(
            "pid", "cid", "response_code", "build_area", "construct_cost", "project_type",
            "status", "is_deleted", "project_condition", "create_user", "province_code",
            "city_code", "county_code", "create_time",
        )
    )
    # One company may run very many projects, so its columns are joined in parts, and first,
    # while the rows are still a plain scan.
    rows = add_measures(rows, "cid", _company_facts(deposits, special_accounts), spread=["pid"])
    rows = lookup_levels(rows, areas, AREA_NAMES)
    hit = F.lit(True)
    shown = devices.where((F.col("isdelete") == "N") & F.col("is_show"))
    signed = attachments.where(live() & any_filled(*CONTRACTS))
    rows = add_flags(
        rows,
        "pid",
        [
            (employments.where(F.col("is_job") & live()), "source_pid", {"is_realname": hit}),
            (shown, "pid", {"is_attendance": hit}),
            (_audited(signed, audits, CONTRACT_AUDIT), "pid", {"contract_status": hit}),
            (_audited(agreements.where(live()), audits, AGREEMENT_AUDIT), "pid", {"is_agreement": hit}),
        ],
    )
    rows = add_measures(rows, "pid", _billboards(billboards), _paid_wages(batches))
    return rows.withColumns(
        {
            "billboards": F.coalesce("billboards", F.lit(0)),
            "safeguard_status": F.coalesce("safeguard_status", F.lit(0)),
            "project_account_status": F.coalesce("project_account_status", F.lit(0)),
            "assure_amt": F.coalesce("assure_amt", F.lit(0)),
        }
    )


def _flag_sums(billboards: str) -> list[Column]:
    return [
        F.sum(billboards).alias("billboards"),
        *[F.sum(flag).alias(out) for flag, out in FLAG_SUMS.items()],
    ]


def build_area_types(project_days: DataFrame, billboards: str = "billboards") -> DataFrame:
    """County × day × project type: running projects and flag sums. The type is a group key, so
    all types come from one scan."""
    rows = project_days.where(
        (F.col("project_condition") == RUNNING) & F.col("project_type").isin(*PROJECT_TYPES)
    )
    return rows.groupBy(
        null_bucket("county_name").alias("county_name"), "year", "month", "day", "create_time",
        "project_type",
    ).agg(F.count("pid").alias("houses_total"), *_flag_sums(billboards))


def build_area_days(area_types: DataFrame) -> DataFrame:
    """County × day: the types of :func:`build_area_types` side by side."""
    return area_types.groupBy("county_name", "year", "month", "day", "create_time").agg(
        F.sum("houses_total").alias("project_total"),
        *[
            sum_if(F.col("project_type") == label, "houses_total").alias(f"{name}_total")
            for label, name in PROJECT_TYPES.items()
        ],
        *[F.sum(c).alias(c) for c in ("billboards", *FLAG_SUMS.values())],
    )


BUILD_TOTALS = (
    "project_total", *[f"{n}_total" for n in PROJECT_TYPES.values()], "billboards",
    *FLAG_SUMS.values(),
)


def _build_shares(df: DataFrame) -> DataFrame:
    parts = {
        f"{c.removesuffix('_total')}_proportion": (c, "project_total") for c in BUILD_TOTALS[1:]
    }
    return text_shares(df, parts)


def build_day(project_days: DataFrame, billboards: str = "billboards") -> DataFrame:
    """Area × day: running projects by type and flag with shares; unnamed areas form one
    bucket."""
    rows = project_days.where(
        F.col("status").isin(*OPEN_STATUSES)
        & live()
        & (F.col("project_condition") == RUNNING)
        & F.col("project_type").isin(*PROJECT_TYPES)
    )
    sums = rows.groupBy(
        *[null_bucket(f"{x}_name").alias(f"{x}_name") for x in ("province", "city", "county")],
        "year", "month", "day", "create_time",
    ).agg(
        F.count("pid").alias("project_total"),
        *[
            count_if(F.col("project_type") == label).alias(f"{name}_total")
            for label, name in PROJECT_TYPES.items()
        ],
        *_flag_sums(billboards),
    )
    return _build_shares(sums)


def build_total(build_days: DataFrame) -> DataFrame:
    """Area totals of :func:`build_day`; shares are taken anew."""
    by = ["province_name", "city_name", "county_name"]
    return _build_shares(build_days.groupBy(*by).agg(*[F.sum(c).alias(c) for c in BUILD_TOTALS]))


def _states() -> dict[str, tuple[Column, None]]:
    state = F.col("project_condition")
    return {
        "bulid_total": (state == RUNNING, None),
        "stop_total": (state == STOPPED, None),
        "complete_total": (state == COMPLETED, None),
    }


def status_day(project_days: DataFrame, billboards: str = "billboards") -> DataFrame:
    """County × day: projects by state, distinct companies, billboards, accounts. Rows are first
    reduced per company, so the distinct count needs no row expansion."""
    by = ["county_name", "year", "month", "day", "create_time"]
    rows = project_days.withColumn("county_name", null_bucket("county_name"))
    measures = {"project_total": (F.col("pid").isNotNull(), None), **_states()}
    measures["billboards"] = (F.lit(True), billboards)
    measures["account_total"] = (F.lit(True), "project_account_status")
    per_company = conditional_measures(rows, [*by, "cid"], measures)
    return per_company.groupBy(*by).agg(
        *[F.sum(m).alias(m) for m in measures], F.count("cid").alias("companys_sum")
    )


def _city_projects(project_days: DataFrame, city: str) -> DataFrame:
    return open_projects(project_days).where(F.col("city_code") == city)


def _project_sums(billboards: str) -> list[Column]:
    return [
        F.count("pid").alias("project_total"),
        *[count_if(cond).alias(n) for n, (cond, _) in _states().items()],
        F.sum(billboards).alias("billboards"),
        F.sum("real_amt").alias("real_amt"),
    ]


def _verified(labourers: DataFrame) -> DataFrame:
    rows = labourers.where((F.col("real_grade") != UNVERIFIED_GRADE) & live())
    return rows.agg(F.count("*").alias("realname_total"))


def city_snapshot_old(
    project_days: DataFrame, labourers: DataFrame, companies: DataFrame, as_of: dt.date, city: str,
    city_name: str,
) -> DataFrame:
    """One row per run: city totals; companies with and without a deposit over all projects."""
    ours = _city_projects(project_days, city).where(filled("response_code") & filled("create_user"))
    owners = project_days.select("cid", "assure_amt", "safeguard_status").distinct()
    registered = companies.where(
        live() & filled("businesslicense_code") & (F.col("status").cast("string") != "4")
    )
    row = attach_totals(
        ours.agg(*_project_sums("billboards")),
        owners.agg(
            count_if(F.col("safeguard_status") == 1).alias("is_ompanys_safeguard"),
            count_if(F.col("safeguard_status") == 0).alias("no_ompanys_safeguard"),
        ),
        _verified(labourers),
        registered.agg(F.count("*").alias("companys_total")),
    )
    return row.withColumns({"city_name": F.lit(city_name), "create_time": F.lit(as_of)})


def _global_totals(
    deposits: DataFrame, labourers: DataFrame, companies: DataFrame, special_accounts: DataFrame
) -> list[DataFrame]:
    per_company = valid_deposits(deposits).groupBy("cid").agg(F.sum("assure_amt").alias("amt"))
    approved = companies.where(live() & (F.col("status").cast("string") == "3"))
    accounts = special_accounts.where(live() & (F.col("status") == 1))
    return [
        per_company.agg(
            F.count("cid").alias("ompanys_safeguard_total"), F.sum("amt").alias("assure_amt")
        ),
        _verified(labourers),
        approved.agg(F.count("*").alias("companys_total")),
        accounts.agg(F.count("*").alias("account_total")),
    ]


def city_snapshot(
    project_days: DataFrame,
    deposits: DataFrame,
    labourers: DataFrame,
    companies: DataFrame,
    special_accounts: DataFrame,
    as_of: dt.date,
    city: str,
    city_name: str,
) -> DataFrame:
    """One row per run: city totals, companies with a deposit, deposit sum, accounts."""
    ours = _city_projects(project_days, city).where(filled("response_code") & filled("create_user"))
    row = attach_totals(
        ours.agg(*_project_sums("billboards")),
        *_global_totals(deposits, labourers, companies, special_accounts),
    )
    return row.withColumns({"city_name": F.lit(city_name), "create_time": F.lit(as_of)})


def county_snapshot(
    project_details: DataFrame,
    deposits: DataFrame,
    labourers: DataFrame,
    companies: DataFrame,
    special_accounts: DataFrame,
    as_of: dt.date,
    city: str,
) -> DataFrame:
    """County totals of the city with the global totals beside them."""
    rows = _city_projects(project_details, city).groupBy("county_code")
    out = attach_totals(
        rows.agg(*_project_sums("is_billboards")),
        *_global_totals(deposits, labourers, companies, special_accounts),
    )
    return out.withColumn("create_time", F.lit(as_of))


def project_list(project_details: DataFrame, city: str) -> DataFrame:
    """Open projects of the city."""
    return _city_projects(project_details, city).select(
        "pid", "cid", "company_name", "company_type", "response_code", "construct_cost", "status",
        "this_month_amt", "province_code", "city_code", "county_code", "labourers_count",
        "project_condition",
    )


def _company_labels(
    companies: DataFrame, deposits: DataFrame, special_accounts: DataFrame
) -> DataFrame:
    """Company × deposit × account rows with the label texts of the wide project report."""
    deposit = deposits.where(live()).select(
        "cid", F.col("status").alias("deposit_status"), "assure_amt"
    )
    account = special_accounts.where(live()).select("cid", F.col("status").alias("account_status"))
    rows = companies.select("cid", "company_type", "company_name")
    rows = rows.join(deposit.distinct(), "cid", "left").join(account.distinct(), "cid", "left")
    paid = F.when(F.col("deposit_status") == 3, PAID_LABEL).when(
        F.col("deposit_status") == 4, EXEMPT_LABEL
    )
    filed = F.col("account_status") == 1
    amount = F.coalesce("assure_amt", F.lit(0)).cast("string")
    return rows.select(
        "cid",
        "company_type",
        "company_name",
        F.coalesce(F.col("deposit_status").isin(3, 4), F.lit(False)).alias("is_pay"),
        F.coalesce(filed, F.lit(False)).alias("is_account"),
        F.concat(
            F.lit("["), paid.otherwise(UNPAID_LABEL), F.lit("]"), "company_name", F.lit("("),
            amount, F.lit(AMOUNT_UNIT + ")"),
        ).alias("deposit_label"),
        F.concat(
            F.lit("["), F.when(filed, FILED_LABEL).otherwise(UNFILED_LABEL), F.lit("]"),
            "company_name",
        ).alias("account_label"),
    )


def _group_columns() -> dict[str, tuple[Column, str]]:
    lists = {}
    for kind, group in COMPANY_GROUPS.items():
        mine = F.col("company_type") == kind
        pay, account = F.col("is_pay"), F.col("is_account")
        lists[f"{group}_company_safeguard_detail"] = (mine & pay, "deposit_label")
        lists[f"{group}_nopay_company_safeguard_detail"] = (mine & ~pay, "deposit_label")
        lists[f"{group}_company_account_detail"] = (mine & account, "account_label")
        lists[f"{group}_no_company_account_detail"] = (mine & ~account, "account_label")
    return lists


def project_detail(
    projects: DataFrame,
    sub_projects: DataFrame,
    companies: DataFrame,
    deposits: DataFrame,
    special_accounts: DataFrame,
    account_transfers: DataFrame,
    wages: DataFrame,
    employments: DataFrame,
    bank_accounts: DataFrame,
    billboards: DataFrame,
    devices: DataFrame,
    attachments: DataFrame,
    agreements: DataFrame,
    audits: DataFrame,
    batches: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Wide project row: the companies on the project and its sub-projects as label lists by
    company group, eight flags, head count, deposits, transfers and wages.

    The four company groups come from one aggregation. The label lists of a project hold the
    companies working on it, which the output row itself contains.
    """
    running = (F.col("project_condition") == RUNNING) & F.col("project_type").isin(*PROJECT_TYPES)
    own = open_projects(projects).where(running)
    own = own.select(F.col("pid").alias("source_pid"), "pid", "cid")
    below = sub_projects.where(F.col("status").isin(*OPEN_SUB_STATUSES) & live() & running)
    below = below.select("source_pid", "pid", F.col("unit_cid").alias("cid"))
    tree = own.union(below).distinct()
    on_project = tree.select("source_pid", "cid").distinct()
    nodes = tree.select("source_pid", "pid").distinct()

    # Label rows and fact rows of the companies side by side, so that the companies are joined
    # once. A company counts once per project, however many sub-projects it has.
    company_rows = _company_labels(companies, deposits, special_accounts).unionByName(
        _company_facts(deposits, special_accounts), allowMissingColumns=True
    )
    of_company = spread_join(on_project, company_rows, ["cid"], "inner", unique=["source_pid"])
    lists = of_company.groupBy(F.col("source_pid").alias("pid")).agg(
        *[
            F.sort_array(
                F.collect_set(F.when(F.col("company_type") == k, F.col("company_name")))
            ).alias(f"{g}_company_names")
            for k, g in COMPANY_GROUPS.items()
        ],
        *label_list(_group_columns(), "&"),
        *[count_if(F.col("company_type") == k).alias(f"_{g}") for k, g in COMPANY_GROUPS.items()],
        F.max("safeguard_status").alias("safeguard_status"),
        F.sum("assure_amt").alias("assure_amt"),
        F.max("project_account_status").alias("project_account_status"),
    )
    # A group without companies is NULL, not an empty list.
    for group in COMPANY_GROUPS.values():
        names = [f"{group}_company_names", *[c for c in _group_columns() if c.startswith(f"{group}_")]]
        lists = lists.withColumns({c: F.when(F.col(f"_{group}") > 0, F.col(c)) for c in names})
    lists = lists.drop(*[f"_{g}" for g in COMPANY_GROUPS.values()])

    moved = account_transfers.where(live() & (F.col("status") == 1)).select("pid", "amt")
    paid = wages.where(live() & (F.col("status") == 1)).select("pid", F.col("real_amt").alias("amt"))
    per_node = moved.unionByName(paid).groupBy("pid").agg(F.sum("amt").alias("amt"))
    all_amt = nodes.join(per_node, "pid").groupBy("source_pid").agg(money(F.sum("amt")).alias("all_amt"))
    staff = employments.where(F.col("is_job") & live() & F.col("lid").isNotNull())
    staff = staff.select(F.col("source_pid").alias("pid"), "lid").distinct()
    staff = staff.groupBy("pid").agg(F.count("*").alias("labourers_count"))
    this_month = F.sum(F.when(same_year_month("year", "month", as_of), F.col("real_amt")))

    rows = _dated(
        projects.select(
            "pid", "cid", "project_name", "response_code", "principal_empid", "build_area",
            "construct_cost", "project_type", "status", "project_condition", "create_user",
            "is_deleted", "province_code", "city_code", "county_code", "create_time",
        )
    )
    rows = add_names(rows, companies, "cid", "cid", "company_name", "company_type")

    def reached(frame: DataFrame) -> DataFrame:
        """Parent projects of the nodes listed in ``frame``."""
        return nodes.join(frame.select("pid"), "pid", "left_semi")

    hit = F.lit(True)
    shown = devices.where((F.col("isdelete") == "N") & F.col("is_show"))
    signed = attachments.where(live() & any_filled(*CONTRACTS))
    agreed = _audited(agreements.where(live()), audits, AGREEMENT_AUDIT)
    rows = add_flags(
        rows,
        "pid",
        [
            (employments.where(live()), "source_pid", {"is_realname": hit}),
            (reached(bank_accounts.where(live())), "source_pid", {"is_bank_account": hit}),
            (billboards.where(live()), "pid", {"is_billboards": hit}),
            (reached(shown), "source_pid", {"is_attendance": hit}),
            (reached(signed), "source_pid", {"contract_status": hit}),
            (reached(agreed), "source_pid", {"is_agreement": hit}),
        ],
    )
    rows = add_measures(
        rows,
        "pid",
        lists,
        staff,
        all_amt.withColumnRenamed("source_pid", "pid"),
        _paid_wages(batches, this_month.alias("this_month_amt")),
    )
    zero = (
        "labourers_count", "all_amt", "safeguard_status", "assure_amt", "project_account_status",
        "real_amt", "this_month_amt",
    )
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})
