"""Report rules on small hand-made tables: month edges, fan-out, missing sides."""

import datetime as dt

import pytest

from labwh.plans import attendance, companies, compliance, labourers, projects, salary
from tests.helpers import day, rows, ts

AS_OF = day("2020-06-20")
HOUSE = "房屋建设工程"


def project_table(spark, *pids):
    data = [
        (p, 1, f"P{p}", HOUSE, 1, 3, 1, "R", 5, 1.0, 10.0, "u", ts("2020-05-05 00:00:00"), "33", "3303", "330302", 1, 2, 10, "N", "N")
        for p in pids
    ]
    return spark.createDataFrame(
        data,
        "pid int, cid int, project_name string, project_type string, project_condition int, status int,"
        "is_deleted int, response_code string, principal_empid int, build_area double,"
        "construct_cost double, create_user string, create_time timestamp_ntz, province_code string,"
        "city_code string, county_code string, industry_type int, investment_nature int, pay_day int,"
        "is_completed string, is_lock string",
    )


def test_income_on_month_edges(spark):
    transfers = spark.createDataFrame(
        [
            (1, 1, 1, 1, ts("2020-02-01 00:00:00"), 5), (1, 1, 1, 1, ts("2020-02-29 23:59:59"), 6),
            (1, 1, 1, 1, ts("2020-03-01 00:00:00"), 7), (1, 1, 1, 0, ts("2020-02-02 00:00:00"), 50),
            (1, 2, 1, 1, ts("2020-02-02 00:00:00"), 60), (1, 1, 2, 1, ts("2020-02-02 00:00:00"), 70),
            (2, 1, 1, 1, ts("2020-03-02 00:00:00"), -3),
        ],
        "pid int, jtype int, is_deleted int, is_pro_valid int, trans_time timestamp_ntz, amt int",
    )
    months = [day("2020-02-01"), day("2020-03-01")]
    got = compliance.income_months(project_table(spark, 1, 2), transfers, months, AS_OF)
    assert rows(got, "id", "amt", "status", "date_year", "date_month") == [
        ("1202002", 11, 3, 2020, 2), ("1202003", 7, 3, 2020, 3),
        ("2202002", 0, 1, 2020, 2), ("2202003", -3, 1, 2020, 3),
    ]
    one = compliance.income_months(project_table(spark, 1), transfers, months[:1], AS_OF, only_valid=False)
    assert rows(one, "amt") == [(61,)]


def score(spark, batches, deposits, subs=(), commissions=(), city="3303"):
    def table(data, schema):
        return spark.createDataFrame(list(data), schema)

    org = table([(1, "C", 1, "O1"), (2, "D", 1, "O2")], "cid int, company_name string, is_deleted int, organization_code string")
    empty = "pid int, jtype int, is_deleted int, is_pro_valid int, trans_time timestamp_ntz, amt int"
    return compliance.rule_scores(
        project_table(spark, 1), org,
        table([(1, "a", True, 1)], "source_pid int, id_card_no string, is_job boolean, is_deleted int"),
        table(deposits, "cid int, province_code string, city_code string, status int, is_deleted int"),
        table([(1, 1, 1)], "pid int, status int, is_deleted int"),
        table([(1, 1, 1, 1, ts("2020-05-31 10:00:00"), 4)], empty),
        table([(1, 2, 1)], "pid int, sg_cid int, is_deleted int"),
        table([], "pid int"),
        table(subs, "source_pid int, unit_cid int, status int, is_deleted int"),
        table(commissions, "pid int, subcontract_company_organization_code string, is_deleted int"),
        table(batches, "source_pid int, year int, month int, status int, is_deleted int"),
        AS_OF, city,
    ).collect()[0]


def test_scores(spark):
    # Pay day 10 falls due on the 15th; on the 20th, May is judged.
    got = score(spark, [(1, 2020, 5, 1, 1)], [(1, "33", "3303", 3, 1), (1, "33", "3303", 4, 1)])
    assert (got.real_pay_status, got.real_status, got.bail_status) == (3, 3, 3)
    assert (got.account_in_status, got.account_status, got.billboard_status) == (3, 3, 1)
    # No sub-project and no commission: the wage rule alone decides.
    assert (got.proxy_pay_islw, got.proxy_pay_entrustl_status, got.proxy_pay_status) == (0, 1, 3)
    april = score(spark, [(1, 2020, 4, 1, 1)], [(1, "33", "", 3, 1)])
    assert (april.real_pay_status, april.real_status, april.bail_status) == (1, 1, 1)


def test_entrusting_every_subcontractor(spark):
    subs = [(1, 1, 3, 1), (1, 2, 4, 1), (1, 2, 5, 1)]
    paid = [(1, 2020, 5, 1, 1)]
    some = score(spark, paid, [], subs, [(1, "O1", 1), (1, "O1", 1), (1, "O2", 2)])
    assert (some.proxy_pay_islw, some.proxy_pay_entrustl_status, some.proxy_pay_status) == (1, 4, 1)
    every = score(spark, paid, [], subs, [(1, "O1", 1), (1, "O2", 1)])
    assert (every.proxy_pay_entrustl_status, every.proxy_pay_status) == (3, 3)
    more = score(spark, paid, [], subs, [(1, "O1", 1), (1, "O2", 1), (1, "O3", 1)])
    assert more.proxy_pay_entrustl_status == 3
    none = score(spark, paid, [], subs)
    assert (none.proxy_pay_islw, none.proxy_pay_entrustl_status) == (1, 1)
    elsewhere = score(spark, paid, [], subs, [(1, "O1", 1)], city="9999")
    assert (elsewhere.proxy_pay_islw, elsewhere.proxy_pay_entrustl_status) == (1, 3)


def wide(spark, deposits):
    def table(data, schema):
        return spark.createDataFrame(list(data), schema)

    subs = [(100 + i, 1, 1, HOUSE, 3, 1, 1) for i in range(3)]
    return projects.project_detail(
        project_table(spark, 1, 2),
        table(subs, "pid int, source_pid int, unit_cid int, project_type string, status int, is_deleted int, project_condition int"),
        table([(1, "C", 2)], "cid int, company_name string, company_type int"),
        table(deposits, "cid int, status int, assure_amt decimal(15,2), is_deleted int"),
        table([(1, 1, 1)], "cid int, status int, is_deleted int"),
        table([(1, 10, 1, 1), (101, 5, 1, 1)], "pid int, amt int, status int, is_deleted int"),
        table([], "pid int, real_amt int, status int, is_deleted int"),
        table([(7, 1, True, 1), (7, 1, True, 1)], "lid int, source_pid int, is_job boolean, is_deleted int"),
        table([(102, 1)], "pid int, is_deleted int"),
        table([(1, 1), (1, 1)], "pid int, is_deleted int"),
        table([(100, "N", True)], "pid int, isdelete string, is_show boolean"),
        table([], "pid int, contract1 string, contract2 string, contract3 string, contract4 string, contract5 string, is_deleted int"),
        table([], "pid int, is_deleted int"),
        table([], "bus_id int, status int, type int, is_deleted int"),
        table([], "source_pid int, year int, month int, real_amt int, status int, type int, is_deleted int"),
        AS_OF,
    )


def test_a_deposit_counts_once_for_a_project_with_sub_projects(spark):
    from decimal import Decimal

    got = wide(spark, [(1, 3, Decimal("12.50"), 1), (1, 4, Decimal("1.00"), 1), (1, 1, Decimal("9.00"), 1)])
    one = {r.pid: r for r in got.collect()}[1]
    assert got.count() == 2
    assert float(one.assure_amt) == 13.5
    assert float(one.all_amt) == 15.0
    assert (one.labourers_count, one.is_bank_account, one.is_attendance, one.is_billboards) == (1, 1, 1, 1)
    assert one.construction_company_names == ["C"] and one.epc_company_names is None
    assert one.construction_company_safeguard_detail == "[免缴]C(1.00万元)&[在缴]C(12.50万元)"
    assert one.construction_nopay_company_safeguard_detail == "[未缴]C(9.00万元)"
    assert one.construction_company_account_detail == "[已备案]C"
    assert one.construction_no_company_account_detail == ""


RESUME = "lab_top int, is_job int, job_date date, job_end_date date, nativeplace_id string, project_city_code string, project_county_code string, id_card_no string, pid int, project_name string, project_province_code string"


def test_platform_totals_keep_missing_origins_apart(spark):
    data = [
        (1, 1, day("2020-01-01"), None, None, "c", "x", "a", 1, "P", "p"),
        (2, 0, day("2019-01-01"), day("2020-06-19"), None, "c", "x", "a", 1, "P", "p"),
        (1, 1, AS_OF, None, "1", "c", "x", "b", 1, "P", "p"),
        (2, 0, day("2019-01-01"), day("2020-06-18"), "1", "c", "x", "b", 1, "P", "p"),
        (2, 0, day("2019-01-01"), day("2020-06-19"), "2", "c", "y", "b", 1, "P", "p"),
    ]
    df = spark.createDataFrame(data, RESUME)
    cols = ("nativeplace_id", "project_county_code", "labourer_total", "onjob_total", "offjob_total")
    assert rows(attendance.platform_totals(df, AS_OF, "day"), *cols) == [
        (None, "x", 0, 0, 1), (None, "x", 1, 1, 0), ("1", "x", 1, 0, 0), ("2", "y", 0, 0, 1),
    ]
    assert rows(attendance.platform_totals(df, AS_OF, "month"), *cols)[2] == ("1", "x", 1, 0, 1)
    assert len(rows(attendance.platform_totals(df, AS_OF, "year"), *cols)) == 2
    assert rows(attendance.project_totals(df, AS_OF, "day"), "id", "labourer_total", "on_job_count", "off_job_count") == [
        ("120200619", 1, 0, 1), ("120200619", 4, 2, 1),
    ]


def test_device_totals_on_the_first_of_a_month(spark):
    # The report of 1 June is about 31 May.
    as_of = day("2020-06-01")
    data = [
        ("x", "s1", "中控", "N", 1, 1, day("2020-05-31"), day("2020-05-31")),
        ("x", "s1", "海康", "N", 0, 1, day("2020-04-01"), day("2020-05-01")),
        ("x", "s2", "中控", "N", 0, 0, day("2020-06-01"), day("2020-06-01")),
        ("x", "s3", "中控", "Y", 0, 0, day("2019-06-01"), day("2020-05-31")),
    ]
    details = spark.createDataFrame(data, "county_code string, sn string, dev_manufacturer string, isdelete string, day_status int, month_status int, create_time date, last_modify_time date")
    areas = spark.createDataFrame([("x", "X", "c"), ("y", "Y", "c"), ("z", "Z", "d")], "code string, name string, parent_code string")
    got = attendance.device_totals(details, areas, as_of, "day", "c")
    cols = ("id", "sn_total_count", "sn_online_count", "zk_sn_count", "hk_sn_count", "sn_install_count", "sn_dismantle_count")
    assert rows(got, *cols) == [("x20200531", 1, 1, 1, 1, 1, 1), ("y20200531", 0, 0, 0, 0, 0, 0)]
    month = attendance.device_totals(details, areas, as_of, "month", "c")
    assert rows(month, *cols)[0] == ("x202005", 1, 2, 1, 1, 1, 1)


def test_company_without_projects_keeps_its_first_rank(spark):
    schema = "cid int, company_name string, province_code string, city_code string, county_code string, company_type int, create_time date, checked_time date, register_capital int, is_location int, is_deleted int, status int"
    coms = spark.createDataFrame([(i, f"C{i}", "33", "3303", "x", 1, day("2020-01-02"), day("2020-01-02"), 1, i, 1, 3) for i in (1, 2, 3)], schema)
    types = spark.createDataFrame([(1, "建设集团")], "code int, name string")
    got = companies.company_areas(coms, project_table(spark, 5), types)
    assert rows(got, "cid", "project_county_code", "rank") == [(1, "330302", 1), (2, None, 1), (3, None, 1)]
    areas = spark.createDataFrame([("x", "X", "3303", 1)], "code string, name string, parent_code string, is_deleted int")
    days = companies.company_days(got, areas, "3303")
    assert rows(days, "county_code", "day", "xz_companys_sum", "company_build_count", "xz_other", "yw_companys_sum") == [("x", 2, 3, 3, 1, None)]


@pytest.mark.parametrize("month", ["2020-05-01", "2020-05-15"])
def test_payroll_counts_people_once(spark, month):
    months = [day(month)]
    spans = spark.createDataFrame([(1, "a", day("2020-01-01"), day("2999-01-01"), 1), (1, "a", day("2020-05-09"), day("2020-05-10"), 1), (9, "b", day("2020-05-01"), day("2020-05-10"), 1)], "source_pid int, id_card_no string, starttime date, endtime date, is_deleted int")
    batches = spark.createDataFrame([("B1", 1, 2020, 5, 1, 1, 40), ("B2", 1, 2020, 5, 1, 1, 2), ("B3", 1, 2020, 5, 6, 1, 9)], "batch_no string, source_pid int, year int, month int, status int, is_deleted int, real_amt int")
    wages = spark.createDataFrame([("B1", "a", 1, 1), ("B2", "a", 1, 1), ("B2", "c", 1, 1), ("B3", "d", 1, 1)], "batch_no string, id_card_no string, status int, is_deleted int")
    got = compliance.payroll_months(project_table(spark, 1, 2), spans, batches, wages, months, AS_OF)
    assert rows(got, "pid", "real_count", "pay_count", "amt", "status") == [(1, 1, 2, 42, 3), (2, 0, 0, 0, 1)]


def test_worker_bands_and_history(spark):
    history = spark.createDataFrame(
        [(i, 1, 1, 1, 3, "男", a) for i, a in enumerate([14, 15, 49, 50, 70])] + [(9, 2, 1, 1, 3, "女", 30), (8, 1, 0, 1, 99, "女", 30)],
        "lid int, top int, is_job int, is_deleted int, real_grade int, gender string, age int",
    )
    got = labourers.labourer_totals(history, AS_OF).collect()[0]
    assert (got.labourer_total, got.man_total, got.woman_total) == (5, 5, 0)
    assert (got.age_dist_one, got.age_dist_seven, got.age_dist_eight) == (1, 1, 2)


def test_metrics_stop_before_the_cutoff_day(spark):
    deposits = spark.createDataFrame([(1, day("2020-06-19"), 5, 3, 1), (1, day("2020-06-20"), 5, 4, 1), (2, day("2020-05-20"), 7, 3, 1), (3, day("2019-01-01"), 9, 3, 1)], "cid int, reg_date date, assure_amt int, status int, is_deleted int")
    subs = spark.createDataFrame([(2, HOUSE, 3, 1)], "unit_cid int, project_type string, status int, is_deleted int")
    details = spark.createDataFrame([(day("2020-05-01"), 1, 1, 1, "a", 25000), (day("2020-04-01"), 2, 1, 1, "b", 4000)], "year_month date, salary_cid int, source_pid int, status int, id_card_no string, real_amt int")
    got = salary.monthly_metrics(project_table(spark, 1), subs, deposits, details, AS_OF, offsets=2)
    value = {(r.month, r.type): r.amount for r in got.collect()}
    assert (value[6, 1], value[5, 1]) == (2, 0)
    assert (value[5, 2], value[6, 2]) == (7, 17)
    assert (value[6, 3], value[5, 3]) == (2, 2) and value[6, 6] == 2
    assert isinstance(AS_OF, dt.date)
