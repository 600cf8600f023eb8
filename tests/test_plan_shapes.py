"""Physical plans: one scan where one is enough, filters and columns down in the scan."""

import pathlib

import pytest
from pyspark.sql import functions as F

from labwh.demo import all_queries, ranking_queries
from labwh.demo.report_attendance import AS_OF_SWIPES
from labwh.demo.roles import Roles
from labwh.demo.tables import Tables
from labwh.plans import apilogs, attendance
from tests.helpers import plan_text

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no generated tables")


def plan(spark, name):
    return plan_text(all_queries()[name](Tables(spark, FOLDER)))


def scans(text, table):
    return sum("FileScan" in x and f"/{table}.parquet" in x for x in text.splitlines())


@pytest.mark.parametrize(
    "name, table, count",
    [
        ("attendance_pairs", "events", 1),
        ("build_type_day", "orders", 1),
        ("project_flags", "lineitem", 3),
        ("six_rule_scores", "lineitem", 3),
        ("resume_detail", "lineitem", 1),
        ("cumulative_metrics_12m", "lineitem", 2),
        ("salary_area_vs_last_month", "orders", 1),
        ("device_totals_unit", "orders", 1),
        ("sum_once_per_owner", "orders", 1),
        ("json_log_counts", "events", 1),
    ],
)
def test_scans(spark, name, table, count):
    assert scans(plan(spark, name), table) == count


@pytest.mark.parametrize(
    "name, column",
    [
        ("incremental_scan", "ts"),
        ("swipe_month_distinct", "ts"),
        ("swipes_of_day", "ts"),
        ("project_month_income", "o_orderdate"),
        ("fee_share_last_month", "o_orderdate"),
    ],
)
def test_time_filters_reach_the_scan(spark, name, column):
    pushed = [x.split("PushedFilters: [")[1].split("]")[0] for x in plan(spark, name).splitlines() if "PushedFilters: [" in x]
    assert any(f"GreaterThan({column}" in x or f"GreaterThanOrEqual({column}" in x for x in pushed)


def test_columns_are_pruned(spark):
    text = plan(spark, "distinct_pairs_count")
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


def test_latest_row_limits_groups_before_the_shuffle(spark):
    text = plan(spark, "latest_order_per_customer")
    assert text.count("WindowGroupLimit") == 2


def test_totals_beside_rows_need_no_window_over_everything(spark):
    text = plan(spark, "onjob_share")
    assert "Window [sum" not in text and "Subquery" in text


def test_project_attendance_opens_two_months_only(spark, tmp_path):
    r = Roles(Tables(spark, FOLDER))
    path = str(tmp_path / "swipes")
    dated = r.swipes.withColumns({"date_year": F.year("record_time"), "date_month": F.month("record_time")})
    dated.write.partitionBy("date_year", "date_month").parquet(path)
    stored = spark.read.parquet(path)
    out = attendance.project_attendance(stored, r.devices, r.projects, AS_OF_SWIPES)
    scanned = [x for x in plan_text(out).splitlines() if "FileScan" in x and "/swipes" in x]
    assert scanned and all("PartitionFilters: []" not in x and "date_month" in x.split("PartitionFilters")[1] for x in scanned)
    whole = attendance.project_attendance(r.swipes, r.devices, r.projects, AS_OF_SWIPES)
    assert out.count() == whole.count() > 0


def test_time_filter_reaches_the_scan_of_a_stored_input(spark):
    # A ranking stores its input first, so the filter is in the plan of that input.
    text = plan_text(ranking_queries.bank_sums(Tables(spark, FOLDER)))
    assert any("l_shipdate" in x.split("PushedFilters: [")[1].split("]")[0] for x in text.splitlines() if "PushedFilters: [" in x)


def test_validity_is_one_scan_and_one_shuffle_of_the_stored_swipes(spark):
    text = plan(spark, "swipe_in_validity")
    assert scans(text, "events") == 0 and text.count("FileScan") == 2 and "Join" not in text


@pytest.mark.parametrize(
    "name, table",
    [("report_salary_total", "orders"), ("report_monthly_metrics", "lineitem"), ("report_platform_totals_year", "lineitem"),
     ("report_onjob_share", "lineitem"), ("report_company_area_totals", "orders")],
)
def test_shared_details_are_read_instead_of_made_again(spark, name, table):
    assert scans(plan(spark, name), table) == 0


def test_json_text_is_parsed_once_per_row(spark):
    text = plan_text(apilogs.api_calls(Roles(Tables(spark, FOLDER)).api_log))
    assert text.lower().count("parsejson") == 1 and "get_json_object" not in text


def test_wage_lines_are_numbered_without_what_their_batch_shares(spark):
    found = [x for x in plan(spark, "report_salary_detail").splitlines() if "FileScan" in x and "salary-lines" in x]
    assert found and not any("project_name" in x for x in found)
