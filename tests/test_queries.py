"""Every registered query against its SQL oracle on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as contract
from labwh.demo import all_oracles, all_queries
from labwh.demo.compare import differences, oracle_connection
from labwh.demo.tables import Tables
from tests.helpers import plan_text

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no generated tables")


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_agrees_with_its_oracle(spark, duck, name):
    df = all_queries()[name](Tables(spark, FOLDER))
    plan = plan_text(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert differences(df, duck, all_oracles()[name]) is None


@pytest.mark.parametrize(
    "name",
    [
        "customer_order_history_rank", "bank_rank", "project_bank_rank", "salary_detail_rank",
        "swipe_in_validity", "report_labourer_history", "report_resume_detail",
        "report_project_day", "report_rule_scores", "report_area_statistics",
    ],
)
def test_query_agrees_when_every_key_counts_as_hot(spark, duck, name):
    spark.conf.set("spark.labwh.hotRows", "3")
    try:
        df = all_queries()[name](Tables(spark, FOLDER))
        assert differences(df, duck, all_oracles()[name]) is None
    finally:
        spark.conf.unset("spark.labwh.hotRows")


def test_contract(spark):
    # The optional part may add queries, some of which SQL cannot express.
    assert set(all_queries()) == set(all_oracles()) <= set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns[:4] == ["county_name", "year", "month", "project_total"]
    assert flagship.limit(1).count() == 1
