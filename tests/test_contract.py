"""Registered queries against their SQL, and the shape of the main plans."""

import re

import compare
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


LLM = {name for name in contract.queries() if re.match(r"op\d|pipeline", name)}  # tested with their subpackage


def test_every_query_has_its_sql():
    assert set(contract.queries()) - LLM == set(contract.oracle_sql()) - LLM


@pytest.mark.parametrize("name", [name for name in contract.queries() if name not in LLM])
def test_query_equals_sql(spark, con, name):
    assert compare.differences(spark, con, SF_DIR, name) == []


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_needs_one_shuffle_per_key(spark):
    text = plan(contract.queries()["m0_staging"](spark, SF_DIR))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 3


def test_canonical_names_cost_no_shuffle(spark):
    text = plan(contract.queries()["m0_offer_tech"](spark, SF_DIR))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3


@pytest.mark.parametrize("name", ["m1_demand", "m2_salaries", "m3_trend", "m4_coverage", "r1_kpis"])
def test_products_stay_in_the_jvm_and_prune_columns(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert not re.search(r"Python|InPandas|CartesianProduct|BroadcastNestedLoopJoin", text)
    assert "c_name" not in text


@pytest.mark.parametrize("name", ["m1_demand", "m4_coverage", "r2_ranking", "r3_mode_split"])
def test_replies_are_parsed_once(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"reply#?\S* .*from_json|from_json\(StructField\(reply", final)) <= 1


@pytest.mark.parametrize("name", ["m2_salaries", "r1_kpis", "r5_salary_summary", "j3_counts_and_totals"])
def test_reports_over_written_tables_read_no_raw_offers(spark, name):
    """What is read more than once was written first, so nothing of staging is left in the plan."""
    assert "orders.parquet" not in plan(contract.queries()[name](spark, SF_DIR))
