"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from crewspark.operators import analytics as A
from crewspark.session import scratch_path
from crewspark.sources import tables as TB
from crewspark.sources.fixtures import Workforce
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df) -> str:
    # include subqueries and the adaptive plan's initial form
    return df._jdf.queryExecution().toString()


REPORTS = ["top_performers", "domain_skill_experts", "cost_per_role", "comprehensive_view", "upsert_projects",
           "version_diff", "enrich_avg_performance", "cost_histogram", "project_count_per_employee",
           "table_profile", "candidate_scores", "project_fit", "budget_heuristic", "parse_brief_json"]


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_product(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    p = full_plan(df)
    assert "CartesianProduct" not in p, name


@pytest.mark.parametrize("name", ["top_performers", "domain_skill_experts", "cost_per_role", "comprehensive_view",
                                  "upsert_projects", "version_diff", "enrich_avg_performance", "cost_histogram",
                                  "project_count_per_employee", "table_profile", "parse_brief_json"])
def test_reports_stay_in_the_jvm(spark, name):
    p = full_plan(entry.queries()[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "FlatMapCoGroupsInPandas" not in p


def test_scan_reads_only_needed_columns(spark):
    wf = Workforce(spark, SF_SMALL)
    p = plan(A.top_performers(wf.employees, wf.projects))
    # the history table is read for the three columns the report needs
    assert "ReadSchema: struct<ProjectID:bigint,EmployeeID:bigint,Individual_Performance_Score:double>" in p
    assert "Tech_Stack_Used" not in p


def test_partition_filter_on_domain(spark):
    wf = Workforce(spark, SF_SMALL)
    p = plan(A.domain_projects(wf.projects, "Finance"))
    assert "PartitionFilters: [isnotnull(Domain" in p and "= Finance)" in p
    path = scratch_path(spark, "plan-projects")
    TB.write_partitioned(wf.projects, path, "Domain")
    p = plan(A.domain_projects(spark.read.parquet(path), "Finance"))
    assert "PartitionFilters: [isnotnull(Domain" in p


def test_filter_pushed_to_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").where(F.col("s_suppkey") > 5).select("s_name")
    assert "PushedFilters: [IsNotNull(s_suppkey), GreaterThan(s_suppkey,5)]" in plan(df)


def test_top_k_uses_window_group_limit_or_take_ordered(spark):
    p = plan(entry.queries()["top_performers"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    p = full_plan(entry.queries()["similar_tech_topn"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p
