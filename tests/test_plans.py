"""What must hold for the physical plans at any scale."""

import re

import pytest

from tallyframe.plans import all_queries, jobs_credit
from tallyframe.sources.tables import Tables
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def plans(spark, folder):
    names = (
        "latest_per_key", "first_per_key", "apply_top1", "overlapping_branch_union", "dedupe_by_key",
        "filter_conjunction", "filter_yesterday", "filter_like_prefix", "conditional_sum", "load_current_view",
    )
    return {name: plan_of(all_queries()[name](spark, folder)) for name in names}


def test_one_row_per_key_is_limited_before_the_shuffle(plans):
    for name in ("latest_per_key", "first_per_key", "apply_top1", "overlapping_branch_union", "dedupe_by_key"):
        assert re.search(r"row_number\(\), 1, Partial", plans[name]), name


def test_filters_and_columns_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plans["filter_conjunction"])
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", plans["filter_yesterday"])
    assert re.search(r"PushedFilters: \[.*LessThan\(ts", plans["filter_yesterday"])
    assert "StringStartsWith" in plans["filter_like_prefix"]
    read = re.search(r"ReadSchema: struct<([^>]*)>", plans["conditional_sum"]).group(1)
    assert "l_suppkey" in read and "l_shipdate" not in read and "l_partkey" not in read


def test_nothing_is_broadcast_by_hint():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "tallyframe"
    uses = [(p.name, line) for p in root.rglob("*.py") if "llm" not in p.parts for line in p.read_text().splitlines() if "F.broadcast(" in line]
    assert not uses


def test_snapshot_view_prunes_partitions(plans):
    assert re.search(r"PartitionFilters: \[.*as_of", plans["load_current_view"])


def test_hot_key_is_split_by_adaptive_execution(spark):
    """A key with half of all rows: the lookup splits it among tasks."""
    from pyspark.sql import functions as F

    from tallyframe.operators.joins import lookup

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 400000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("pad")
        )
        keys = spark.range(0, 400000).select(F.col("id").alias("rk"), F.sha1(F.col("id").cast("string")).alias("w"))
        df = lookup(rows, keys, {"k": "rk"})
        assert df.filter("w is not null").count() == 400000
        done = df.agg(F.max("pad"), F.max("w"))
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(("name", "table", "most"), [
    ("loan_originations", "lineitem", 2), ("job_portfolio_aging", "lineitem", 1), ("job_portfolio_aging", "orders", 3),
    ("job_portfolio_history", "lineitem", 2), ("job_vendors", "lineitem", 1),
])
def test_passes_over_a_table(spark, folder, name, table, most):
    made = all_queries()[name](spark, folder) if name in all_queries() else getattr(jobs_credit, name)(Tables(spark, folder))
    plan = plan_of(made)
    assert 1 <= len(re.findall(rf"Location: .*/{table}\.parquet", plan)) <= most


def test_lines_of_the_history_move_as_narrow_rows_and_once(spark, folder):
    """Neither their totals per office nor the people of their credits shuffle the lines again, and no wide entry is shuffled."""
    plan = plan_of(all_queries()["job_portfolio_history"](spark, folder))
    moved = [x.split("\n\n")[0] for x in re.split(r"\n\(\d+\) Exchange\n", plan)[1:]]
    assert not any(re.search(r"hashpartitioning\(l_orderkey#\d+L?, l_suppkey", x) for x in moved)
    assert not any("balance_before" in x for x in moved) and sum("l_suppkey" in x.split("Arguments")[0] for x in moved) == 2


@pytest.mark.parametrize(("name", "column"), [("date_key_join", "y"), ("threshold_segment_by_year", "y"), ("theta_range_on", "p_brand")])
def test_facts_are_not_shuffled_on_few_values(spark, folder, name, column):
    plan = plan_of(all_queries()[name](spark, folder))
    assert not re.search(rf"hashpartitioning\({column}#", plan) and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["job_application_income", "job_application_base", "job_agreements", "job_application_wide"])
def test_building_the_plan_only_reads_the_tables_schema(spark, folder, name):
    context = spark.sparkContext
    context.setJobGroup(f"plan of {name}", "")
    try:
        all_queries()[name](spark, folder)
        assert len(context.statusTracker().getJobIdsForGroup(f"plan of {name}")) <= 1  # the footer of one table
    finally:
        context.setJobGroup("tests", "")


def test_wide_table_fills_every_column(spark, folder):
    rows = all_queries()["job_application_wide"](spark, folder).collect()
    assert all(any(r[c] for r in rows) for c in rows[0].asDict())
