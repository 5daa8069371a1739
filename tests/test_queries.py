"""Every registered query: its result against its SQL in DuckDB, and what must hold for
every physical plan at any scale."""

import os
import re

import pytest

import __spark_entry__ as entry_module
from tallyframe.plans import all_queries
from tests.conftest import plan_of
from tools.compare import compare, tables_in_duckdb

NAMES = list(all_queries())
#: Queries that look for what the tables do not have.
EMPTY = {"duplicate_order_keys"}


def check_plan(df):
    """No cross join, no Python rows, and no window that is not limited before its shuffle."""
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    windows = re.findall(r"^\(\d+\) Window\b(?!Group)", plan, flags=re.M)
    assert len(windows) == len(re.findall(r"row_number\(\), 1, Final", plan))


@pytest.fixture(scope="module")
def duck(folder):
    return tables_in_duckdb(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, folder, name):
    ok, note = compare(spark, duck, all_queries()[name], folder, check_plan)
    assert ok or (name in EMPTY and note.startswith("0 rows")), note


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).columns[:2] == ["n_name", "c_mktsegment"]


def test_query_names_are_plain():
    assert not any(n.startswith(("op", "pipeline")) and n[2:3].isdigit() for n in NAMES)
    assert os.path.exists(os.path.join(os.path.dirname(entry_module.__file__), "bench.py"))
