"""Registered queries over the provided tables, each beside the SQL it must agree with."""

from __future__ import annotations

import importlib

from tallyframe.plans.registry import QUERIES, Query

MODULES = ("scans_filters", "projections", "labels", "joining", "grouping", "scalars", "documents", "loads", "stored_tables", "jobs_credit", "jobs_deposits", "jobs_people", "jobs_channels", "jobs_ledger", "jobs_applications")


def all_queries() -> dict[str, Query]:
    for name in MODULES:
        importlib.import_module(f"tallyframe.plans.{name}")
    return QUERIES
