"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from tallyframe.llm import queries  # noqa: F401  registers them
from tallyframe.llm.registry import QUERIES, SQL


def all_queries():
    return QUERIES | {"pipeline": corpus_pipeline.run}


def all_sql() -> dict[str, str]:
    return dict(SQL)
