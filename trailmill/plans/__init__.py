"""Named queries and the SQL each one must equal."""

from __future__ import annotations

from trailmill.plans import (  # noqa: F401
    explore_queries,
    model_queries,
    recommend_queries,
    sequence_queries,
)
from trailmill.plans.registry import QUERIES, SQL


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(SQL)
