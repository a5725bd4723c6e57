"""All registered queries and their SQL."""

from millrace.plans import cat_aggregates, cat_functions, cat_rules, cat_sources, cat_stats, cat_text  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
