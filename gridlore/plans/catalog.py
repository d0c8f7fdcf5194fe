"""All registered queries."""

from gridlore.plans import fact_queries, model_queries, page_queries, scalar_queries, state_queries, stats_queries, storage_queries  # noqa: F401
from gridlore.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
