"""Query catalogue and the DuckDB oracle SQL for each query."""

from footfall.plans.catalogue import catalogue
from footfall.plans.oracle import oracle_queries

__all__ = ["catalogue", "oracle_queries"]
