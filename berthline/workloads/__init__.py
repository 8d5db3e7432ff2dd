"""Registered queries over the driver's tables."""

from berthline.workloads import landed_queries, listing_queries, metric_queries, table_queries  # noqa: F401
from berthline.workloads.registry import oracle as all_oracle_sql
from berthline.workloads.registry import plans as all_queries

__all__ = ["all_oracle_sql", "all_queries"]
