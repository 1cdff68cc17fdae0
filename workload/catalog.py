"""All registered queries (importing a query module registers its queries)."""

from workload import q_clean, q_models, q_runs, q_sources, q_tables  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
