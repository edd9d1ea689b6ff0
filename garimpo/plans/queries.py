"""All registered queries and their reference SQL."""

from garimpo.plans import page_queries, table_queries  # noqa: F401  (register on import)
from garimpo.plans.registry import ORACLES, QUERIES
from garimpo.plans.table_queries import flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
