"""Jobs over the given tables: views, queries and their SQL twins."""

from peerglass.plans import record_queries, screening_queries, text_queries  # noqa: F401
from peerglass.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
