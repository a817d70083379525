"""Role views over the given tables and the registered queries."""

from loanlens.plans import metric_queries, model_queries, profile_queries, table_queries
from loanlens.plans.registry import QUERIES

__all__ = ["QUERIES", "metric_queries", "model_queries", "profile_queries", "table_queries"]
