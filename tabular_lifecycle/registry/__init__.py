"""All registered queries; importing the modules fills the book."""

from . import boost_queries, column_queries, group_queries, model_queries, monitor_queries, sample_queries, stump_queries, table_queries  # noqa: F401
from .book import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
