"""All registered queries; importing a module registers what it defines."""

from tidewatch.plans import row_queries, state_queries, stream_queries, window_queries  # noqa: F401
from tidewatch.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
