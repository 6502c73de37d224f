"""One runnable query per operator, each with an equivalent SQL statement."""

from shelfmark.plans import (  # noqa: F401  (importing registers the queries)
    catalog_queries,
    grant_queries,
    report_queries,
    streaming_queries,
    tag_queries,
    transfer_queries,
)
from shelfmark.plans.registry import QUERIES

__all__ = ["QUERIES"]
