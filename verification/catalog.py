"""All registered queries."""

from verification import (  # noqa: F401
    fx_queries,
    import_queries,
    lookup_queries,
    marts_queries,
    pricing_queries,
    publish_queries,
    report_queries,
)
from verification.registry import QUERIES

__all__ = ["QUERIES"]
