"""Import every family so that its queries are registered."""

from gatelog.catalog import (  # noqa: F401
    incremental,
    ingestion,
    monitoring,
    operations,
    relational,
)
from gatelog.catalog.registry import EXPECTED, QUERIES

__all__ = ["EXPECTED", "QUERIES"]
