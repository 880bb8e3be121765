"""Cash reconciliation on Spark: feeds in, typed tables, three marts, checks."""

from cashweave.session import configure

__all__ = ["configure"]
