"""Registered queries. Importing a module of this package registers its queries."""

from tallyrill.plans import aggregates, learning, mining, orders, tables, timeseries  # noqa: F401
from tallyrill.plans.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
