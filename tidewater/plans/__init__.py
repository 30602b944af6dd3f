"""Registered plans; importing this package registers all of them."""

from tidewater.plans import buckets, catalog, checks, nesting, synthesis, tables, topics  # noqa: F401
from tidewater.plans.registry import PLANS, Plan, plan, table

__all__ = ["PLANS", "Plan", "plan", "table"]
