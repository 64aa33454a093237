"""Registered queries."""

from landgrain.plans.book import CHECKS, QUERIES
from landgrain.plans import columns, datasets, domain, rows, spatial  # noqa: F401

__all__ = ["CHECKS", "QUERIES"]
