"""Imports every query module so that all queries are registered."""

from ledgermill.queries import companies, facts, jobs, pages, rules, sections  # noqa: F401
from ledgermill.queries.base import QUERIES

__all__ = ["QUERIES"]
