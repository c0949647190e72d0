"""Named queries over the test tables, each beside the SQL that must agree with it."""

from plaudit.plans.catalog.base import ORACLES, QUERIES
from plaudit.plans.catalog import graphs, models, primitives, reports, tables  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
