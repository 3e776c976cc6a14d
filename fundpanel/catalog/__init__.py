"""Runnable queries over the given tables, each beside its SQL."""

from . import aggregates, cleaning, files, joins, panels, reports, reshaping, vintages, windows  # noqa: F401
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
