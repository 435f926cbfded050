"""Queries over the given tables: one or more per operator, most with SQL to check them.

Importing this package fills the registry.
"""

from . import audit, decode, delivery, generate, metrics, scoring, series, snapshot, state, stream  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
