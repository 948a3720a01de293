"""Every operator and job as a query over the stand-in tables, with its SQL counterpart."""

from . import aggregates, functions, jobs, joins, tables  # noqa: F401  (they register their checks)
from .registry import oracles, queries

__all__ = ["oracles", "queries"]
