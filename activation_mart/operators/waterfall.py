"""First-match classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rung = tuple[str, str]


def first_match(rungs: Sequence[Rung], default: str | None = None) -> Column:
    """Label of the first rung whose condition, a SQL expression, is true."""
    cases = " ".join(f"WHEN {condition} THEN '{label}'" for label, condition in rungs)
    otherwise = "NULL" if default is None else f"'{default}'"
    return F.expr(f"CASE {cases} ELSE {otherwise} END")
