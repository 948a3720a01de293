"""Filters and labels made of built-in column functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from .text import as_column, ci_eq, folded


def exclude_patterns(patterns: Mapping[str, Iterable[str]]) -> Column:
    """True where no column matches any of its patterns; NULL matches nothing."""
    tests = [
        ~F.coalesce(F.col(column), F.lit("")).ilike(pattern)
        for column, column_patterns in patterns.items()
        for pattern in column_patterns
    ]
    return reduce(and_, tests, F.lit(True))


def has_all(groups: Iterable[Iterable[str]]) -> Column:
    """True where each group of columns holds at least one value."""
    return reduce(and_, (F.coalesce(*(F.col(c) for c in group)).isNotNull() for group in groups))


def same_text_in(column: Column | str, values: Iterable[str]) -> Column:
    return folded(column).isin([value.lower() for value in values])


def code_needs_trusted_user(
    code: Column | str,
    user: Column | str,
    open_codes: Iterable[str],
    restricted_code: str,
    trusted_users: Iterable[int],
) -> Column:
    """An open code counts from anybody, the restricted one from trusted users only."""
    restricted = ci_eq(code, restricted_code) & as_column(user).isin(list(trusted_users))
    return same_text_in(code, open_codes) | restricted


def channel_label(is_online: Column | str) -> Column:
    return F.when(as_column(is_online), config.ONLINE).otherwise(config.RETAIL)


def address_verified(first: Column | str, second: Column | str) -> Column:
    """'VERIFIED' unless one of the two address checks gave another result."""
    fine = [as_column(c).isNull() | ci_eq(c, "verified") for c in (first, second)]
    return F.when(fine[0] & fine[1], "VERIFIED")
