"""Run windows and calendar arithmetic."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column


def _to_minute(moment: datetime) -> datetime:
    """Nearest minute, the precision of the run parameters."""
    return (moment + timedelta(seconds=30)).replace(second=0, microsecond=0)


@dataclass(frozen=True)
class RunWindow:
    """Half-open time window: ``start`` belongs to it, ``end`` does not."""

    start: datetime
    end: datetime

    @classmethod
    def parse(cls, start: str, end: str) -> "RunWindow":
        """From month/day/year text, e.g. ``RunWindow.parse('12/1/2012', '1/22/2013')``."""
        return cls(*(_to_minute(datetime.strptime(text, "%m/%d/%Y")) for text in (start, end)))

    @classmethod
    def trailing(cls, days: int, as_of: datetime) -> "RunWindow":
        """The ``days`` days up to ``as_of``, starting at midnight."""
        first = (as_of - timedelta(days=days)).replace(hour=0, minute=0, second=0, microsecond=0)
        return cls(first, _to_minute(as_of))


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_window(column: Column | str, window: RunWindow) -> Column:
    column = as_column(column)
    return (column >= _ntz(window.start)) & (column < _ntz(window.end))


def parse_date(text: Column | str) -> Column:
    """Month/day/year text to a timestamp."""
    return F.to_timestamp_ntz(as_column(text), F.lit("M/d/yyyy"))


def month_year(moment: Column | str) -> Column:
    """October 2012 becomes 102012."""
    moment = as_column(moment)
    return (F.month(moment) * 10000 + F.year(moment)).cast("int")


def month_boundaries(first: Column | str, last: Column | str) -> Column:
    """Month ends crossed from ``first`` to ``last``; a started month counts."""
    first, last = as_column(first), as_column(last)
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)


def hour_boundaries(first: Column | str, last: Column | str) -> Column:
    """Full hours on the clock passed from ``first`` to ``last``, whatever the session's time zone.

    Days and hours of a time without zone are taken as they stand.
    """
    first, last = (as_column(c).cast("timestamp_ntz") for c in (first, last))
    days = F.date_diff(last.cast("date"), first.cast("date")).cast("long")
    return days * 24 + F.hour(last) - F.hour(first)
