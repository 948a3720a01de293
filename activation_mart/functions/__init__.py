from .dates import RunWindow, hour_boundaries, in_window, month_boundaries, month_year, parse_date
from .predicates import (
    address_verified,
    channel_label,
    code_needs_trusted_user,
    exclude_patterns,
    has_all,
    same_text_in,
)
from .text import ci_eq, ci_like, folded

__all__ = [
    "RunWindow", "address_verified", "channel_label", "ci_eq", "ci_like",
    "code_needs_trusted_user", "exclude_patterns", "folded", "has_all", "hour_boundaries",
    "in_window", "month_boundaries", "month_year", "parse_date", "same_text_in",
]
