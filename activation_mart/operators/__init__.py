from .audit import drift, drift_by_column, duplicates, repeated_rows
from .keys import in_positions, with_surrogate_key
from .latest import latest_one, latest_with_ties, order_number, rows_at_latest, with_attempt
from .lookup import (
    SPREAD,
    apply_inner,
    apply_left,
    left_lookup,
    null_aware_anti,
    has_row,
    only_keys,
    spread_lookup,
    union_distinct,
    with_spread,
)
from .patch import add_column, append_new, keyed_patch, set_where
from .top import preview, top_n
from .waterfall import first_match

__all__ = [
    "SPREAD",
    "add_column", "append_new", "apply_inner", "apply_left", "drift", "drift_by_column",
    "duplicates", "first_match", "in_positions", "keyed_patch", "latest_one",
    "latest_with_ties", "left_lookup", "has_row", "null_aware_anti", "only_keys",
    "order_number", "preview", "repeated_rows", "rows_at_latest", "set_where", "spread_lookup", "top_n",
    "union_distinct", "with_attempt", "with_spread", "with_surrogate_key",
]
