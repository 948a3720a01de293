from .runs import (
    backfill,
    backfill_online,
    backfill_quiz,
    backfill_retail,
    build_initial,
    run_add,
    run_update,
    tag_internal,
)

__all__ = [
    "backfill", "backfill_online", "backfill_quiz", "backfill_retail", "build_initial",
    "run_add", "run_update", "tag_internal",
]
