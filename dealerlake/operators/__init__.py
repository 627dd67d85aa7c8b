from dealerlake.operators.checks import (
    LoadRejected,
    broken_row,
    count_violations,
    duplicate_keys,
    key_violations,
    length_counts,
    null_counts,
    violation_counts,
)
from dealerlake.operators.counting import counting, tally
from dealerlake.operators.merge import dedupe_first_last, drop_loaded_on, upsert

__all__ = [
    "LoadRejected",
    "broken_row",
    "count_violations",
    "counting",
    "dedupe_first_last",
    "drop_loaded_on",
    "duplicate_keys",
    "key_violations",
    "length_counts",
    "null_counts",
    "tally",
    "upsert",
    "violation_counts",
]
