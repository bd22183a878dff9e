from .columns import (
    LabelRule,
    array_head,
    as_col,
    clamp_min,
    clock_to_minutes,
    contains_any,
    label_family,
    minutes_to_clock,
    per_exposure,
    round_all,
    safe_ratio,
    vector_max,
)

__all__ = [
    "LabelRule",
    "array_head",
    "as_col",
    "clamp_min",
    "clock_to_minutes",
    "contains_any",
    "label_family",
    "minutes_to_clock",
    "per_exposure",
    "round_all",
    "safe_ratio",
    "vector_max",
]
