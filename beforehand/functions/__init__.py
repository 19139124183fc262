from .scalar import (
    cross_border,
    epoch_micros,
    epoch_seconds,
    flag_equals,
    in_days,
    in_range,
    known_label,
    ordinal,
    ratio_to_baseline,
    share_with_current,
    weekend_flag,
)

__all__ = [
    "cross_border",
    "epoch_micros",
    "epoch_seconds",
    "flag_equals",
    "in_days",
    "in_range",
    "known_label",
    "ordinal",
    "ratio_to_baseline",
    "share_with_current",
    "weekend_flag",
]
