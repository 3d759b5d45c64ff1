"""Column helpers shared by the operators."""

from loanlens.functions.scalar import (
    calibrate,
    day_diff,
    iso_day,
    in_day_window,
    logit,
    month_label,
    null_if_nan,
    number,
    percent_text,
    round_half_even,
    same_text,
    share_of,
    sigmoid,
    trimmed,
)

__all__ = [
    "calibrate",
    "day_diff",
    "in_day_window",
    "iso_day",
    "logit",
    "month_label",
    "null_if_nan",
    "number",
    "percent_text",
    "round_half_even",
    "same_text",
    "share_of",
    "sigmoid",
    "trimmed",
]
