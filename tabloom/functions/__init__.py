from tabloom.functions.columns import (
    above,
    below,
    equals,
    flag,
    missing_as_text,
    numeric,
    parse_number,
    right_closed_bin,
    safe_ratio,
    text_matches,
)

__all__ = [
    "above",
    "below",
    "equals",
    "flag",
    "missing_as_text",
    "numeric",
    "parse_number",
    "right_closed_bin",
    "safe_ratio",
    "text_matches",
]
