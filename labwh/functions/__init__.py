"""Column-level helpers; each returns a Column built from built-in functions."""

from labwh.functions.dates import (
    add_months,
    calendar_parts,
    compact_timestamp,
    day_of_compact,
    epoch_millis,
    grace_month,
    hour_of_compact,
    in_previous_month,
    in_range,
    in_unit,
    month_of,
    month_start,
    months_window,
    previous_day,
    same_year_month,
    unit_range,
)
from labwh.functions.labels import (
    HANDLED,
    LIVE,
    MET,
    MISSING_NAME,
    MISSING_TEXT,
    NOT_MET,
    OTHER_LABEL,
    PARTLY_MET,
    any_filled,
    filled,
    live,
    month_label,
    null_bucket,
    text_key,
)
from labwh.functions.numbers import in_ten_thousands, magnitude_cell, money, proportion

__all__ = [n for n in dir() if not n.startswith("_")]
