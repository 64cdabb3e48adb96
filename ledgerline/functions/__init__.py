"""Column expressions shared by the operators."""

from ledgerline.functions.dates import calendar_attributes, months_between_calendar, to_utc_wall_clock
from ledgerline.functions.money import exceeds_ratio, half_up_ratio, pct_2dp, round2

__all__ = [
    "calendar_attributes",
    "months_between_calendar",
    "to_utc_wall_clock",
    "exceeds_ratio",
    "half_up_ratio",
    "pct_2dp",
    "round2",
]
