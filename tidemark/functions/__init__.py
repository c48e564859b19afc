"""Scalar column functions (time arithmetic, bitmap hash, report text)."""

from tidemark.functions.hashing import bitmap_offset
from tidemark.functions.time import (
    as_event_time,
    epoch_us,
    floor_div,
    local_day,
    seconds_to_us,
    us_to_ms,
)

__all__ = ["as_event_time", "bitmap_offset", "epoch_us", "floor_div", "local_day",
           "seconds_to_us", "us_to_ms"]
