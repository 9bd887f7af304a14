from tallystar.functions.keys import surrogate_key, time_bucket_key
from tallystar.functions.numbers import null_to_zero, parse_float, safe_float
from tallystar.functions.timestamps import (
    epoch_seconds,
    floor_to_quarter,
    instant_to_wall_clock,
    normalize_ts,
    truncate_to_second,
    wall_clock_from_epoch,
    wall_clock_to_instant,
)

__all__ = [
    "epoch_seconds",
    "floor_to_quarter",
    "instant_to_wall_clock",
    "normalize_ts",
    "null_to_zero",
    "parse_float",
    "safe_float",
    "surrogate_key",
    "time_bucket_key",
    "truncate_to_second",
    "wall_clock_from_epoch",
    "wall_clock_to_instant",
]
