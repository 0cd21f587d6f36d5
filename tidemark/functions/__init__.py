"""Column-level helpers: rounding, exact sums, null-preserving bounds and time windows."""

from tidemark.functions.numeric import (
    at_least,
    at_most,
    exact_avg,
    exact_sum,
    percent_of,
    round_half_up,
)
from tidemark.functions.temporal import as_timestamp, clock, floor_instant, tumbling_window

__all__ = [
    "as_timestamp",
    "at_least",
    "at_most",
    "clock",
    "exact_avg",
    "exact_sum",
    "floor_instant",
    "percent_of",
    "round_half_up",
    "tumbling_window",
]
