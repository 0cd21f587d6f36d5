"""Time expressions. Every rule that needs "now" takes an injectable ``as_of`` instead."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1)


def as_timestamp(instant: datetime) -> Column:
    """A zone-less timestamp literal; it folds to a constant, so scans can be filtered with it."""
    return F.lit(instant.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def clock(as_of: datetime | None) -> Column:
    """The injected instant, or the session's local time."""
    return F.localtimestamp() if as_of is None else as_timestamp(as_of)


def floor_instant(instant: datetime, width: timedelta) -> datetime:
    """Start of the epoch-aligned window of ``width`` that holds ``instant``."""
    return instant - (instant - _EPOCH) % width


def tumbling_window(timestamp: Column | str, width: timedelta) -> Column:
    """Epoch-aligned tumbling window struct (``start``, ``end``), for batch and streams alike."""
    return F.window(timestamp, f"{int(width.total_seconds())} seconds")
