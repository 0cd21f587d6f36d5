"""Silver model: valid, unique events with the attributes of their cell."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators.latest import latest_per_key
from tidemark.operators.lookup import DEFAULT_POLICY, LookupPolicy, lookup_join
from tidemark.plans.staging import DATA, VOICE

# Fixed values of the data model.
EVENT_TYPES = (VOICE, DATA)
NETWORK_TYPES = ("4G", "5G")
FUTURE_SKEW = timedelta(minutes=5)

_CELL_COLUMNS = ("province", "district", "region", "latitude", "longitude", "vendor", "site_capacity_gbps")
_EVENT_TIE_BREAK = ("ingested_at", "kafka_timestamp", "event_ts")


def valid_events(staged: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Events of a known kind and network, on some cell, and not from the future."""
    newest = clock(as_of) + F.lit(FUTURE_SKEW)
    return staged.where(
        F.col("cell_id").isNotNull()
        & F.col("event_type").isin(*EVENT_TYPES)
        & F.col("network_type").isin(*NETWORK_TYPES)
        & (F.col("event_ts") <= newest)
    )


def tie_break(events: DataFrame) -> list[str]:
    """The columns that decide between copies of an event."""
    return [c for c in _EVENT_TIE_BREAK if c in events.columns]


def unique_events(valid: DataFrame, order_cols: Sequence[str] | None = None) -> DataFrame:
    """The copy of each event that was ingested last."""
    return latest_per_key(valid, ["event_id"], order_cols or tie_break(valid))


def cell_attributes(cells: DataFrame) -> DataFrame:
    """Cell reference rows ready to be joined on the upper-case cell id."""
    return cells.select(
        F.upper("cell_id").alias("cell_id"), *_CELL_COLUMNS, F.upper("band").alias("cell_band")
    )


def enrich_events(events: DataFrame, cells: DataFrame, policy: LookupPolicy = DEFAULT_POLICY) -> DataFrame:
    """Add the cell's attributes; events of unknown cells drop out; the cell's band fills gaps."""
    joined = lookup_join(events, cell_attributes(cells), "cell_id", "inner", policy)
    return joined.withColumn("band", F.coalesce("band", "cell_band")).drop("cell_band", "raw_payload", "kafka_key")


def silver_events(
    staged: DataFrame, cells: DataFrame, as_of: datetime | None = None, policy: LookupPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Filter, deduplicate, enrich. The filter and the column choice come before the shuffle."""
    slim = valid_events(staged, as_of).drop("raw_payload", "kafka_key")
    return enrich_events(unique_events(slim), cells, policy)
