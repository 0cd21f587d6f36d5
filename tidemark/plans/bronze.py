"""Raw broker records to bronze event rows; the same functions serve batch and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import BRONZE_EVENT_COLUMNS, EVENT_PAYLOAD


def decode_events(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Payload fields next to the broker key, broker time and the untouched payload text.

    ``keep`` names further record columns to carry along.
    """
    payload = F.col("value").cast("string")
    return records.select(
        # Unlike a struct column that is flattened later, a generator is a barrier for filters:
        # they cannot be pushed below it with a second copy of the parser inside.
        F.inline(F.array(F.from_json(payload, EVENT_PAYLOAD))),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        payload.alias("raw_payload"),
        *keep,
    )


def type_events(decoded: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Parse the event time (bad text becomes null) and add ingest time, event date and hour."""
    timed = decoded.withColumn("event_ts", F.try_to_timestamp("event_ts"))
    return timed.withColumns(
        {
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
            "event_date": F.to_date("event_ts"),
            "event_hour": F.hour("event_ts"),
        }
    ).select(*BRONZE_EVENT_COLUMNS, *[c for c in decoded.columns if c not in BRONZE_EVENT_COLUMNS])


def reject_reason() -> Column:
    """Why a typed event cannot enter bronze, or null if it can."""
    return F.when(F.col("event_id").isNull(), F.lit("missing_event_id")).when(
        F.col("event_ts").isNull(), F.lit("missing_event_ts")
    )


def identified_events(typed: DataFrame) -> DataFrame:
    """Events that carry an id."""
    return typed.where(F.col("event_id").isNotNull())


def accepted_events(typed: DataFrame) -> DataFrame:
    """Events with an id and a usable event time."""
    return typed.where(reject_reason().isNull())


def quarantined_events(typed: DataFrame) -> DataFrame:
    """The other events, with the reason; the payload text is kept for a later replay."""
    return typed.withColumn("reason", reject_reason()).where(F.col("reason").isNotNull())
