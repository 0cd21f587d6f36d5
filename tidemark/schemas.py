"""Declared schemas of the streams, the change payloads and the bronze tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def struct(columns: str) -> T.StructType:
    """A schema from ``"name type, ..."``; unlike the DDL parser it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The column names and types of the data model.
EVENT_PAYLOAD = struct(
    "event_id string, event_ts string, subscriber_id string, cell_id string, event_type string, "
    "network_type string, band string, device_type string, call_status string, call_duration_sec int, "
    "drop_reason string, download_mb double, upload_mb double, latency_ms double, jitter_ms double, "
    "packet_loss_pct double, rsrp double, sinr double, source string"
)

PLAN_PAYLOAD = struct(
    "plan_id string, plan_name string, plan_type string, monthly_fee double, data_quota_gb double, "
    "voice_minutes int, created_at long, updated_at long, __deleted string"
)

SUBSCRIBER_PAYLOAD = struct(
    "subscriber_id string, full_name string, plan_id string, home_cell_id string, status string, "
    "activated_at long, updated_at long, __deleted string"
)

CELL_REFERENCE = struct(
    "cell_id string, province string, district string, latitude double, longitude double, region string, "
    "vendor string, band string, site_capacity_gbps double, active_from date"
)

# Columns that ingestion adds to the event payload.
EVENT_AUDIT_COLUMNS = ("kafka_key", "kafka_timestamp", "raw_payload", "ingested_at", "event_date", "event_hour")
BRONZE_EVENT_COLUMNS = tuple(EVENT_PAYLOAD.names) + EVENT_AUDIT_COLUMNS

# Records of a broker topic, whatever reader they come from.
BROKER_RECORD = struct("key binary, value binary, timestamp timestamp, offset long, partition int")
