"""Staging models: types, letter case, validity, and the latest row per billing key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_per_key
from tidemark.schemas import BRONZE_EVENT_COLUMNS

# How each event column is normalised.
_UPPER = ("cell_id", "event_type", "network_type", "band", "call_status")
_LOWER = ("device_type", "drop_reason")
_TEXT = ("event_id", "subscriber_id", "source", "kafka_key", "raw_payload")
_DOUBLE = ("latency_ms", "jitter_ms", "packet_loss_pct", "rsrp", "sinr")
_TRAFFIC = ("download_mb", "upload_mb")
_INTEGER = ("call_duration_sec", "event_hour")
_DATE = ("event_date",)
_TIME = ("event_ts", "kafka_timestamp", "ingested_at", "created_at", "updated_at", "activated_at")

VOICE = "VOICE"
DATA = "DATA"
CALL_FAILURES = ("DROPPED", "FAILED")
SUBSCRIBER_STATUSES = ("active", "suspended", "terminated")


@dataclass(frozen=True)
class QoeLimits:
    """An event beyond any of these has a quality-of-experience issue."""

    latency_ms: float = 120.0
    packet_loss_pct: float = 2.0
    rsrp: float = -110.0
    sinr: float = 5.0


def _flag_qoe(limits: QoeLimits) -> Column:
    """Two-valued: a missing measurement never counts as an issue."""

    def measured(name: str, otherwise: float) -> Column:
        return F.coalesce(F.col(name), F.lit(otherwise))

    return (
        (measured("latency_ms", 0.0) > limits.latency_ms)
        | (measured("packet_loss_pct", 0.0) > limits.packet_loss_pct)
        | (measured("rsrp", 0.0) < limits.rsrp)
        | (measured("sinr", 99.0) < limits.sinr)
    )


def _normalised(name: str, kind: T.DataType) -> Column:
    column = F.col(name)
    if name in _TIME:
        # Times with and without a zone stay what they are.
        return column if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else column.cast("timestamp")
    if name in _DATE:
        return column.cast("date")
    if name in _UPPER:
        return F.upper(column.cast("string"))
    if name in _LOWER:
        return F.lower(column.cast("string"))
    if name in _TRAFFIC:
        return F.coalesce(column.cast("double"), F.lit(0.0))
    if name in _DOUBLE:
        return column.cast("double")
    if name in _INTEGER:
        return column.cast("int")
    if name in _TEXT:
        return column.cast("string")
    return column


def stage_events(bronze: DataFrame, limits: QoeLimits = QoeLimits()) -> DataFrame:
    """Normalised events with id and time, plus ``total_mb`` and the two issue flags.

    ``is_call_failure`` is three-valued: unknown while the event type or call status is unknown. Columns that
    are not part of the data model are left out.
    """
    usable = bronze.where(F.col("event_id").isNotNull() & F.col("event_ts").isNotNull())
    known = [f for f in bronze.schema if f.name in BRONZE_EVENT_COLUMNS]
    normalised = usable.select(*[_normalised(f.name, f.dataType).alias(f.name) for f in known])
    return normalised.withColumns(
        {
            "total_mb": F.col("download_mb") + F.col("upload_mb"),
            "is_call_failure": (F.col("event_type") == VOICE) & F.col("call_status").isin(*CALL_FAILURES),
            "has_qoe_issue": _flag_qoe(limits),
        }
    )


_BILLING_TEXT = ("plan_id", "plan_name", "plan_type", "subscriber_id", "full_name", "home_cell_id", "status")


def _typed(rows: DataFrame) -> DataFrame:
    """Ids and names as text, times as times."""
    text = {c: F.col(c).cast("string") for c in _BILLING_TEXT if c in rows.columns}
    return rows.withColumns(text | {f.name: _normalised(f.name, f.dataType) for f in rows.schema if f.name in _TIME})


def stage_plans(bronze: DataFrame, order_cols: Sequence[str] = ("updated_at", "ingested_at")) -> DataFrame:
    """Latest valid row of each plan: not deleted, with an id and a fee that is not negative."""
    valid = bronze.where(~F.col("is_deleted") & F.col("plan_id").isNotNull() & (F.col("monthly_fee") >= 0))
    typed = _typed(valid).withColumns(
        {
            "plan_type": F.lower("plan_type"),
            "monthly_fee": F.col("monthly_fee").cast("double"),
            "data_quota_gb": F.col("data_quota_gb").cast("double"),
            "voice_minutes": F.col("voice_minutes").cast("int"),
        }
    )
    columns = (
        "plan_id", "plan_name", "plan_type", "monthly_fee", "data_quota_gb", "voice_minutes",
        "created_at", "updated_at", "ingested_at",
    )
    needed = [*columns, *[c for c in order_cols if c not in columns]]
    return latest_per_key(typed.select(*needed), ["plan_id"], order_cols).select(*columns)


def stage_subscribers(bronze: DataFrame, order_cols: Sequence[str] = ("updated_at", "ingested_at")) -> DataFrame:
    """Latest valid row of each subscriber.

    The status test is on the stored spelling, before it is lower-cased: 'ACTIVE' is not valid.
    """
    valid = bronze.where(
        ~F.col("is_deleted") & F.col("subscriber_id").isNotNull() & F.col("status").isin(*SUBSCRIBER_STATUSES)
    )
    typed = _typed(valid).withColumns({"home_cell_id": F.upper("home_cell_id"), "status": F.lower("status")})
    columns = (
        "subscriber_id", "full_name", "plan_id", "home_cell_id", "status", "activated_at", "updated_at", "ingested_at",
    )
    needed = [*columns, *[c for c in order_cols if c not in columns]]
    return latest_per_key(typed.select(*needed), ["subscriber_id"], order_cols).select(*columns)
