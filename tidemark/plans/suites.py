"""Quality checks of every table. Columns, lists and bounds are fixed values of the data model."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import (
    WARN,
    AcceptedRange,
    AcceptedValues,
    Check,
    CoordinateBox,
    Freshness,
    NotEmpty,
    NotNull,
    References,
    Unique,
)
from tidemark.plans import gold
from tidemark.plans.silver import EVENT_TYPES, NETWORK_TYPES
from tidemark.plans.staging import SUBSCRIBER_STATUSES


def _key(column: str) -> list[Check]:
    return [NotNull(column), Unique(column)]


def _percentages(*columns: str) -> list[Check]:
    return [AcceptedRange(c, 0.0, 100.0) for c in columns]


def cell_reference_checks() -> list[Check]:
    box = CoordinateBox()
    return [
        *_key("cell_id"),
        NotNull("latitude"),
        AcceptedRange("latitude", box.south, box.north),
        NotNull("longitude"),
        AcceptedRange("longitude", box.west, box.east),
    ]


def bronze_event_checks() -> list[Check]:
    return [NotNull("event_id"), NotNull("event_ts", severity=WARN)]


def bronze_plan_checks() -> list[Check]:
    return [NotNull("plan_name"), NotNull("monthly_fee")]


def bronze_subscriber_checks() -> list[Check]:
    return [AcceptedValues("status", SUBSCRIBER_STATUSES)]


def staged_event_checks() -> list[Check]:
    return [
        NotNull("event_id"),
        NotNull("event_ts"),
        AcceptedValues("event_type", EVENT_TYPES),
        AcceptedValues("network_type", NETWORK_TYPES),
    ]


def staged_plan_checks() -> list[Check]:
    return [*_key("plan_id"), NotNull("monthly_fee"), AcceptedRange("monthly_fee", 0.0, 10_000_000.0)]


def staged_subscriber_checks() -> list[Check]:
    return [*_key("subscriber_id"), NotNull("plan_id"), AcceptedValues("status", SUBSCRIBER_STATUSES)]


def silver_checks(cells: DataFrame) -> list[Check]:
    return [
        CoordinateBox(),
        *_key("event_id"),
        NotNull("cell_id"),
        References("cell_id", cells, "cell_id"),
        NotNull("latitude"),
        NotNull("longitude"),
    ]


def kpi_checks() -> list[Check]:
    return [
        NotEmpty(),
        CoordinateBox(),
        NotNull("window_start"),
        NotNull("cell_id"),
        *_percentages("drop_call_rate_pct", "qoe_issue_rate_pct", "cell_load_score"),
    ]


def heatmap_checks() -> list[Check]:
    return [
        CoordinateBox(),
        *_key("cell_id"),
        AcceptedValues("severity", (gold.NORMAL, gold.WARNING, gold.CRITICAL)),
    ]


def customer_checks() -> list[Check]:
    tiers = (gold.HIGH_RISK, gold.MEDIUM_RISK, gold.LOW_RISK)
    return [NotEmpty(), *_key("subscriber_id"), AcceptedValues("churn_risk_tier", tiers)]


def revenue_checks() -> list[Check]:
    states = (gold.CRITICAL, gold.WARNING, gold.HEALTHY)
    return [NotEmpty(), *_key("plan_id"), AcceptedValues("plan_health_status", states)]


# Table name to the checks it gets, given all tables of the run.
SUITES: dict[str, Callable[[dict[str, DataFrame]], list[Check]]] = {
    "bts_metadata": lambda tables: cell_reference_checks(),
    "bronze_telecom_events": lambda tables: bronze_event_checks(),
    "bronze_billing_plans": lambda tables: bronze_plan_checks(),
    "bronze_subscribers": lambda tables: bronze_subscriber_checks(),
    "stg_telecom_events": lambda tables: staged_event_checks(),
    "stg_billing_plans": lambda tables: staged_plan_checks(),
    "stg_subscribers": lambda tables: staged_subscriber_checks(),
    "silver_cell_events": lambda tables: silver_checks(tables["bts_metadata"]),
    "gold_network_kpis": lambda tables: kpi_checks(),
    "gold_cell_heatmap": lambda tables: heatmap_checks(),
    "gold_customer_360": lambda tables: customer_checks(),
    "gold_plan_revenue_impact": lambda tables: revenue_checks(),
}


# Sources whose newest row must not be old; tables of billing may go without a change for long.
FRESHNESS: dict[str, Freshness] = {"bronze_telecom_events": Freshness()}


def freshness_report(
    sources: dict[str, DataFrame], as_of: datetime | None = None, limits: Mapping[str, Freshness] = FRESHNESS
) -> DataFrame:
    """Columns ``table_name, max_loaded_at, checked_at, status``; one row per source that is given and has a bound."""
    found = [
        limit.status(sources[name], as_of).select(
            F.lit(name).alias("table_name"), F.col("max_loaded_at").cast("timestamp_ntz").alias("max_loaded_at"), "checked_at", "status"
        )
        for name, limit in limits.items()
        if name in sources
    ]
    if not found:
        raise ValueError(f"none of {sorted(limits)} is among the sources")
    return reduce(DataFrame.unionByName, found)
