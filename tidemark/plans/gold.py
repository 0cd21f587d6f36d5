"""Gold models: windowed network KPIs, latest cell state, customer 360, revenue at risk."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    at_least,
    at_most,
    clock,
    exact_avg,
    exact_sum,
    floor_instant,
    percent_of,
    round_half_up,
    tumbling_window,
)
from tidemark.functions.temporal import as_timestamp
from tidemark.operators.latest import latest_per_key
from tidemark.operators.lookup import DEFAULT_POLICY, LookupPolicy, lookup_join
from tidemark.plans.staging import DATA, VOICE

# Fixed values of the data model.
KPI_WINDOW = timedelta(minutes=15)
KPI_LOOKBACK = timedelta(minutes=30)
KPI_KEYS = ("window_start", "cell_id", "network_type")
CELL_COLUMNS = ("cell_id", "province", "district", "region", "latitude", "longitude", "vendor", "band", "network_type")
MB_PER_GB = 1024.0
# Averaged measurements and the decimals they are shown with.
_METRIC_DIGITS = {"latency_ms": 2, "jitter_ms": 2, "packet_loss_pct": 3, "rsrp": 2, "sinr": 2}
NORMAL, WARNING, CRITICAL = "NORMAL", "WARNING", "CRITICAL"
HIGH_RISK, MEDIUM_RISK, LOW_RISK = "HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"
HEALTHY = "HEALTHY"


@dataclass(frozen=True)
class LoadWeights:
    """Fixed values of the cell load score: points per failed call and per issue, and the ceiling."""

    call_failure: float = 2.0
    qoe_issue: float = 1.5
    ceiling: float = 100.0


@dataclass(frozen=True)
class SeverityLimits:
    """A cell at or above any limit of a level has that level."""

    drop_rate: float
    qoe_rate: float
    load: float

    def reached(self) -> Column:
        return (
            (F.col("drop_call_rate_pct") >= self.drop_rate)
            | (F.col("qoe_issue_rate_pct") >= self.qoe_rate)
            | (F.col("cell_load_score") >= self.load)
        )


CRITICAL_LIMITS = SeverityLimits(drop_rate=5.0, qoe_rate=18.0, load=85.0)
WARNING_LIMITS = SeverityLimits(drop_rate=2.0, qoe_rate=10.0, load=65.0)


@dataclass(frozen=True)
class CustomerRules:
    """Fixed values of the impact score, the churn tiers (by monthly fee) and plan health."""

    fee_unit: float = 100_000.0
    critical_weight: float = 3.0
    warning_weight: float = 1.5
    other_weight: float = 0.5
    high_risk_fee: float = 300_000.0
    any_cell_fee: float = 500_000.0
    warning_cell_fee: float = 200_000.0
    critical_share: float = 0.20
    at_risk_share: float = 0.15


def aligned_lower_bound(as_of: datetime, lookback: timedelta = KPI_LOOKBACK, width: timedelta = KPI_WINDOW) -> datetime:
    """Start of an incremental refresh, moved back to a window start.

    Without the alignment the oldest window would be recomputed from part of its events.
    """
    return floor_instant(as_of - lookback, width)


def events_since(silver: DataFrame, bound: datetime) -> DataFrame:
    """Events of the windows to recompute; a plain comparison, so it reaches the file scan."""
    since = F.col("event_ts") >= as_timestamp(bound)
    if "event_date" in silver.columns:
        since = since & (F.col("event_date") >= F.lit(bound.date()))
    return silver.where(since)


def windowed_kpis(
    silver: DataFrame,
    width: timedelta = KPI_WINDOW,
    as_of: datetime | None = None,
    weights: LoadWeights = LoadWeights(),
) -> DataFrame:
    """KPIs per time window, cell and network.

    All aggregates are counts, long sums and double sums, so the plan is a hash aggregate with
    map-side combine: a cell with a third of all events reaches the reducers as one partial row
    per map task and window.
    """
    bucketed = silver.withColumn("__window", tumbling_window("event_ts", width))
    grouped = bucketed.groupBy("__window", *CELL_COLUMNS, "site_capacity_gbps").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_type") == VOICE).alias("total_calls"),
        F.count_if(F.col("event_type") == DATA).alias("total_data_sessions"),
        F.count_if("is_call_failure").alias("dropped_calls"),
        F.count_if("has_qoe_issue").alias("qoe_issue_events"),
        F.coalesce(exact_sum("total_mb"), F.lit(0.0)).alias("traffic_mb"),
        *[exact_avg(metric).alias(f"avg_{metric}") for metric in _METRIC_DIGITS],
    )
    derived = grouped.select(
        "*",
        (F.col("traffic_mb") / MB_PER_GB).alias("data_traffic_gb"),
        percent_of("dropped_calls", "total_calls").alias("drop_call_rate_pct"),
        percent_of("qoe_issue_events", "total_events").alias("qoe_issue_rate_pct"),
        (F.col("site_capacity_gbps") * MB_PER_GB).alias("capacity_mb"),
    )
    load = (
        F.col("traffic_mb") / at_least("capacity_mb", 1.0) * 100.0
        + F.col("dropped_calls") * weights.call_failure
        + F.col("qoe_issue_events") * weights.qoe_issue
    )
    # An unknown capacity gives an unknown score, not a full one.
    scored = derived.withColumn("load", load).withColumn("cell_load_score", at_most("load", weights.ceiling))
    return scored.select(
        F.col("__window.start").alias("window_start"),
        F.col("__window.end").alias("window_end"),
        *CELL_COLUMNS,
        "total_events",
        "total_calls",
        "total_data_sessions",
        "dropped_calls",
        "qoe_issue_events",
        round_half_up("data_traffic_gb", 4).alias("data_traffic_gb"),
        *[round_half_up(f"avg_{metric}", digits).alias(f"avg_{metric}") for metric, digits in _METRIC_DIGITS.items()],
        *[round_half_up(c, 3).alias(c) for c in ("drop_call_rate_pct", "qoe_issue_rate_pct", "cell_load_score")],
        clock(as_of).alias("updated_at"),
    )


def classify_severity(kpis: DataFrame) -> DataFrame:
    """Unknown rates and scores count as zero, then the severity follows from the limits."""
    filled = kpis.fillna(0.0, ["drop_call_rate_pct", "qoe_issue_rate_pct", "cell_load_score"])
    severity = (
        F.when(CRITICAL_LIMITS.reached(), CRITICAL).when(WARNING_LIMITS.reached(), WARNING).otherwise(NORMAL)
    )
    return filled.withColumn("severity", severity)


def cell_heatmap(kpis: DataFrame) -> DataFrame:
    """Latest KPI row of each cell, with severity. Network and band decide between equal windows."""
    latest = latest_per_key(kpis, ["cell_id"], ["window_start", "network_type", "band"])
    columns = [c for c in kpis.columns if c != "updated_at"]
    return classify_severity(latest).select(*columns, "severity", "updated_at")


# Cell columns of the customer view and their names there.
_HOME_CELL = {
    "province": "province",
    "district": "district",
    "latitude": "latitude",
    "longitude": "longitude",
    "severity": "home_cell_severity",
    "drop_call_rate_pct": "home_cell_drop_rate",
    "qoe_issue_rate_pct": "home_cell_qoe_issue_rate",
    "cell_load_score": "home_cell_load_score",
    "avg_latency_ms": "home_cell_avg_latency",
    "data_traffic_gb": "home_cell_traffic_gb",
}


def _impact_score(rules: CustomerRules) -> Column:
    severity = F.col("home_cell_severity")
    weight = (
        F.when(severity == CRITICAL, rules.critical_weight)
        .when(severity == WARNING, rules.warning_weight)
        .otherwise(rules.other_weight)
    )
    fee = F.coalesce("monthly_fee", F.lit(0.0)) / rules.fee_unit
    load = F.coalesce("home_cell_load_score", F.lit(0.0)) / 100.0
    return fee * load * weight * 100.0


def _churn_tier(rules: CustomerRules) -> Column:
    """Ordered rules. A missing severity is unknown, yet a high fee alone still decides."""
    severity, fee = F.col("home_cell_severity"), F.col("monthly_fee")
    return (
        F.when((severity == CRITICAL) & (fee >= rules.high_risk_fee), HIGH_RISK)
        .when((severity == CRITICAL) | (fee >= rules.any_cell_fee), MEDIUM_RISK)
        .when((severity == WARNING) & (fee >= rules.warning_cell_fee), MEDIUM_RISK)
        .otherwise(LOW_RISK)
    )


def customer_360(
    subscribers: DataFrame,
    plans: DataFrame,
    heatmap: DataFrame,
    as_of: datetime | None = None,
    rules: CustomerRules = CustomerRules(),
    policy: LookupPolicy | None = DEFAULT_POLICY,
) -> DataFrame:
    """Active subscribers with their plan and the state of their home cell.

    A subscriber without a plan drops out, one whose cell has no KPI stays. Plans are reduced to
    their latest state here, and the heatmap may be a view, so neither is computed just to be
    measured: with ``policy`` the heatmap is, for callers that have stored it.
    """
    active = subscribers.where(F.col("status") == "active").select(
        "subscriber_id", "full_name", "status", "activated_at", "plan_id", "home_cell_id"
    )
    offers = plans.select("plan_id", "plan_name", "plan_type", "monthly_fee", "data_quota_gb", "voice_minutes")
    cells = heatmap.select(
        F.col("cell_id").alias("home_cell_id"), *[F.col(c).alias(name) for c, name in _HOME_CELL.items()]
    )
    joined = lookup_join(
        lookup_join(active, offers, "plan_id", "inner", None), cells, "home_cell_id", "left", policy
    )
    scored = joined.withColumns({"customer_impact_score": _impact_score(rules), "churn_risk_tier": _churn_tier(rules)})
    return scored.select(
        *[c for c in active.columns if c not in ("plan_id", "home_cell_id")],
        *offers.columns,
        "home_cell_id",
        *_HOME_CELL.values(),
        round_half_up("customer_impact_score", 2).alias("customer_impact_score"),
        "churn_risk_tier",
        clock(as_of).alias("updated_at"),
    )


# Averages over the customers of a plan and the decimals they are shown with.
_PLAN_AVERAGES = {
    "avg_subscriber_latency_ms": ("home_cell_avg_latency", 2),
    "avg_subscriber_drop_rate": ("home_cell_drop_rate", 3),
    "avg_impact_score": ("customer_impact_score", 2),
}
# Revenue columns and the subscriber counts they price.
_PLAN_REVENUES = {
    "total_monthly_revenue": ("subscriber_count",),
    "critical_revenue_at_risk": ("critical_cell_subscribers",),
    "total_revenue_at_risk": ("critical_cell_subscribers", "warning_cell_subscribers"),
}
_PLAN_COLUMNS = ("plan_id", "plan_name", "plan_type", "monthly_fee", "data_quota_gb", "voice_minutes")


def plan_revenue_impact(
    customers: DataFrame, as_of: datetime | None = None, rules: CustomerRules = CustomerRules()
) -> DataFrame:
    """Subscribers, revenue and revenue at risk per plan, with a health status.

    Plans with a huge share of the subscribers are fine: the counts combine before the shuffle.
    """
    severity, tier = F.col("home_cell_severity"), F.col("churn_risk_tier")
    grouped = customers.groupBy(*_PLAN_COLUMNS).agg(
        F.count(F.lit(1)).alias("subscriber_count"),
        F.count_if(severity == CRITICAL).alias("critical_cell_subscribers"),
        F.count_if(severity == WARNING).alias("warning_cell_subscribers"),
        F.count_if(severity.isNull() | (severity == NORMAL)).alias("healthy_cell_subscribers"),
        F.count_if(tier == HIGH_RISK).alias("high_risk_subscribers"),
        F.count_if(tier == MEDIUM_RISK).alias("medium_risk_subscribers"),
        *[exact_avg(column).alias(name) for name, (column, _) in _PLAN_AVERAGES.items()],
    )
    fee = F.col("monthly_fee")
    priced = grouped.withColumns(
        {name: sum((F.col(c) for c in counts), F.lit(0.0)) * fee for name, counts in _PLAN_REVENUES.items()}
    ).withColumns({name: round_half_up(name, 2) for name in _PLAN_REVENUES})
    base = F.nullif(F.col("total_monthly_revenue"), F.lit(0.0))
    shares = priced.withColumns(
        {
            "critical_share": F.coalesce("critical_revenue_at_risk", F.lit(0.0)) / base,
            "at_risk_share": F.coalesce("total_revenue_at_risk", F.lit(0.0)) / base,
        }
    ).withColumn("revenue_at_risk_pct", F.col("at_risk_share") * 100.0)
    health = (
        F.when(F.col("critical_share") > rules.critical_share, CRITICAL)
        .when(F.col("at_risk_share") > rules.at_risk_share, WARNING)
        .otherwise(HEALTHY)
    )
    return shares.select(
        *_PLAN_COLUMNS,
        "subscriber_count",
        "critical_cell_subscribers",
        "warning_cell_subscribers",
        "healthy_cell_subscribers",
        *_PLAN_REVENUES,
        "high_risk_subscribers",
        "medium_risk_subscribers",
        *[round_half_up(name, digits).alias(name) for name, (_, digits) in _PLAN_AVERAGES.items()],
        clock(as_of).alias("updated_at"),
        round_half_up("revenue_at_risk_pct", 2).alias("revenue_at_risk_pct"),
        health.alias("plan_health_status"),
    )
