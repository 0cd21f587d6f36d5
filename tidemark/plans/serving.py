"""Queries that dashboards and analysts run on the published tables.

Row caps are part of these reports. Every ordering ends in a unique key, so a capped result is
the same on each run, and ``orderBy().limit()`` is planned as a per-task top-k without a full sort.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact_avg, exact_sum, round_half_up, tumbling_window
from tidemark.plans.gold import HIGH_RISK, KPI_WINDOW

# Averages shown on charts are cut to a precision at which all engines agree.
_CHART_DIGITS = 6

_CUSTOMER_COLUMNS = (
    "subscriber_id",
    "full_name",
    "plan_name",
    "monthly_fee",
    "home_cell_severity",
    "churn_risk_tier",
    "customer_impact_score",
)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def heatmap_points(heatmap: DataFrame, limit: int = 1000) -> DataFrame:
    """Average load per map point and severity, for the map chart."""
    place = ["latitude", "longitude", "severity", "cell_id", "province", "district"]
    averages = heatmap.groupBy(*place).agg(exact_avg("cell_load_score").alias("avg_cell_load_score"))
    points = averages.withColumn("avg_cell_load_score", round_half_up("avg_cell_load_score", _CHART_DIGITS))
    return points.orderBy(F.desc("avg_cell_load_score"), *place).limit(limit)


def drop_rate_trend(kpis: DataFrame, grain: timedelta = KPI_WINDOW, limit: int = 10_000) -> DataFrame:
    """Average drop rate per cell over time; the newest points if there are more than ``limit``."""
    trend = kpis.groupBy(tumbling_window("window_start", grain).alias("__grain"), "cell_id").agg(
        exact_avg("drop_call_rate_pct").alias("avg_drop_call_rate")
    )
    points = trend.select(
        F.col("__grain.start").alias("time_grain"),
        "cell_id",
        round_half_up("avg_drop_call_rate", _CHART_DIGITS).alias("avg_drop_call_rate"),
    )
    return points.orderBy(F.desc("time_grain"), "cell_id").limit(limit)


def churn_breakdown(customers: DataFrame, limit: int = 100) -> DataFrame:
    """Customers per churn tier."""
    tiers = customers.groupBy("churn_risk_tier").agg(F.count("subscriber_id").alias("total_customers"))
    return tiers.orderBy(F.desc("total_customers"), "churn_risk_tier").limit(limit)


def revenue_by_plan(revenue: DataFrame, limit: int = 100) -> DataFrame:
    """Monthly revenue per plan name."""
    plans = revenue.groupBy("plan_name").agg(exact_sum("total_monthly_revenue").alias("total_revenue"))
    return plans.orderBy(F.desc("total_revenue"), "plan_name").limit(limit)


def fee_vs_quality(customers: DataFrame, limit: int = 1000) -> DataFrame:
    """Highest impact score per fee and subscriber, for the scatter chart."""
    points = customers.groupBy("monthly_fee", "subscriber_id").agg(
        F.max("customer_impact_score").alias("impact_score")
    )
    return points.orderBy(F.desc("impact_score"), "monthly_fee", "subscriber_id").limit(limit)


def revenue_at_risk(revenue: DataFrame, limit: int = 100) -> DataFrame:
    """Revenue and revenue at risk per plan name."""
    plans = revenue.groupBy("plan_name").agg(
        exact_sum("total_monthly_revenue").alias("total_revenue"),
        exact_sum("total_revenue_at_risk").alias("revenue_at_risk"),
    )
    return plans.orderBy(F.desc("total_revenue"), "plan_name").limit(limit)


def top_loaded_cells(heatmap: DataFrame, limit: int = 20) -> DataFrame:
    """Cells with the highest load score."""
    return (
        heatmap.select(
            "cell_id",
            "province",
            "district",
            "severity",
            "drop_call_rate_pct",
            "qoe_issue_rate_pct",
            "cell_load_score",
            "data_traffic_gb",
        )
        .orderBy(F.desc("cell_load_score"), "cell_id")
        .limit(limit)
    )


def high_risk_customers(customers: DataFrame, limit: int = 10) -> DataFrame:
    """High-risk customers with the greatest impact."""
    return top_risk_customers(customers.where(F.col("churn_risk_tier") == HIGH_RISK), limit)


def top_risk_customers(customers: DataFrame, limit: int = 100) -> DataFrame:
    """Customers of any tier with the greatest impact."""
    return (
        customers.select(*_CUSTOMER_COLUMNS)
        .orderBy(F.desc("customer_impact_score"), "subscriber_id")
        .limit(limit)
    )


def latest_events(bronze: DataFrame, limit: int = 10) -> DataFrame:
    """Newest raw events."""
    columns = (
        "event_id", "event_ts", "cell_id", "network_type", "event_type",
        "latency_ms", "packet_loss_pct", "rsrp", "sinr",
    )
    return bronze.select(*columns).orderBy(F.desc_nulls_last("event_ts"), "event_id").limit(limit)


def plan_list(plans: DataFrame) -> DataFrame:
    """All plans in id order."""
    return plans.select("plan_id", "plan_name", "monthly_fee").orderBy("plan_id")
