from datetime import timedelta

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidemark.plans import gold, silver, staging
from tidemark.schemas import BRONZE_EVENT_COLUMNS

_DEFAULTS = dict(
    event_id="e1", event_ts=ts("2024-01-01 10:07:00"), subscriber_id="s", cell_id="c1", event_type="voice",
    network_type="4g", band="b3", device_type="Android", call_status="completed", call_duration_sec=10,
    drop_reason=None, download_mb=None, upload_mb=None, latency_ms=None, jitter_ms=None, packet_loss_pct=None,
    rsrp=None, sinr=None, source="x", kafka_key="K", kafka_timestamp=ts("2024-01-01 10:08:00"), raw_payload="{}",
    ingested_at=ts("2024-01-01 10:08:00"), event_date=ts("2024-01-01").date(), event_hour=10,
)
_TYPES = dict(
    event_ts="timestamp_ntz", call_duration_sec="int", download_mb="double", upload_mb="double",
    latency_ms="double", jitter_ms="double", packet_loss_pct="double", rsrp="double", sinr="double",
    kafka_timestamp="timestamp_ntz", ingested_at="timestamp_ntz", event_date="date", event_hour="int",
)


def bronze(spark, *changes):
    schema = ", ".join(f"{c} {_TYPES.get(c, 'string')}" for c in BRONZE_EVENT_COLUMNS)
    data = [tuple({**_DEFAULTS, **change}[c] for c in BRONZE_EVENT_COLUMNS) for change in changes]
    return spark.createDataFrame(data, schema)


def cells(spark, *rows_):
    schema = (
        "cell_id string, province string, district string, latitude double, longitude double, region string, "
        "vendor string, band string, site_capacity_gbps double"
    )
    return spark.createDataFrame([(c, "P", "D", 10.0, 105.0, "R", "V", band, cap) for c, band, cap in rows_], schema)


def test_staging_normalises_and_fills_traffic(spark):
    staged = staging.stage_events(bronze(spark, dict(download_mb=2.5, drop_reason="LOST")))
    row = staged.first()
    assert (row.cell_id, row.event_type, row.network_type, row.band) == ("C1", "VOICE", "4G", "B3")
    assert (row.device_type, row.drop_reason, row.call_status) == ("android", "lost", "COMPLETED")
    assert (row.download_mb, row.upload_mb, row.total_mb) == (2.5, 0.0, 2.5)


def test_staging_needs_id_and_time(spark):
    staged = staging.stage_events(bronze(spark, dict(event_id=None), dict(event_ts=None), dict(event_id="ok")))
    assert rows(staged, "event_id") == [("ok",)]


def test_call_failure_is_three_valued(spark):
    cases = {
        "voice-dropped": ("voice", "dropped", True),
        "voice-failed": ("voice", "FAILED", True),
        "voice-ok": ("voice", "completed", False),
        "voice-unknown": ("voice", None, None),
        "data-unknown": ("data", None, False),
        "unknown-dropped": (None, "dropped", None),
        "unknown-ok": (None, "completed", False),
    }
    staged = staging.stage_events(
        bronze(spark, *[dict(event_id=k, event_type=t, call_status=s) for k, (t, s, _) in cases.items()])
    )
    assert dict(rows(staged, "event_id", "is_call_failure")) == {k: v for k, (_, _, v) in cases.items()}


@pytest.mark.parametrize(
    "metrics,expected",
    [
        ({}, False),
        (dict(latency_ms=120.0), False),
        (dict(latency_ms=120.1), True),
        (dict(packet_loss_pct=2.0), False),
        (dict(packet_loss_pct=2.1), True),
        (dict(rsrp=-110.0), False),
        (dict(rsrp=-110.1), True),
        (dict(sinr=5.0), False),
        (dict(sinr=4.9), True),
    ],
)
def test_qoe_flag_limits_are_exclusive(spark, metrics, expected):
    assert staging.stage_events(bronze(spark, metrics)).first().has_qoe_issue is expected


def test_plan_staging(spark):
    t = ts("2024-01-01")
    frame = spark.createDataFrame(
        [
            ("P1", "old", "Prepaid", 1.0, None, None, t, t, False, t),
            ("P1", "new", "PREPAID", 2.0, None, 5, t, ts("2024-01-02"), False, t),
            ("P1", "deleted", "Prepaid", 3.0, None, None, t, ts("2024-01-03"), True, t),
            ("P2", "free", "Postpaid", 0.0, None, None, t, t, False, t),
            ("P3", "negative", "Postpaid", -1.0, None, None, t, t, False, t),
            ("P4", "unpriced", "Postpaid", None, None, None, t, t, False, t),
            (None, "nameless", "Postpaid", 1.0, None, None, t, t, False, t),
        ],
        "plan_id string, plan_name string, plan_type string, monthly_fee double, data_quota_gb double, "
        "voice_minutes int, created_at timestamp_ntz, updated_at timestamp_ntz, is_deleted boolean, "
        "ingested_at timestamp_ntz",
    )
    assert rows(staging.stage_plans(frame), "plan_id", "plan_name", "plan_type") == [
        ("P1", "new", "prepaid"),
        ("P2", "free", "postpaid"),
    ]


def test_subscriber_status_is_tested_before_it_is_lowered(spark):
    t = ts("2024-01-01")
    frame = spark.createDataFrame(
        [(k, "N", "P1", "cell", s, t, t, False, t) for k, s in [("a", "active"), ("b", "ACTIVE"), ("c", "terminated")]],
        "subscriber_id string, full_name string, plan_id string, home_cell_id string, status string, "
        "activated_at timestamp_ntz, updated_at timestamp_ntz, is_deleted boolean, ingested_at timestamp_ntz",
    )
    assert rows(staging.stage_subscribers(frame), "subscriber_id", "home_cell_id", "status") == [
        ("a", "CELL", "active"),
        ("c", "CELL", "terminated"),
    ]


def test_silver_filters_deduplicates_and_enriches(spark):
    as_of = ts("2024-01-01 10:02:00")
    events = bronze(
        spark,
        dict(event_id="kept", band=None),
        dict(event_id="kept", band="b7", ingested_at=ts("2024-01-01 10:07:59")),
        dict(event_id="on the limit", event_ts=ts("2024-01-01 10:07:00")),
        dict(event_id="future", event_ts=ts("2024-01-01 10:07:00.000001")),
        dict(event_id="3g", network_type="3g"),
        dict(event_id="no type", event_type=None),
        dict(event_id="no cell", cell_id=None),
        dict(event_id="unknown cell", cell_id="zz"),
    )
    result = silver.silver_events(staging.stage_events(events), cells(spark, ("c1", "n78", 1.0)), as_of)
    assert rows(result, "event_id", "band", "province") == [("kept", "N78", "P"), ("on the limit", "B3", "P")]


def kpis(spark, events, capacity=1.0, width=timedelta(minutes=15)):
    return gold.windowed_kpis(
        silver.silver_events(staging.stage_events(events), cells(spark, ("c1", "b3", capacity))), width
    )


def test_kpi_figures(spark):
    events = bronze(
        spark,
        dict(event_id="1", call_status="dropped", latency_ms=100.0),
        dict(event_id="2", latency_ms=201.0, event_ts=ts("2024-01-01 10:14:59")),
        dict(event_id="3", event_type="data", call_status=None, download_mb=1024.0, upload_mb=0.5),
        dict(event_id="4", event_ts=ts("2024-01-01 10:15:00")),
    )
    first, second = kpis(spark, events, capacity=2.0).orderBy("window_start").collect()
    assert (first.window_start, first.window_end) == (ts("2024-01-01 10:00:00"), ts("2024-01-01 10:15:00"))
    assert (first.total_events, first.total_calls, first.total_data_sessions) == (3, 2, 1)
    assert (first.dropped_calls, first.qoe_issue_events) == (1, 1)
    assert (first.data_traffic_gb, first.avg_latency_ms, first.avg_jitter_ms) == (1.0005, 150.5, None)
    assert (first.drop_call_rate_pct, first.qoe_issue_rate_pct) == (50.0, 33.333)
    assert first.cell_load_score == pytest.approx(1024.5 / 2048 * 100 + 2.0 + 1.5, abs=5e-4)
    assert (second.total_events, second.drop_call_rate_pct) == (1, 0.0)


def test_rates_without_calls_and_load_without_capacity_are_null(spark):
    events = bronze(spark, dict(event_type="data", call_status=None, download_mb=9999.0))
    row = kpis(spark, events, capacity=None).first()
    assert (row.drop_call_rate_pct, row.cell_load_score) == (None, None)
    assert kpis(spark, events, capacity=0.0).first().cell_load_score == 100.0


@pytest.mark.parametrize(
    "drop,qoe,load,expected",
    [
        (4.999, 17.999, 84.999, "WARNING"),
        (5.0, 0.0, 0.0, "CRITICAL"),
        (0.0, 18.0, 0.0, "CRITICAL"),
        (0.0, 0.0, 85.0, "CRITICAL"),
        (2.0, 0.0, 0.0, "WARNING"),
        (0.0, 10.0, 0.0, "WARNING"),
        (0.0, 0.0, 65.0, "WARNING"),
        (1.999, 9.999, 64.999, "NORMAL"),
        (None, None, None, "NORMAL"),
    ],
)
def test_severity_limits(spark, drop, qoe, load, expected):
    frame = spark.createDataFrame(
        [(drop, qoe, load)], "drop_call_rate_pct double, qoe_issue_rate_pct double, cell_load_score double"
    )
    assert gold.classify_severity(frame).first().severity == expected


def test_heatmap_takes_the_newest_window_and_breaks_ties_by_network(spark):
    events = bronze(
        spark,
        dict(event_id="1"),
        dict(event_id="2", event_ts=ts("2024-01-01 10:20:00")),
        dict(event_id="3", event_ts=ts("2024-01-01 10:21:00"), network_type="5g"),
    )
    assert rows(gold.cell_heatmap(kpis(spark, events)), "cell_id", "window_start", "network_type") == [
        ("C1", ts("2024-01-01 10:15:00"), "5G")
    ]


def customers(spark, cases):
    """Customers on one plan and one cell per case of (name, fee, severity)."""
    t = ts("2024-01-01")
    subscribers = spark.createDataFrame(
        [(name, "N", "active", t, name, name) for name, _, _ in cases] + [("gone", "N", "suspended", t, cases[0][0], "x")],
        "subscriber_id string, full_name string, status string, activated_at timestamp_ntz, plan_id string, "
        "home_cell_id string",
    )
    plans = spark.createDataFrame(
        [(name, "plan", "prepaid", fee, 1.0, 1) for name, fee, _ in cases],
        "plan_id string, plan_name string, plan_type string, monthly_fee double, data_quota_gb double, voice_minutes int",
    )
    heatmap = spark.createDataFrame(
        [(name, "P", "D", 1.0, 2.0, severity, 0.0, 0.0, 50.0, 9.0, 1.0) for name, _, severity in cases if severity],
        "cell_id string, province string, district string, latitude double, longitude double, severity string, "
        "drop_call_rate_pct double, qoe_issue_rate_pct double, cell_load_score double, avg_latency_ms double, "
        "data_traffic_gb double",
    )
    return gold.customer_360(subscribers, plans, heatmap)


def test_churn_tiers(spark):
    expected = {
        ("CRITICAL", None): "MEDIUM_RISK",
        ("CRITICAL", 299_999.0): "MEDIUM_RISK",
        ("CRITICAL", 300_000.0): "HIGH_RISK",
        ("WARNING", None): "LOW_RISK",
        ("WARNING", 199_999.0): "LOW_RISK",
        ("WARNING", 200_000.0): "MEDIUM_RISK",
        ("NORMAL", 499_999.0): "LOW_RISK",
        ("NORMAL", 500_000.0): "MEDIUM_RISK",
        (None, 499_999.0): "LOW_RISK",
        (None, 500_000.0): "MEDIUM_RISK",
        (None, None): "LOW_RISK",
    }
    cases = [(f"{severity}/{fee}", fee, severity) for severity, fee in expected]
    result = dict(rows(customers(spark, cases), "subscriber_id", "churn_risk_tier"))
    assert result == {f"{severity}/{fee}": tier for (severity, fee), tier in expected.items()}


def test_impact_scores_and_missing_cells(spark):
    cases = [("c", 200_000.0, "CRITICAL"), ("w", 200_000.0, "WARNING"), ("n", 200_000.0, "NORMAL"), ("none", 200_000.0, None)]
    result = customers(spark, cases)
    scores = {"c": 300.0, "w": 150.0, "n": 50.0, "none": 0.0}
    assert dict(rows(result, "subscriber_id", "customer_impact_score")) == scores
    assert result.where(F.col("subscriber_id") == "none").first().home_cell_severity is None


def test_plan_revenue(spark):
    t = ts("2024-01-01")
    schema = (
        "plan_id string, plan_name string, plan_type string, monthly_fee double, data_quota_gb double, "
        "voice_minutes int, home_cell_severity string, churn_risk_tier string, home_cell_avg_latency double, "
        "home_cell_drop_rate double, customer_impact_score double"
    )

    def plan(name, fee, severities):
        return [(name, name, "prepaid", fee, 1.0, 1, s, "LOW_RISK", 10.0, 1.0, 2.0) for s in severities]

    data = (
        plan("critical", 10.0, ["CRITICAL"] * 3 + ["NORMAL"] * 7)
        + plan("limit", 10.0, ["CRITICAL"] * 2 + ["NORMAL"] * 8)
        + plan("healthy", 10.0, ["WARNING"] + ["NORMAL"] * 8 + [None])
        + plan("free", 0.0, ["CRITICAL"])
    )
    result = gold.plan_revenue_impact(spark.createDataFrame(data, schema), t)
    assert rows(result, "plan_id", "total_monthly_revenue", "total_revenue_at_risk", "revenue_at_risk_pct", "plan_health_status") == [
        ("critical", 100.0, 30.0, 30.0, "CRITICAL"),
        ("free", 0.0, 0.0, None, "HEALTHY"),
        ("healthy", 100.0, 10.0, 10.0, "HEALTHY"),
        ("limit", 100.0, 20.0, 20.0, "WARNING"),
    ]
    assert result.where("plan_id = 'healthy'").first().healthy_cell_subscribers == 9


def test_the_incremental_bound_is_a_window_start():
    assert gold.aligned_lower_bound(ts("2024-01-01 10:50:10")) == ts("2024-01-01 10:15:00")


def test_staging_casts_text_and_leaves_unknown_columns_out(spark):
    raw = spark.createDataFrame(
        [(7, "2024-01-01 10:00:00", "2024-01-01", "12.5", "3", "1.5", "2.5", None, "VOICE", "FAILED", "1", "2", "3", "x")],
        "event_id int, event_ts string, event_date string, latency_ms string, call_duration_sec string, download_mb string, "
        "upload_mb string, cell_id string, event_type string, call_status string, packet_loss_pct string, rsrp string, "
        "sinr string, batch string",
    )
    staged = staging.stage_events(raw)
    kinds = dict(staged.dtypes)
    assert "batch" not in kinds
    assert (kinds["event_id"], kinds["event_ts"], kinds["event_date"], kinds["latency_ms"]) == ("string", "timestamp", "date", "double")
    assert staged.first().total_mb == 4.0
    plans = spark.createDataFrame(
        [(1, 2, "A", "5", "1", "2", "2024-01-01", "2024-01-02", "2024-01-03", False, "x")],
        "plan_id int, plan_name int, plan_type string, monthly_fee string, data_quota_gb string, voice_minutes string, "
        "created_at string, updated_at string, ingested_at string, is_deleted boolean, batch string",
    )
    kinds = dict(staging.stage_plans(plans).dtypes)
    assert (kinds["plan_id"], kinds["plan_name"], kinds["updated_at"]) == ("string", "string", "timestamp") and "batch" not in kinds
    people = spark.createDataFrame(
        [(1, 2, 3, 4, "active", "2024-01-01", "2024-01-02", "2024-01-03", False)],
        "subscriber_id int, full_name int, plan_id int, home_cell_id int, status string, activated_at string, "
        "updated_at string, ingested_at string, is_deleted boolean",
    )
    kinds = dict(staging.stage_subscribers(people).dtypes)
    assert {kinds[c] for c in ("subscriber_id", "full_name", "plan_id", "home_cell_id")} == {"string"} and kinds["activated_at"] == "timestamp"
