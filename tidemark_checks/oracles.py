"""DuckDB SQL for every registered query.

The SQL is put together from named common table expressions; each query gets those it needs.
"""

from __future__ import annotations

import re

from tidemark_checks import inputs

AS_OF = f"timestamp '{inputs.AS_OF:%Y-%m-%d %H:%M:%S}'"
QUARTER_HOUR = "interval '15 minutes'"
FIRST_CUT = f"timestamp '{inputs.FIRST_CUT:%Y-%m-%d %H:%M:%S}'"


def _round(value: str, digits: int) -> str:
    scale = f"{10**digits}e0"
    return f"(sign({value}) * floor(abs({value}) * {scale} + 0.5e0) / {scale} + 0e0)"


def _sum(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(38, 12))) as double)"


def _avg(value: str) -> str:
    return f"({_sum(value)} / nullif(count({value}), 0))"


def _count_if(condition: str) -> str:
    return f"cast(count(*) filter (where {condition}) as bigint)"


def _latest(source: str, keys: str, order: str, columns: str = "*") -> str:
    ranking = ", ".join(f"{c} desc nulls last" for c in order.split(", "))
    return (
        f"select {columns} from {source} "
        f"qualify row_number() over (partition by {keys} order by {ranking}) = 1"
    )


_CELL = "cell_id, province, district, region, latitude, longitude, vendor, band, network_type"


def _kpis(source: str, width: str, updated_at: bool = True) -> str:
    """KPIs in two steps: raw aggregates, then the figures that follow from them."""
    return f"""
select window_start, window_start + {width} as window_end, {_CELL}, total_events, total_calls, total_data_sessions,
       dropped_calls, qoe_issue_events, {_round("mb / 1024e0", 4)} as data_traffic_gb,
       {_round("latency", 2)} as avg_latency_ms, {_round("jitter", 2)} as avg_jitter_ms,
       {_round("loss", 3)} as avg_packet_loss_pct, {_round("rsrp_mean", 2)} as avg_rsrp,
       {_round("sinr_mean", 2)} as avg_sinr,
       {_round("(100e0 * dropped_calls / nullif(total_calls, 0))", 3)} as drop_call_rate_pct,
       {_round("(100e0 * qoe_issue_events / nullif(total_events, 0))", 3)} as qoe_issue_rate_pct,
       case when site_capacity_gbps is not null then {_round("least(100e0, load)", 3)} end as cell_load_score
       {f", {AS_OF} as updated_at" if updated_at else ""}
from (select *, mb / greatest(site_capacity_gbps * 1024e0, 1e0) * 100e0 + dropped_calls * 2e0
             + qoe_issue_events * 1.5e0 as load
      from (select time_bucket({width}, event_ts) as window_start, {_CELL}, site_capacity_gbps,
                   count(*) as total_events, {_count_if("event_type = 'VOICE'")} as total_calls,
                   {_count_if("event_type = 'DATA'")} as total_data_sessions,
                   {_count_if("is_call_failure")} as dropped_calls, {_count_if("has_qoe_issue")} as qoe_issue_events,
                   coalesce({_sum("total_mb")}, 0e0) as mb, {_avg("latency_ms")} as latency,
                   {_avg("jitter_ms")} as jitter, {_avg("packet_loss_pct")} as loss, {_avg("rsrp")} as rsrp_mean,
                   {_avg("sinr")} as sinr_mean
            from {source} group by all))"""


def _heatmap(kpis: str) -> str:
    filled = ", ".join(
        f"coalesce({c}, 0e0) as {c}" for c in ("drop_call_rate_pct", "qoe_issue_rate_pct", "cell_load_score")
    )
    latest = _latest(kpis, "cell_id", "window_start, network_type, band", f"* replace ({filled})")
    return f"""
select * exclude (updated_at),
       case when drop_call_rate_pct >= 5 or qoe_issue_rate_pct >= 18 or cell_load_score >= 85 then 'CRITICAL'
            when drop_call_rate_pct >= 2 or qoe_issue_rate_pct >= 10 or cell_load_score >= 65 then 'WARNING'
            else 'NORMAL' end as severity, updated_at
from ({latest})"""


def _customers(heatmap: str) -> str:
    score = (
        "coalesce(monthly_fee, 0e0) / 100000e0 * (coalesce(home_cell_load_score, 0e0) / 100e0) * "
        "case home_cell_severity when 'CRITICAL' then 3e0 when 'WARNING' then 1.5e0 else 0.5e0 end * 100e0"
    )
    return f"""
select subscriber_id, full_name, status, activated_at, plan_id, plan_name, plan_type, monthly_fee, data_quota_gb,
       voice_minutes, home_cell_id, province, district, latitude, longitude, home_cell_severity, home_cell_drop_rate,
       home_cell_qoe_issue_rate, home_cell_load_score, home_cell_avg_latency, home_cell_traffic_gb,
       {_round(f"({score})", 2)} as customer_impact_score,
       case when home_cell_severity = 'CRITICAL' and monthly_fee >= 300000 then 'HIGH_RISK'
            when home_cell_severity = 'CRITICAL' or monthly_fee >= 500000
                 or (home_cell_severity = 'WARNING' and monthly_fee >= 200000) then 'MEDIUM_RISK'
            else 'LOW_RISK' end as churn_risk_tier, {AS_OF} as updated_at
from (select s.subscriber_id, s.full_name, s.status, s.activated_at, p.plan_id, p.plan_name, p.plan_type,
             p.monthly_fee, p.data_quota_gb, p.voice_minutes, s.home_cell_id, h.province, h.district, h.latitude,
             h.longitude, h.severity as home_cell_severity, h.drop_call_rate_pct as home_cell_drop_rate,
             h.qoe_issue_rate_pct as home_cell_qoe_issue_rate, h.cell_load_score as home_cell_load_score,
             h.avg_latency_ms as home_cell_avg_latency, h.data_traffic_gb as home_cell_traffic_gb
      from subs_current s join plans_stg p on s.plan_id = p.plan_id left join {heatmap} h on s.home_cell_id = h.cell_id
      where s.status = 'active')"""


def _revenue(customers: str, updated_at: bool = True) -> str:
    plan = "plan_id, plan_name, plan_type, monthly_fee, data_quota_gb, voice_minutes"
    return f"""
select {plan}, subscriber_count, critical_cell_subscribers, warning_cell_subscribers, healthy_cell_subscribers,
       total_monthly_revenue, critical_revenue_at_risk, total_revenue_at_risk, high_risk_subscribers,
       medium_risk_subscribers, {_round("latency", 2)} as avg_subscriber_latency_ms,
       {_round("drop_rate", 3)} as avg_subscriber_drop_rate, {_round("impact", 2)} as avg_impact_score,
       {f"{AS_OF} as updated_at," if updated_at else ""}
       {_round("(total_revenue_at_risk / nullif(total_monthly_revenue, 0e0) * 100e0)", 2)} as revenue_at_risk_pct,
       case when critical_revenue_at_risk / nullif(total_monthly_revenue, 0e0) > 0.2e0 then 'CRITICAL'
            when total_revenue_at_risk / nullif(total_monthly_revenue, 0e0) > 0.15e0 then 'WARNING'
            else 'HEALTHY' end as plan_health_status
from (select *, {_round("(cast(subscriber_count as double) * monthly_fee)", 2)} as total_monthly_revenue,
             {_round("(cast(critical_cell_subscribers as double) * monthly_fee)", 2)} as critical_revenue_at_risk,
             {_round("(cast(critical_cell_subscribers + warning_cell_subscribers as double) * monthly_fee)", 2)}
                 as total_revenue_at_risk
      from (select {plan}, count(*) as subscriber_count,
                   {_count_if("home_cell_severity = 'CRITICAL'")} as critical_cell_subscribers,
                   {_count_if("home_cell_severity = 'WARNING'")} as warning_cell_subscribers,
                   {_count_if("coalesce(home_cell_severity, 'NORMAL') = 'NORMAL'")} as healthy_cell_subscribers,
                   {_count_if("churn_risk_tier = 'HIGH_RISK'")} as high_risk_subscribers,
                   {_count_if("churn_risk_tier = 'MEDIUM_RISK'")} as medium_risk_subscribers,
                   {_avg("home_cell_avg_latency")} as latency, {_avg("home_cell_drop_rate")} as drop_rate,
                   {_avg("customer_impact_score")} as impact
            from {customers} group by all))"""


_VALID = "cell_id is not null and event_type in ('VOICE', 'DATA') and network_type in ('4G', '5G')"
_ENRICHED = """
select e.* replace (coalesce(e.band, upper(c.band)) as band), c.province, c.district, c.region, c.latitude,
       c.longitude, c.vendor, c.site_capacity_gbps
from {events} e join cells c on e.cell_id = upper(c.cell_id)"""
_SUBSCRIBER_VALID = "not is_deleted and subscriber_id is not null and status in ('active', 'suspended', 'terminated')"
_SUBSCRIBER_STAGED = (
    "subscriber_id, full_name, plan_id, upper(home_cell_id) as home_cell_id, lower(status) as status, "
    "activated_at, updated_at, ingested_at"
)
_LATE_LIMIT = "interval '10' minute"

CTES: dict[str, str] = {
    "cells": inputs.input_sql(inputs.CELLS, "duckdb"),
    "ev_raw": inputs.input_sql(inputs.EVENTS, "duckdb"),
    "plans_raw": inputs.input_sql(inputs.PLANS, "duckdb"),
    "subs_raw": inputs.input_sql(inputs.SUBSCRIBERS, "duckdb"),
    # Records with a missing type were delivered as broken text.
    "ev_read": "select * from ev_raw where event_type is not null",
    "ev_stg": """
select *, download_mb + upload_mb as total_mb,
       event_type = 'VOICE' and call_status in ('DROPPED', 'FAILED') as is_call_failure,
       coalesce(latency_ms, 0) > 120 or coalesce(packet_loss_pct, 0) > 2 or coalesce(rsrp, 0) < -110
           or coalesce(sinr, 99) < 5 as has_qoe_issue
from (select * replace (upper(cell_id) as cell_id, upper(event_type) as event_type,
                        upper(network_type) as network_type, upper(band) as band, lower(device_type) as device_type,
                        upper(call_status) as call_status, lower(drop_reason) as drop_reason,
                        coalesce(download_mb, 0e0) as download_mb, coalesce(upload_mb, 0e0) as upload_mb)
      from ev_raw where event_id is not null and event_ts is not null)""",
    "ev_valid": f"select * from ev_stg where {_VALID} and event_ts <= {AS_OF} + interval '5' minute",
    "ev_unique": _latest("ev_valid", "event_id", "ingested_at"),
    "silver": _ENRICHED.format(events="ev_unique"),
    "kpi_15m": _kpis("silver", QUARTER_HOUR),
    "kpi_1d": _kpis("silver", "interval '1 day'"),
    "heat_15m": _heatmap("kpi_15m"),
    "heat_1d": _heatmap("kpi_1d"),
    "plans_stg": _latest(
        "(select * replace (lower(plan_type) as plan_type) from plans_raw where not is_deleted and monthly_fee >= 0)",
        "plan_id",
        "updated_at, chg_offset",
        "* exclude (chg_offset, is_deleted)",
    ),
    "subs_stg": _latest(
        f"(select * from subs_raw where {_SUBSCRIBER_VALID})",
        "subscriber_id",
        "updated_at, chg_offset",
        _SUBSCRIBER_STAGED,
    ),
    "subs_state": _latest("subs_raw", "subscriber_id", "chg_offset"),
    "subs_current": f"select {_SUBSCRIBER_STAGED} from subs_state where {_SUBSCRIBER_VALID}",
    "cust_15m": _customers("heat_15m"),
    "cust_1d": _customers("heat_1d"),
    "rev_15m": _revenue("cust_15m"),
    "rev_1d": _revenue("cust_1d"),
    "stream_valid": f"select * from ev_stg where {_VALID}",
    "stream_unique": _latest("stream_valid", "event_id", "ingested_at"),
    "stream_silver": _ENRICHED.format(events="stream_unique"),
    "arrivals": "select *, coalesce(device_type, '') = 'mifi' as late from ev_read where event_ts is not null",
}
# Copies of events on other days: newer ones three days later, older ones two days earlier.
CTES["ev_moved"] = """
select * from ev_raw
union all select * replace (event_ts + interval 3 day as event_ts, cast(event_date + interval 3 day as date) as event_date,
                            ingested_at + interval 3667 second as ingested_at) from ev_raw where hour(event_ts) = 9
union all select * replace (event_ts - interval 2 day as event_ts, cast(event_date - interval 2 day as date) as event_date,
                            ingested_at - interval 3667 second as ingested_at) from ev_raw where hour(event_ts) = 10"""
CTES["moved_stg"] = CTES["ev_stg"].replace("ev_raw", "ev_moved")
CTES["moved_valid"] = CTES["ev_valid"].replace("ev_stg", "moved_stg")
CTES["moved_unique"] = _latest("moved_valid", "event_id", "ingested_at, event_ts")
CTES["moved_silver"] = _ENRICHED.format(events="moved_unique")


def _needed(sql: str) -> list[str]:
    """Names of the expressions that ``sql`` uses, directly or not, in the order of CTES."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & CTES.keys() - found:
            found.add(name)
            pending.append(CTES[name])
    return [name for name in CTES if name in found]


def _query(sql: str) -> str:
    names = _needed(sql)
    if not names:
        return sql
    return "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in names) + "\n" + sql


_PARSED_CHANGES = (
    "select subscriber_id, full_name, plan_id, home_cell_id, status, activated_at, updated_at, "
    "chg_offset as change_seq, is_deleted, "
    "case when is_deleted then updated_at + interval '5' minute else updated_at end as change_ts from {rows}"
)
# Every third delete comes without its old row: the key is all that is known.
_ENVELOPED = """(select * replace (
    case when bare then null else full_name end as full_name, case when bare then null else plan_id end as plan_id,
    case when bare then null else home_cell_id end as home_cell_id, case when bare then null else status end as status,
    case when bare then null else activated_at end as activated_at, updated_at as updated_at)
    from (select *, is_deleted and chg_offset % 3 = 0 as bare from subs_raw))"""
_ENVELOPED_CHANGES = _PARSED_CHANGES.format(rows=_ENVELOPED).replace(
    "activated_at, updated_at, ", "activated_at, case when bare then null else updated_at end as updated_at, ", 1
)
_PARSED_CHANGES = _PARSED_CHANGES.format(rows="subs_raw")

# One line per check of the report: table, relation, check, severity, violations.
_REPORT: list[tuple[str, str, str, str, str]] = []


def _check(table: str, relation: str, check: str, violations: str, severity: str = "error") -> None:
    _REPORT.append((table, relation, check, severity, violations))


def _not_null(table: str, relation: str, column: str, severity: str = "error") -> None:
    _check(table, relation, f"not_null({column})", _count_if(f"{column} is null"), severity)


def _unique(table: str, relation: str, column: str) -> None:
    repeated = f"(select {column} from {relation} where {column} is not null group by {column} having count(*) > 1)"
    _REPORT.append((table, repeated, f"unique({column})", "error", "count(*)"))


def _values(table: str, relation: str, column: str, values: str) -> None:
    _check(table, relation, f"accepted_values({column})", _count_if(f"{column} not in ({values})"))


def _range(table: str, relation: str, column: str, low: float, high: float) -> None:
    _check(table, relation, f"accepted_range({column})", _count_if(f"{column} < {low} or {column} > {high}"))


def _box(table: str, relation: str) -> None:
    outside = "not coalesce(latitude between 8 and 23.5 and longitude between 102 and 110.5, false)"
    _check(table, relation, "coordinate_box(latitude,longitude)", _count_if(outside))


def _not_empty(table: str, relation: str) -> None:
    _check(table, relation, "not_empty", "cast(case when count(*) = 0 then 1 else 0 end as bigint)")


def _build_report() -> str:
    statuses = "'active', 'suspended', 'terminated'"
    for column in ("cell_id", "latitude", "longitude"):
        _not_null("bts_metadata", "cells", column)
    _unique("bts_metadata", "cells", "cell_id")
    _range("bts_metadata", "cells", "latitude", 8.0, 23.5)
    _range("bts_metadata", "cells", "longitude", 102.0, 110.5)
    _not_null("bronze_telecom_events", "ev_raw", "event_id")
    _not_null("bronze_telecom_events", "ev_raw", "event_ts", "warn")
    _not_null("bronze_billing_plans", "plans_raw", "plan_name")
    _not_null("bronze_billing_plans", "plans_raw", "monthly_fee")
    _values("bronze_subscribers", "subs_state", "status", statuses)
    for column in ("event_id", "event_ts"):
        _not_null("stg_telecom_events", "ev_stg", column)
    _values("stg_telecom_events", "ev_stg", "event_type", "'VOICE', 'DATA'")
    _values("stg_telecom_events", "ev_stg", "network_type", "'4G', '5G'")
    _not_null("stg_billing_plans", "plans_stg", "plan_id")
    _unique("stg_billing_plans", "plans_stg", "plan_id")
    _not_null("stg_billing_plans", "plans_stg", "monthly_fee")
    _range("stg_billing_plans", "plans_stg", "monthly_fee", 0, 10000000)
    for column in ("subscriber_id", "plan_id"):
        _not_null("stg_subscribers", "subs_current", column)
    _unique("stg_subscribers", "subs_current", "subscriber_id")
    _values("stg_subscribers", "subs_current", "status", statuses)
    _box("silver_cell_events", "silver")
    for column in ("event_id", "cell_id", "latitude", "longitude"):
        _not_null("silver_cell_events", "silver", column)
    _unique("silver_cell_events", "silver", "event_id")
    orphans = "(select * from silver s where not exists (select 1 from cells c where c.cell_id = s.cell_id))"
    _check("silver_cell_events", orphans, "relationships(cell_id)", "count(*)")
    _not_empty("gold_network_kpis", "kpi_15m")
    _box("gold_network_kpis", "kpi_15m")
    for column in ("window_start", "cell_id"):
        _not_null("gold_network_kpis", "kpi_15m", column)
    for column in ("drop_call_rate_pct", "qoe_issue_rate_pct", "cell_load_score"):
        _range("gold_network_kpis", "kpi_15m", column, 0, 100)
    _box("gold_cell_heatmap", "heat_15m")
    _not_null("gold_cell_heatmap", "heat_15m", "cell_id")
    _unique("gold_cell_heatmap", "heat_15m", "cell_id")
    _values("gold_cell_heatmap", "heat_15m", "severity", "'NORMAL', 'WARNING', 'CRITICAL'")
    for table, relation, key, state, values in (
        ("gold_customer_360", "cust_15m", "subscriber_id", "churn_risk_tier", "'HIGH_RISK', 'MEDIUM_RISK', 'LOW_RISK'"),
        ("gold_plan_revenue_impact", "rev_15m", "plan_id", "plan_health_status", "'CRITICAL', 'WARNING', 'HEALTHY'"),
    ):
        _not_empty(table, relation)
        _not_null(table, relation, key)
        _unique(table, relation, key)
        _values(table, relation, state, values)
    lines = [
        f"select '{table}' as table_name, '{check}' as check_name, '{severity}' as severity, "
        f"{violations} as violations from {relation}"
        for table, relation, check, severity, violations in _REPORT
    ]
    return "select *, case when violations = 0 then 'pass' else 'fail' end as status from (" + (
        "\nunion all ".join(lines) + ")"
    )


_CUSTOMER_COLUMNS = (
    "subscriber_id, full_name, plan_name, monthly_fee, home_cell_severity, churn_risk_tier, customer_impact_score"
)
_EVENT_FIELDS = (
    "event_id, event_ts, subscriber_id, cell_id, event_type, network_type, band, device_type, call_status, "
    "call_duration_sec, drop_reason, download_mb, upload_mb, latency_ms, jitter_ms, packet_loss_pct, rsrp, sinr, source"
)

_BODIES: dict[str, str] = {
    "stg_telecom_events": "select * from ev_stg",
    "dedup_latest_event": "select * from ev_unique",
    "silver_cell_events": "select * from silver",
    "network_kpis_15m": "select * from kpi_15m",
    "network_kpis_1d": "select * from kpi_1d",
    "cell_heatmap": "select * from heat_15m",
    "cell_heatmap_1d": "select * from heat_1d",
    "stg_billing_plans": "select * from plans_stg",
    "stg_subscribers": "select * from subs_stg",
    "customer_360": "select * from cust_15m",
    "customer_360_1d": "select * from cust_1d",
    "plan_revenue_impact": "select * from rev_15m",
    "plan_revenue_impact_1d": "select * from rev_1d",
    "parse_json_events": (
        f"select {_EVENT_FIELDS}, cell_id as kafka_key, ingested_at as kafka_timestamp, ingested_at, event_date, "
        "event_hour from ev_read"
    ),
    "quarantine_events": (
        "select case when event_type is null then 'missing_event_id' else 'missing_event_ts' end as reason, "
        "count(*) as n_rows from ev_raw where event_type is null or event_ts is null group by 1"
    ),
    "cdc_parse": _PARSED_CHANGES,
    "cdc_flatten_envelope": _ENVELOPED_CHANGES,
    "cdc_recreated_key": (
        f"select * from ({_PARSED_CHANGES}) where subscriber_id in (select subscriber_id from subs_raw where is_deleted) "
        "qualify row_number() over (partition by subscriber_id order by change_seq desc) = 1 and not is_deleted"
    ),
    "kpi_late_arrivals": _kpis("silver", QUARTER_HOUR, updated_at=False),
    "kpi_moved_copies": _kpis("moved_silver", QUARTER_HOUR, updated_at=False),
    # Within the old and the new log the position decides, between them the newest time.
    "cdc_restarted_log": f"""
select subscriber_id, full_name, plan_id, home_cell_id, status, activated_at, updated_at
from (select *, max(change_ts) over log as epoch_ts, row_number() over (log order by chg_offset desc) as place
      from (select *, chg_offset > (select max(chg_offset) // 2 from subs_raw) as epoch,
                   case when is_deleted then updated_at + interval '5' minute else updated_at end as change_ts
            from {_ENVELOPED})
      window log as (partition by subscriber_id, epoch))
where place = 1
qualify row_number() over (partition by subscriber_id order by epoch_ts desc, epoch desc) = 1 and not is_deleted""",
    "lookup_large_reference": (
        "select o_orderkey, o_custkey, o_totalprice, c_name, c_nationkey from orders join customer on o_custkey = c_custkey"
    ),
    "cdc_latest_state": "select * from subs_state",
    "cdc_upsert": "select * from subs_state where not is_deleted",
    "cdc_upsert_stored": "select * from subs_state where not is_deleted",
    "cdc_snapshot_plus_changes": """
select subscriber_id, full_name, plan_id, home_cell_id, status, activated_at, updated_at, chg_offset as change_seq,
       is_deleted, ingested_at
from (select * from subs_raw
      union all by name
      select cast(c_custkey as varchar) as subscriber_id, c_name as full_name, 'P0' as plan_id,
             'nation_' || c_nationkey as home_cell_id, 'active' as status, timestamp '1990-01-01' as activated_at,
             timestamp '1990-01-01' as updated_at, timestamp '1990-01-01' as ingested_at, false as is_deleted,
             cast(-1 as bigint) as chg_offset
      from customer)
qualify row_number() over (partition by subscriber_id order by chg_offset desc) = 1
    and not is_deleted""",
    "seed_reference": "select * from cells",
    "bronze_partitioned_write": "select * from ev_raw",
    "kpi_incremental_upsert": "select * from kpi_15m",
    "upsert_schema_sync": (
        "select window_start, cell_id, network_type, total_events, "
        f"case when window_start >= {FIRST_CUT} then qoe_issue_events end as qoe_issue_events from kpi_1d"
    ),
    "publish_audited": "select * exclude (updated_at) from rev_15m",
    "dq_not_null": "select event_id, cell_id, ingested_at from ev_raw where event_ts is null",
    "dq_unique": "select event_id, count(*) as n_records from ev_raw group by 1 having count(*) > 1",
    "dq_accepted_values": "select event_id, network_type, ingested_at from ev_stg where network_type not in ('4G', '5G')",
    "dq_relationships": (
        "select event_id, cell_id, ingested_at from ev_stg e where cell_id is not null "
        "and not exists (select 1 from cells c where c.cell_id = e.cell_id)"
    ),
    "dq_accepted_range": "select plan_id, monthly_fee from plans_raw where monthly_fee < 0 or monthly_fee > 500000",
    "dq_not_empty": (
        "select * from (select 'stg_telecom_events' as table_name, count(*) as row_count from ev_stg union all "
        "select 'unknown_network', count(*) from ev_stg where network_type = '2G') where row_count = 0"
    ),
    "dq_coordinate_box": (
        "select event_id, cell_id, latitude, longitude from silver "
        "where not (latitude between 12 and 23.5 and longitude between 102 and 107)"
    ),
    "dq_freshness": f"""
select max_loaded_at, {AS_OF} as checked_at,
       case when max_loaded_at is null or max_loaded_at < {AS_OF} - interval '30' minute then 'error'
            when max_loaded_at < {AS_OF} - interval '5' minute then 'warn' else 'pass' end as status
from (select max(ingested_at) as max_loaded_at from ev_raw)""",
    "dq_report": _build_report(),
    "serve_table_counts": (
        "select 'bronze_telecom_events' as table_name, count(*) as row_count from ev_raw union all "
        "select 'bronze_subscribers', count(*) from subs_state union all "
        "select 'gold_customer_360', count(*) from cust_15m union all "
        "select 'gold_plan_revenue_impact', count(*) from rev_15m"
    ),
    "serve_heatmap_points": (
        "select latitude, longitude, severity, cell_id, province, district, "
        f"{_round(_avg('cell_load_score'), 6)} as avg_cell_load_score from heat_1d group by all "
        "order by avg_cell_load_score desc, latitude, longitude, severity, cell_id limit 1000"
    ),
    "serve_drop_rate_trend": (
        f"select window_start as time_grain, cell_id, {_round(_avg('drop_call_rate_pct'), 6)} as avg_drop_call_rate "
        "from kpi_15m group by all order by time_grain desc, cell_id limit 10000"
    ),
    "serve_churn_breakdown": (
        "select churn_risk_tier, count(subscriber_id) as total_customers from cust_1d group by 1 "
        "order by 2 desc, 1 limit 100"
    ),
    "serve_revenue_by_plan": (
        f"select plan_name, {_sum('total_monthly_revenue')} as total_revenue from rev_15m group by 1 "
        "order by 2 desc, 1 limit 100"
    ),
    "serve_fee_vs_quality": (
        "select monthly_fee, subscriber_id, max(customer_impact_score) as impact_score from cust_1d group by 1, 2 "
        "order by 3 desc, 1, 2 limit 1000"
    ),
    "serve_revenue_at_risk": (
        f"select plan_name, {_sum('total_monthly_revenue')} as total_revenue, "
        f"{_sum('total_revenue_at_risk')} as revenue_at_risk from rev_1d group by 1 order by 2 desc, 1 limit 100"
    ),
    "serve_top_loaded_cells": (
        "select cell_id, province, district, severity, drop_call_rate_pct, qoe_issue_rate_pct, cell_load_score, "
        "data_traffic_gb from heat_1d order by cell_load_score desc, cell_id limit 20"
    ),
    "serve_high_risk_customers": (
        f"select {_CUSTOMER_COLUMNS} from cust_1d where churn_risk_tier = 'HIGH_RISK' "
        "order by customer_impact_score desc, subscriber_id limit 10"
    ),
    "serve_top_risk_customers": (
        f"select {_CUSTOMER_COLUMNS} from cust_1d order by customer_impact_score desc, subscriber_id limit 100"
    ),
    "serve_latest_events": (
        "select event_id, event_ts, cell_id, network_type, event_type, latency_ms, packet_loss_pct, rsrp, sinr "
        "from ev_raw order by event_ts desc nulls last, event_id limit 10"
    ),
    "serve_plan_list": "select plan_id, plan_name, monthly_fee from plans_raw order by plan_id",
    "stream_bronze_telemetry": (
        f"select distinct {_EVENT_FIELDS}, cell_id as kafka_key, event_date, event_hour from ev_read "
        "where event_ts is not null"
    ),
    "stream_restart_exactly_once": (
        "select event_date, count(distinct event_id) as n_rows, count(distinct event_id) as n_events from ev_read "
        "where event_ts is not null group by 1"
    ),
    "stream_dedup": "select distinct event_id, event_ts from ev_read where event_ts is not null",
    "stream_late_rows": (
        "select distinct event_id, event_ts from arrivals where late and event_ts <= "
        f"(select max(event_ts) from arrivals where not late) - {_LATE_LIMIT}"
    ),
    "stream_ingest": (
        f"select distinct {_EVENT_FIELDS}, cell_id as kafka_key, event_date, event_hour from ev_read "
        "where event_ts is not null"
    ),
    "stream_ingest_quarantine": (
        "select case when event_type is null then 'missing_event_id' else 'missing_event_ts' end as reason, "
        "case when event_type is not null then event_id end as event_id, date_trunc('millisecond', ingested_at) as kafka_timestamp "
        "from ev_raw where event_type is null or event_ts is null"
    ),
    "stream_quarantine": (
        "select case when event_type is null then 'missing_event_id' else 'missing_event_ts' end as reason, "
        "count(*) as n_rows from ev_raw where event_type is null or event_ts is null group by 1"
    ),
    "stream_network_kpis": (
        f"select * from ({_kpis('stream_silver', QUARTER_HOUR, updated_at=False)}) "
        f"where window_end <= (select max(event_ts) from stream_valid) - {_LATE_LIMIT}"
    ),
    "stream_cdc_upsert": (
        "select s.plan_id, subscriber_id, full_name, home_cell_id, status, s.updated_at, p.plan_name, p.monthly_fee "
        "from subs_state s left join plans_raw p on s.plan_id = p.plan_id and not p.is_deleted where not s.is_deleted"
    ),
}

ORACLES: dict[str, str] = {name: _query(body) for name, body in _BODIES.items()}
