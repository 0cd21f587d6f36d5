"""The given tables in the shape of the library's inputs.

Each input is one SELECT that reads the same in Spark and DuckDB; only a few tokens differ. All
of them use their tables whole. Values are derived so that every rule meets data on both of its
sides: missing and mixed-case values, repeats, unknown cells and networks, deletes, ties.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import prepare

# The injected clock: before the newest event, so the future filter has rows to reject.
AS_OF = datetime(2024, 1, 30, 12, 0, 0)
# Events up to here (by event time) make the first part of incremental runs.
FIRST_CUT = datetime(2024, 1, 20, 6, 0, 0)

_TOKENS = {
    "spark": {
        "[props_k]": "cast(get_json_object(props, '$.k') as int)",
        "[t0]": "timestamp_ntz'2024-01-01 00:00:00'",
        "[text]": "string",
    },
    "duckdb": {
        "[props_k]": "cast(json_extract_string(props, '$.k') as int)",
        "[t0]": "timestamp '2024-01-01 00:00:00'",
        "[text]": "varchar",
    },
}

# Nation 24's cell was renamed, so its events find no cell; the capacity of cell 23 is unknown.
CELLS = """
select case when n_nationkey = 24 then concat(n_name, '_NEW') else n_name end as cell_id, n_name as province,
       concat('D', cast(n_nationkey as [text])) as district,
       8.5e0 + n_nationkey * 0.5e0 as latitude, 102.5e0 + n_nationkey * 0.25e0 as longitude, r_name as region,
       case n_nationkey % 3 when 0 then 'Ericsson' when 1 then 'Nokia' else 'Samsung' end as vendor,
       case n_nationkey % 3 when 0 then 'n78' when 1 then 'B3' else 'B7' end as band,
       case when n_nationkey = 23 then null else 0.25e0 + (n_nationkey % 4) * 0.25e0 end as site_capacity_gbps,
       cast('2024-01-01' as date) as active_from
from {nation} join {region} on n_regionkey = r_regionkey
"""

# Every event, and those with k = 13 once more: delivered again a minute later.
EVENTS = """
with k as (select *, [props_k] as k, user_id % 25 as c from {events}),
base as (
select cast(event_id as [text]) as event_id,
       case when event_id % 600 = 7 then null else ts end as event_ts,
       cast(user_id as [text]) as subscriber_id,
       case when event_id % 600 = 207 then null when event_id % 2 = 0 then concat('nation_', cast(c as [text]))
            else concat('NATION_', cast(c as [text])) end as cell_id,
       case when event_id % 600 = 407 then null when event_type in ('signup', 'error') then 'voice'
            else 'data' end as event_type,
       case when k = 50 then '3g' when k < 62 then '4g' else '5g' end as network_type,
       case when k % 7 = 0 then null when c % 3 = 0 then 'n78' when c % 3 = 1 then 'b3' else 'b7' end as band,
       case k % 4 when 0 then 'Android' when 1 then 'iOS' when 2 then 'iot_router' else 'mifi' end as device_type,
       case when event_type = 'error' and k < 4 then 'dropped' when event_type = 'error' and k < 6 then 'failed'
            when event_type in ('signup', 'error') then 'completed' end as call_status,
       case when event_type in ('signup', 'error') then cast(floor(value) as int) + 1 end as call_duration_sec,
       case when event_type = 'error' and k < 6 then case k % 2 when 0 then 'Congestion' else 'core_timeout' end
            end as drop_reason,
       case when event_type in ('view', 'click', 'purchase') then value end as download_mb,
       case when event_type in ('view', 'click', 'purchase') then k / 4.0e0 end as upload_mb,
       10.0e0 + value / 2.0e0 as latency_ms, k / 8.0e0 as jitter_ms, k / 49.0e0 as packet_loss_pct,
       -70.0e0 - k * 0.40625e0 as rsrp, 29.0e0 - k * 0.25e0 as sinr, 'driver' as source,
       ts + interval '30' second as ingested_at, k
from k),
copies as (
select * from base
union all
select event_id, event_ts, subscriber_id, cell_id, event_type, network_type, band, device_type, call_status,
       call_duration_sec, drop_reason, download_mb, upload_mb, latency_ms, jitter_ms, packet_loss_pct, rsrp, sinr,
       source, ingested_at + interval '60' second, k
from base where k = 13)
select event_id, event_ts, subscriber_id, cell_id, event_type, network_type, band, device_type, call_status,
       call_duration_sec, drop_reason, download_mb, upload_mb, latency_ms, jitter_ms, packet_loss_pct, rsrp, sinr,
       source, ingested_at, cast(event_ts as date) as event_date, cast(extract(hour from event_ts) as int) as event_hour
from copies
"""

# One plan per part. Some are free, some have a negative fee, some are deleted.
PLANS = """
select concat('P', cast(p_partkey as [text])) as plan_id, p_name as plan_name,
       case p_partkey % 2 when 0 then 'Prepaid' else 'POSTPAID' end as plan_type,
       case p_partkey % 12 when 0 then 30000.0e0 when 1 then 90000.0e0 when 2 then 90000.0e0 when 3 then 120000.0e0
            when 4 then 200000.0e0 when 5 then 200000.0e0 when 6 then 300000.0e0 when 7 then 500000.0e0
            when 8 then 990000.0e0 when 9 then 0.0e0 when 10 then -1.0e0 else 150000.0e0 end as monthly_fee,
       case when p_partkey % 12 = 8 then null else p_size * 1.0e0 end as data_quota_gb,
       case when p_partkey % 3 = 0 then null else p_size * 100 end as voice_minutes,
       [t0] as created_at, [t0] as updated_at, p_partkey as chg_offset,
       p_partkey % 12 = 11 as is_deleted, [t0] as ingested_at
from {part}
"""

# A change log: about ten changes per customer, some deletes, statuses that staging rejects, and
# ties on (subscriber, updated_at) that only the offset decides.
SUBSCRIBERS = """
select cast(o_custkey as [text]) as subscriber_id, c_name as full_name,
       concat('P', cast(o_orderkey % 150 as [text])) as plan_id,
       concat('nation_', cast(c_nationkey as [text])) as home_cell_id,
       case when o_orderkey % 97 = 0 then 'ACTIVE' when o_orderstatus in ('F', 'O') then 'active'
            when o_totalprice < 100000 then 'terminated' else 'suspended' end as status,
       o_orderdate as activated_at, o_orderdate as updated_at, o_orderkey as chg_offset,
       o_orderkey % 50 = 0 as is_deleted, o_orderdate as ingested_at
from {orders} join {customer} on o_custkey = c_custkey
"""

_TABLES = ("region", "nation", "customer", "part", "orders", "events")


def input_sql(template: str, dialect: str) -> str:
    """The SELECT in one dialect; for DuckDB with the plain table names."""
    for token, text in _TOKENS[dialect].items():
        template = template.replace(token, text)
    if dialect == "duckdb":
        for table in _TABLES:
            template = template.replace("{" + table + "}", table)
    return template.strip()


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _input(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    prepare(spark)
    used = {t: given_table(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in template}
    return spark.sql(input_sql(template, "spark"), **used)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input(spark, sf_dir, CELLS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input(spark, sf_dir, EVENTS)


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input(spark, sf_dir, PLANS)


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input(spark, sf_dir, SUBSCRIBERS)


_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_EVENT_FIELDS = (
    "event_id", "event_ts", "subscriber_id", "cell_id", "event_type", "network_type", "band", "device_type",
    "call_status", "call_duration_sec", "drop_reason", "download_mb", "upload_mb", "latency_ms", "jitter_ms",
    "packet_loss_pct", "rsrp", "sinr", "source",
)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as broker records. Those without an event type arrive as broken JSON, and the
    time of those without one is unreadable text."""
    rows = events(spark, sf_dir)
    as_text = rows.withColumn(
        "event_ts", F.coalesce(F.date_format("event_ts", _ISO), F.lit("not a time"))
    )
    payload = F.to_json(F.struct(*_EVENT_FIELDS))
    return as_text.select(
        F.col("cell_id").cast("binary").alias("key"),
        F.when(F.col("event_type").isNull(), F.concat(F.lit("broken "), payload))
        .otherwise(payload)
        .cast("binary")
        .alias("value"),
        F.col("ingested_at").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("long").alias("offset"),
    )


def _change_row(rows: DataFrame, columns: list[str]) -> list:
    """Payload fields of a change; times as epoch milliseconds."""
    times = ("created_at", "updated_at", "activated_at")
    return [
        F.unix_millis(F.col(c).cast("timestamp")).alias(c) if c in times else F.col(c) for c in columns
    ]


_PLAN_FIELDS = [
    "plan_id", "plan_name", "plan_type", "monthly_fee", "data_quota_gb", "voice_minutes", "created_at", "updated_at",
]
_SUBSCRIBER_FIELDS = [
    "subscriber_id", "full_name", "plan_id", "home_cell_id", "status", "activated_at", "updated_at",
]


def _relayed():
    """Broker time: the connector is five minutes behind the rows."""
    return (F.col("updated_at").cast("timestamp") + F.expr("interval 5 minutes")).alias("timestamp")


def _change_records(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Flat change records; every second one wrapped in ``{"payload": ...}``."""
    mark = F.col("is_deleted").cast("string").alias("__deleted")
    flat = F.struct(*_change_row(rows, fields), mark)
    text = F.when(F.col("chg_offset") % 2 == 0, F.to_json(F.struct(flat.alias("payload")))).otherwise(F.to_json(flat))
    return rows.select(
        F.col(fields[0]).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        _relayed(),
        F.col("chg_offset").alias("offset"),
    )


def plan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change_records(plans(spark, sf_dir), _PLAN_FIELDS)


def subscriber_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _change_records(subscribers(spark, sf_dir), _SUBSCRIBER_FIELDS)


def subscriber_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes as before/after envelopes, each delete followed by a tombstone; every third delete
    brings no old row."""
    rows = subscribers(spark, sf_dir)
    image = F.struct(*_change_row(rows, _SUBSCRIBER_FIELDS))
    nothing = F.lit(None)
    deleted = F.col("is_deleted")
    envelope = F.struct(
        F.when(deleted & (F.col("chg_offset") % 3 != 0), image).otherwise(nothing).alias("before"),
        F.when(deleted, nothing).otherwise(image).alias("after"),
        F.when(deleted, "d").when(F.col("chg_offset") % 3 == 0, "c").otherwise("u").alias("op"),
    )
    key = F.col("subscriber_id").cast("binary").alias("key")
    times = _relayed(), F.col("chg_offset").alias("offset")
    changes = rows.select(key, F.to_json(envelope).cast("binary").alias("value"), *times)
    tombstones = rows.where("is_deleted").select(key, F.lit(None).cast("binary").alias("value"), *times)
    return changes.unionByName(tombstones)
