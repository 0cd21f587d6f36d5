import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.jobs import main
from tidemark.plans.refresh import Lakehouse
from tidemark.schemas import BRONZE_EVENT_COLUMNS, struct
from tidemark.sources.streams import write_records
from tidemark.sources.tables import create_fact_table, register_views
from tidemark.streaming import billing

CELLS = """cell_id,province,district,latitude,longitude,region,vendor,band,site_capacity_gbps,active_from
C1,P,D,21.5,105.1,North,V,n78,0.001,2024-01-01
C2,P,D,{latitude},105.1,North,V,n78,18.0,2024-01-01
"""


def event(i):
    return {
        "event_id": f"e{i}", "event_ts": f"2024-01-01T10:{i:02d}:00Z", "cell_id": f"c{1 + i % 2}", "event_type": "voice",
        "network_type": "4g", "call_status": "dropped" if i % 4 == 0 else "completed", "latency_ms": 10.0 + i,
    }


def put(spark, folder, topic, values):
    data = [("k", json.dumps(v), i) for i, v in enumerate(values)]
    records = spark.createDataFrame(data, "key string, value string, offset long")
    write_records(records.withColumn("timestamp", F.lit("2024-01-01 12:00:00").cast("timestamp")), f"{folder}/in/{topic}")


def test_from_records_to_published_tables(spark, tmp_path):
    folder = str(tmp_path)
    put(spark, folder, "events", [event(i) for i in range(20)] + [event(3), {"event_id": "untimed"}])
    put(spark, folder, "plans", [{"plan_id": "P", "plan_name": "n", "plan_type": "X", "monthly_fee": 3e5, "updated_at": 1}])
    people = [("a", "active", "c1"), ("b", "active", "c2"), ("c", "suspended", "c1"), ("d", "active", None)]
    put(
        spark, folder, "subs",
        [{"subscriber_id": k, "status": s, "home_cell_id": c, "plan_id": "P", "updated_at": 1} for k, s, c in people],
    )
    common = ["--files", f"{folder}/in", "--once"]
    bronze, tables = ["--bronze", f"{folder}/bronze"], ["--tables", f"{folder}/tables"]
    checkpoints = ["--checkpoints", f"{folder}/checkpoints"]
    telemetry = ["telemetry", "--topic", "events", "--quarantine", f"{folder}/rejected", "--state-partitions", "2"]
    assert main([*telemetry, *common, *bronze, *checkpoints], spark) == 0
    billing_ = ["billing", "--plan-topic", "plans", "--subscriber-topic", "subs", "--subscriber-parts", "2"]
    assert main([*billing_, *common, *tables, *checkpoints], spark) == 0
    assert rows(spark.read.parquet(f"{folder}/rejected"), "event_id", "reason") == [("untimed", "missing_event_ts")]

    fresh = ["freshness", *bronze]
    assert main(fresh, spark) == 0  # loaded just now
    assert main([*fresh, "--as-of", "2099-01-01"], spark) == 1

    good, bad = tmp_path / "cells.csv", tmp_path / "bad.csv"
    good.write_text(CELLS.format(latitude=21.5))
    bad.write_text(CELLS.format(latitude=51.5))
    refresh = ["refresh", *bronze, *tables, "--lakehouse", f"{folder}/house", "--subscriber-parts", "2", "--cells"]
    assert main([*refresh, str(good), "--full"], spark) == 0
    assert main([*refresh, str(bad), "--full"], spark) == 1
    assert {r[0] for r in spark.read.parquet(f"{folder}/house/bts_metadata").select("latitude").collect()} == {21.5}

    sources = {
        "bts_metadata": spark.read.parquet(f"{folder}/house/bts_metadata"),
        "bronze_telecom_events": spark.read.parquet(f"{folder}/bronze"),
        "bronze_billing_plans": billing.plan_table(spark, f"{folder}/tables/billing_plans").read(),
        "bronze_subscribers": billing.subscriber_table(spark, f"{folder}/tables/subscribers", 2).read(),
    }
    register_views(Lakehouse(spark, f"{folder}/house").tables(sources))
    found = spark.sql("select subscriber_id, home_cell_severity, churn_risk_tier from gold_customer_360")
    assert rows(found) == [("a", "CRITICAL", "HIGH_RISK"), ("b", "NORMAL", "LOW_RISK"), ("d", None, "LOW_RISK")]


def test_one_source_must_be_named():
    with pytest.raises(SystemExit):
        main(["telemetry", "--topic", "t", "--bronze", "b", "--quarantine", "q", "--checkpoints", "c"])


def test_a_fact_table_is_declared_with_its_partitions(spark, tmp_path):
    schema = struct("event_id string, event_ts timestamp, event_date date, network_type string")
    spark.sql(f"create database tidemark_ddl location '{tmp_path}/db'")
    try:
        for _ in range(2):
            create_fact_table(spark, "tidemark_ddl.events", schema, properties={"target": "128"})
        columns = {c.name: c.isPartition for c in spark.catalog.listColumns("tidemark_ddl.events")}
        assert [c for c, partition in columns.items() if partition] == ["event_date", "network_type"]
        assert set(columns) < set(BRONZE_EVENT_COLUMNS)
    finally:
        spark.sql("drop database tidemark_ddl cascade")
