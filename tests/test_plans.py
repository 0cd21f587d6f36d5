"""The physical plans of the heavy steps: what reaches the scan, what is shuffled, what is broadcast."""

from datetime import timedelta

import pytest
from helpers import plan, scan_details, ts

from tidemark.operators.changes import flatten_envelopes
from tidemark.operators.upsert import upsert
from tidemark.plans.gold import cell_heatmap, events_since, windowed_kpis
from tidemark.plans.serving import top_loaded_cells
from tidemark.plans.silver import silver_events
from tidemark.plans.staging import stage_events
from tidemark.schemas import SUBSCRIBER_PAYLOAD
from tidemark.sources.tables import append_partitioned
from tidemark_checks import inputs

SF = "/root/testdata/sf0.001"
AS_OF = ts("2024-01-30 12:00:00")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    append_partitioned(inputs.events(spark, SF), f"{root}/events")
    inputs.cells(spark, SF).write.parquet(f"{root}/cells")
    return spark.read.parquet(f"{root}/events"), spark.read.parquet(f"{root}/cells")


def test_silver_filters_at_the_scan_and_shuffles_once(spark, stored):
    events, cells = stored
    silver = silver_events(stage_events(events), cells, AS_OF)
    text, scan = plan(silver), scan_details(silver)
    assert "LessThanOrEqual(event_ts,2024-01-30T12:05" in scan["PushedFilters"]
    assert "IsNotNull(event_id)" in scan["PushedFilters"] and "IsNotNull(cell_id)" in scan["PushedFilters"]
    # The network type is a folder, so its filter skips folders.
    assert "upper(network_type" in scan["PartitionFilters"]
    assert text.count("Exchange hashpartitioning") == 1 and text.count("BroadcastHashJoin") == 1


def test_a_kpi_report_reads_only_the_columns_it_needs(spark, stored):
    events, cells = stored
    kpis = windowed_kpis(silver_events(stage_events(events), cells, AS_OF))
    text, scan = plan(kpis), scan_details(kpis)
    for unused in ("subscriber_id", "device_type", "drop_reason", "call_duration_sec", "source"):
        assert unused not in scan["ReadSchema"]
    # One shuffle by event for the deduplication, one by group with partial aggregates before it.
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_a_recent_window_skips_older_folders(spark, stored):
    events, _ = stored
    scan = scan_details(events_since(stage_events(events), ts("2024-01-30 10:00:00")))
    assert "event_date" in scan["PartitionFilters"]
    assert "GreaterThanOrEqual(event_ts,2024-01-30T10:00" in scan["PushedFilters"]


def test_the_top_list_is_not_a_full_sort(spark, stored):
    events, cells = stored
    kpis = windowed_kpis(silver_events(stage_events(events), cells, AS_OF), timedelta(days=1))
    assert plan(top_loaded_cells(cell_heatmap(kpis))).count("TakeOrderedAndProject") == 1


def test_an_upsert_shuffles_each_side_once(spark):
    schema = "k long, v string, t int"
    target = spark.createDataFrame([(1, "a", 1)], schema)
    text = plan(upsert(target, spark.createDataFrame([(1, "b", 2)], schema), ["k"], ["t"]))
    # The changes are reduced and joined on the same key, under one shuffle.
    assert text.count("Exchange hashpartitioning") == 2


def test_an_envelope_is_parsed_once(spark):
    flat = flatten_envelopes(inputs.subscriber_envelopes(spark, SF), SUBSCRIBER_PAYLOAD, "subscriber_id")
    # The filter on the parsed row would reach the join below it with parsers of its own.
    assert plan(flat).count("from_json") == 1
