from datetime import timedelta

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidemark.plans.refresh import Lakehouse, RefreshOptions, Run
from tidemark.sources.tables import append_partitioned
from tidemark_checks import inputs

SF = "/root/testdata/sf0.001"
ORDER = {"plan_order": ("updated_at", "chg_offset"), "subscriber_order": ("updated_at", "chg_offset")}
EARLY, LATE = ts("2024-01-28 10:07:00"), ts("2024-01-30 12:00:00")


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """The inputs, stored once."""
    root = tmp_path_factory.mktemp("sources")
    frames = {
        "bts_metadata": inputs.cells(spark, SF),
        "bronze_telecom_events": inputs.events(spark, SF),
        "bronze_billing_plans": inputs.plans(spark, SF),
        "bronze_subscribers": inputs.subscribers(spark, SF),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in frames}


def options(as_of, **changes):
    return RefreshOptions(as_of=as_of, **ORDER, **changes)


def test_incremental_runs_equal_a_full_run(spark, folder, sources):
    whole, stepwise = Lakehouse(spark, f"{folder}/whole"), Lakehouse(spark, f"{folder}/step")
    assert whole.refresh(sources, options(LATE, full=True)).published
    assert stepwise.refresh(sources, options(EARLY)).published
    assert stepwise.refresh(sources, options(LATE)).published
    for name in ("silver_cell_events", "gold_network_kpis", "gold_customer_360", "gold_plan_revenue_impact"):
        expected = whole.tables(sources)[name]
        columns = [c for c in expected.columns if c != "updated_at"]
        assert rows(stepwise.tables(sources)[name], *columns) == rows(expected, *columns), name


def test_late_events_and_copies_on_other_days_are_counted(spark, folder, sources):
    """Half an hour of ingestion is delivered days late, with a copy of an old event on another day."""
    events = sources["bronze_telecom_events"].withColumn("event_date", F.to_date("event_ts"))
    gone = F.coalesce(F.hour("event_ts") == 9, F.lit(False))
    late = events.where(gone).withColumn("ingested_at", F.lit("2024-02-02 00:00:00").cast("timestamp_ntz"))
    moved = events.where(~gone & (F.col("event_id") == "1")).withColumn("event_ts", F.col("event_ts") + F.expr("interval 3 days"))
    moved = moved.withColumn("event_date", F.to_date("event_ts")).withColumn("ingested_at", F.lit("2024-02-02 00:00:01").cast("timestamp_ntz"))
    everything = {**sources, "bronze_telecom_events": events.where(~gone).unionByName(late).unionByName(moved)}
    house, whole = Lakehouse(spark, f"{folder}/late"), Lakehouse(spark, f"{folder}/all")
    assert house.refresh({**sources, "bronze_telecom_events": events.where(~gone)}, options(LATE)).published
    assert house.refresh(everything, options(LATE)).published
    assert whole.refresh(everything, options(LATE, full=True)).published
    for name in ("silver_cell_events", "gold_network_kpis", "gold_cell_heatmap", "gold_customer_360", "gold_plan_revenue_impact"):
        expected = whole.tables(everything)[name]
        columns = [c for c in expected.columns if c != "updated_at"]
        assert rows(house.tables(everything)[name], *columns) == rows(expected, *columns), name


def test_copies_on_other_days_win_or_lose_by_their_stamps(spark, folder, sources):
    """With files that are only added, and stamps older than those of the published run."""
    events, bronze = sources["bronze_telecom_events"], f"{folder}/bronze"
    append_partitioned(events, bronze)
    house, whole = Lakehouse(spark, f"{folder}/step"), Lakehouse(spark, f"{folder}/all")
    for number, (days, seconds) in enumerate([(0, 0), (2, 3667), (-1, -3667), (-1, 2 * 3667)]):
        if number:
            moved = {"event_ts": F.col("event_ts") + timedelta(days=days), "event_date": F.date_add("event_date", days)}
            moved["ingested_at"] = F.col("ingested_at") + timedelta(seconds=seconds)
            append_partitioned(events.where((F.hour("event_ts") == 9) & (F.dayofmonth("event_ts") % 3 == 0)).withColumns(moved), bronze)
        now = {**sources, "bronze_telecom_events": spark.read.parquet(bronze)}
        assert house.refresh(now, options(LATE)).published
        assert whole.refresh(now, options(LATE, full=True)).published
        for name in ("silver_cell_events", "gold_network_kpis", "gold_cell_heatmap", "gold_plan_revenue_impact"):
            expected = whole.tables(now)[name]
            columns = [c for c in expected.columns if c != "updated_at"]
            assert rows(house.tables(now)[name], *columns) == rows(expected, *columns), (number, name)


def test_a_run_without_changes_rebuilds_no_day(spark, folder, sources):
    append_partitioned(sources["bronze_telecom_events"], f"{folder}/bronze")
    house = Lakehouse(spark, f"{folder}/house")

    def run():
        assert house.refresh({**sources, "bronze_telecom_events": spark.read.parquet(f"{folder}/bronze")}, options(LATE)).published
        return house._publications.latest()

    first, second = run(), run()
    assert second["days"] == first["days"] and second["seen"] == first["seen"]
    # The same rows in other files: days are looked at, but none has changed.
    rewritten = spark.read.parquet(f"{folder}/bronze").repartition(3)
    append_partitioned(rewritten, f"{folder}/bronze-2")
    assert house.refresh({**sources, "bronze_telecom_events": spark.read.parquet(f"{folder}/bronze-2")}, options(LATE)).published
    third = house._publications.latest()
    assert third["seen"]["files"] != first["seen"]["files"] and third["seen"]["rows"] == first["seen"]["rows"]
    assert third["days"] == first["days"]


def test_only_days_that_may_hold_a_copy_are_read(spark, folder, sources):
    """One late event without copies: no ids, no silver of other days than its own."""
    events, bronze = sources["bronze_telecom_events"], f"{folder}/bronze"
    append_partitioned(events, bronze)
    house = Lakehouse(spark, f"{folder}/house")
    assert house.refresh({**sources, "bronze_telecom_events": spark.read.parquet(bronze)}, options(LATE)).published
    before = house._publications.latest()["days"]
    day = "2024-01-09"
    late = events.where(F.to_date("event_ts") == F.lit(day).cast("date")).limit(1).withColumn("event_id", F.lit("late"))
    append_partitioned(late.withColumn("event_date", F.to_date("event_ts")), bronze)
    read = []
    days = house._days

    def watched(publication, name, only=None, but=()):
        read.append((name, None if only is None else sorted(only), sorted(but)))
        return days(publication, name, only, but)

    house._days = watched
    assert house.refresh({**sources, "bronze_telecom_events": spark.read.parquet(bronze)}, options(LATE)).published
    ids = [only for name, only, _ in read if name == "event_ids" and only is not None]
    assert ids and all(set(only) <= {day} for only in ids)
    after = house._publications.latest()["days"]
    for name in ("silver_cell_events", "gold_network_kpis", "event_ids", "event_id_filters"):
        changed = {d for d in before[name]["folders"] if before[name]["folders"][d] != after[name]["folders"][d]}
        assert changed == {day}, name


def test_the_heatmap_reads_the_changed_days_only(spark, folder, sources):
    """Unless a cell has lost the row that was its latest, as the copies of these events have moved to an earlier day."""
    events, bronze = sources["bronze_telecom_events"], f"{folder}/bronze"
    last = events.where(events.event_ts.isNotNull() & (events.event_ts <= F.lit(LATE))).orderBy(F.desc("event_ts")).first()
    append_partitioned(events, bronze)
    house, whole = Lakehouse(spark, f"{folder}/step"), Lakehouse(spark, f"{folder}/all")
    assert house.refresh({**sources, "bronze_telecom_events": spark.read.parquet(bronze)}, options(LATE)).published
    window = F.col("event_ts") >= F.lit(last["event_ts"]) - timedelta(hours=12)
    moved = {"event_ts": F.col("event_ts") - timedelta(days=3), "event_date": F.date_sub("event_date", 3)}
    moved["ingested_at"] = F.col("ingested_at") + timedelta(days=9)
    append_partitioned(events.where(window).withColumns(moved), bronze)
    now = {**sources, "bronze_telecom_events": spark.read.parquet(bronze)}
    assert house.refresh(now, options(LATE)).published and whole.refresh(now, options(LATE, full=True)).published
    expected = whole.tables(now)["gold_cell_heatmap"]
    columns = [c for c in expected.columns if c != "updated_at"]
    found = rows(house.tables(now)["gold_cell_heatmap"], *columns)
    assert found == rows(expected, *columns)
    # A run without changes looks at no KPI row at all.
    run = Run(now, options(LATE), days=[])
    run.tables["gold_network_kpis"] = whole.tables(now)["gold_network_kpis"]
    run.published = {"changed": spark.createDataFrame([], run.tables["gold_network_kpis"].schema), "gold_cell_heatmap": house.tables(now)["gold_cell_heatmap"]}
    same = run.heatmap()
    assert rows(same, *columns) == found
    scanned = {f.split("/gold_")[1].split("/")[0] for f in same.inputFiles() if "/gold_" in f}
    assert scanned <= {"cell_heatmap"}


def test_a_failed_gate_leaves_the_publication_unchanged(spark, folder, sources):
    house = Lakehouse(spark, folder)
    assert house.refresh(sources, options(EARLY)).published
    before = rows(house.tables(sources)["gold_plan_revenue_impact"])
    moved = {**sources, "bts_metadata": sources["bts_metadata"].withColumn("latitude", F.lit(60.0))}
    result = house.refresh(moved, options(LATE, full=True))
    assert not result.published
    assert "gold_network_kpis.coordinate_box(latitude,longitude)" in result.failed
    assert rows(house.tables(sources)["gold_plan_revenue_impact"]) == before
    # Failures of layers outside the gate are reported, not blocking.
    assert result.report.where("table_name = 'stg_telecom_events' and status = 'fail'").count() > 0
    assert house.refresh(sources, options(LATE, full=True)).published


def test_gated_layers_are_a_choice(spark, folder, sources):
    result = Lakehouse(spark, folder).refresh(sources, options(LATE, gate_layers=("staging", "gold")))
    assert not result.published and "stg_telecom_events.accepted_values(network_type)" in result.failed


def test_models_can_be_selected_by_tag_or_layer(spark, folder, sources):
    house = Lakehouse(spark, folder)
    with pytest.raises(ValueError, match="never published"):
        house.refresh(sources, options(EARLY), ["billing"])
    house.refresh(sources, options(EARLY))
    kpis = house.tables(sources)["gold_network_kpis"].select("updated_at").distinct().collect()
    result = house.refresh(sources, options(LATE), ["billing"])
    assert result.published
    built = {r[0] for r in result.report.select("table_name").distinct().collect()} - set(sources)
    assert built == {"gold_customer_360", "gold_plan_revenue_impact"}
    tables = house.tables(sources)
    assert tables["gold_network_kpis"].select("updated_at").distinct().collect() == kpis
    assert tables["gold_customer_360"].first().updated_at == LATE


def test_nothing_published_yet(spark, folder, sources):
    with pytest.raises(FileNotFoundError):
        Lakehouse(spark, folder).tables(sources)
