import json
from pathlib import Path

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidemark.plans.gold import windowed_kpis
from tidemark.plans.silver import silver_events
from tidemark.plans.staging import stage_events
from tidemark.schemas import BRONZE_EVENT_COLUMNS, CELL_REFERENCE
from tidemark.session import CHANGELOG_SETTING
from tidemark.sources.streams import batch_records, copy_records, file_records, kafka_records, write_records
from tidemark.streaming import billing, epochs, telemetry
from tidemark_checks import streams


def event(event_id, at, **fields):
    base = {
        "event_id": event_id, "event_ts": at and f"2024-01-01T{at}.000Z", "cell_id": "c1", "event_type": "VOICE",
        "network_type": "4G", "call_status": "COMPLETED",
    }
    return json.dumps({**base, **fields})


def deliver(spark, landing, *values):
    data = [("k", value, i) for i, value in enumerate(values)]
    records = spark.createDataFrame(data, "key string, value string, offset long")
    write_records(records.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")), landing)


class Telemetry:
    """A telemetry job that is started again for each delivery."""

    def __init__(self, spark, folder):
        self.spark, self.root = spark, folder

    def run(self, *values):
        if values:
            deliver(self.spark, f"{self.root}/landing", *values)
        records = file_records(self.spark, f"{self.root}/landing")
        query = telemetry.bronze_job(records, f"{self.root}/checkpoint", f"{self.root}/bronze", None).start()
        query.awaitTermination()
        return query

    def bronze(self):
        return self.spark.read.parquet(f"{self.root}/bronze")


def test_copies_are_dropped_within_and_across_batches(spark, folder):
    job = Telemetry(spark, folder)
    job.run(event("1", "10:00:00"), event("1", "10:00:00"), event("2", "10:01:00"))
    job.run(event("1", "10:00:00"), event("2", "10:05:00"), event("3", "10:02:00"))
    assert rows(job.bronze(), "event_id") == [("1",), ("2",), ("3",)]
    assert set(job.bronze().columns) == set(BRONZE_EVENT_COLUMNS)


def test_late_events_are_dropped_and_can_be_found(spark, folder):
    job = Telemetry(spark, folder)
    job.run(event("1", "10:00:00"))
    for i, at in enumerate(("11:00:00", "11:01:00", "11:02:00")):
        job.run(event(f"filler{i}", at))
    job.run(event("late", "10:30:00"), event("in time", "10:55:00"))
    assert {r[0] for r in rows(job.bronze(), "event_id")} == {"1", "filler0", "filler1", "filler2", "in time"}
    landed = telemetry.typed_events(batch_records(spark, f"{folder}/landing"))
    assert rows(telemetry.missing_events(landed, job.bronze()), "event_id") == [("late",)]


def test_state_of_old_ids_is_dropped(spark, folder):
    job = Telemetry(spark, folder)
    job.run(*[event(f"{i}", f"10:{i:02d}:00") for i in range(30)])
    query = job.run(event("later", "13:00:00"))
    states = [op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]]
    assert states[-2:] == [1, 1]


def test_copies_of_one_event_are_spread_before_they_meet(spark, folder):
    job = Telemetry(spark, folder)
    query = job.run(*[event("hot", "10:00:00")] * 200, *[event(f"{i}", "10:01:00") for i in range(100)])
    assert job.bronze().count() == 101
    data = next(p for p in query.recentProgress if p["numInputRows"])
    counts = [op["customMetrics"]["numDroppedDuplicateRows"] for op in data["stateOperators"]]
    # At most one copy per slot is left for the task of the id.
    assert sum(counts) == 199 and min(counts) < telemetry.COPY_SLOTS


def test_a_micro_batch_writes_few_files_per_folder(spark, folder):
    job = Telemetry(spark, folder)
    job.run(*[event(f"{i}", "10:00:00") for i in range(500)])
    files = job.bronze().select(F.input_file_name()).distinct().count()
    assert files <= telemetry.FILES_PER_FOLDER


def test_state_partitions_are_chosen_per_job(spark, folder):
    deliver(spark, f"{folder}/landing", event("1", "10:00:00"))
    job = telemetry.bronze_job(file_records(spark, f"{folder}/landing"), f"{folder}/checkpoint", f"{folder}/bronze", None)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = telemetry.start_job(job, spark, 3)
    query.awaitTermination()
    assert {op["numShufflePartitions"] for p in query.recentProgress for op in p["stateOperators"]} == {3}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "3"


def test_a_job_that_stops_uploads_files_of_its_state_and_no_changes(spark, folder):
    def state_files(checkpoint):
        return {p.suffix for p in Path(checkpoint).glob("state/**/*.*")} & {".zip", ".changelog"}

    def run(name, snapshots, *values):
        deliver(spark, f"{folder}/{name}/landing", *values)
        records = file_records(spark, f"{folder}/{name}/landing")
        job = telemetry.bronze_job(records, f"{folder}/{name}/checkpoint", f"{folder}/{name}/bronze", None)
        telemetry.start_job(job, spark, 2, snapshots=snapshots).awaitTermination()
        return rows(spark.read.parquet(f"{folder}/{name}/bronze"), "event_id")

    before = spark.conf.get(CHANGELOG_SETTING)
    assert run("a", True, event("1", "10:00:00")) == [("1",)]
    assert state_files(f"{folder}/a/checkpoint") == {".zip"}
    assert run("b", False, event("1", "10:00:00")) == [("1",)]
    assert state_files(f"{folder}/b/checkpoint") == {".changelog"}
    # Ids are known after either kind of start, also where the kind changes on a checkpoint.
    for name, snapshots in (("a", False), ("b", True)):
        assert run(name, snapshots, event("1", "10:00:00"), event("2", "10:00:01")) == [("1",), ("2",)]
    assert spark.conf.get(CHANGELOG_SETTING) == before


def test_a_delivery_that_comes_again_is_copied_as_it_is(spark, folder):
    odd = event("1", "10:00:00", cell_id='line\nbreak "quoted" \u2028 end')
    deliver(spark, f"{folder}/all/0", odd, event("2", "10:00:01"), "not json")
    copy_records(spark, f"{folder}/all/0", f"{folder}/all/1")
    first, again = batch_records(spark, f"{folder}/all/0"), batch_records(spark, f"{folder}/all/1")
    assert rows(first) == rows(again) and first.count() == 3
    assert batch_records(spark, f"{folder}/all/*").count() == 6


def test_the_slices_of_a_query_are_made_once_for_all_deliveries(spark, folder, monkeypatch):
    made = []
    monkeypatch.setattr(streams, "write_records", lambda part, path: (made.append(path), write_records(part, path)))
    slices = streams._slices(
        spark.createDataFrame([("k", "v", at, 0) for at in ("2024-01-01", "2024-02-01")], "key string, value string, at string, offset long")
        .select("key", "value", F.col("at").cast("timestamp").alias("timestamp"), "offset"),
        ("2024-01-15",),
    )
    seen = []
    streams._deliver(slices, folder, lambda: seen.append(batch_records(spark, f"{folder}/*").count()), 2)
    assert (len(made), seen) == (2, [1, 2, 3, 4])


def test_restart_without_data_adds_nothing(spark, folder):
    job = Telemetry(spark, folder)
    job.run(event("1", "10:00:00"))
    job.run()
    assert job.bronze().count() == 1


def test_quarantine_keeps_reason_and_payload(spark, folder):
    deliver(
        spark, f"{folder}/landing", event("ok", "10:00:00"), event("no time", None), event(None, "10:00:00"), "not json",
        event("bad time", "10:00:00", event_ts="yesterday"),
    )
    records = file_records(spark, f"{folder}/landing")
    telemetry.quarantine_job(records, f"{folder}/checkpoint", f"{folder}/rejected", None).start().awaitTermination()
    rejected = spark.read.parquet(f"{folder}/rejected")
    assert rows(rejected, "event_id", "reason") == [
        (None, "missing_event_id"),
        (None, "missing_event_id"),
        ("bad time", "missing_event_ts"),
        ("no time", "missing_event_ts"),
    ]
    assert rejected.where("raw_payload = 'not json'").count() == 1


def test_table_sink(spark, folder):
    deliver(spark, f"{folder}/landing", event("1", "10:00:00"))
    rows_ = telemetry.bronze_stream(file_records(spark, f"{folder}/landing"))
    spark.sql(f"create database tidemark_test location '{folder}/db'")
    try:
        telemetry.table_append_job(rows_, f"{folder}/checkpoint", None).toTable("tidemark_test.events").awaitTermination()
        assert spark.table("tidemark_test.events").count() == 1
    finally:
        spark.sql("drop database tidemark_test cascade")


def test_stream_kpis_equal_batch_kpis_of_closed_windows(spark, folder):
    cells = spark.createDataFrame(
        [("c1", "P", "D", 10.0, 105.0, "R", "V", "b3", 1.0, None)], CELL_REFERENCE.simpleString()[7:-1].replace(":", " ")
    )
    landing = f"{folder}/landing"
    batches = [
        [event("1", "10:00:00"), event("2", "10:14:59", call_status="DROPPED"), event("1", "10:00:00")],
        [event("3", "10:15:00"), event("4", "10:20:00", event_type="DATA", download_mb=1.5)],
        [event("5", "10:50:00")],
    ]
    for batch in batches:
        deliver(spark, landing, *batch)
        events = telemetry.accepted_events(telemetry.typed_events(file_records(spark, landing)))
        rows_ = telemetry.kpi_stream(events, cells)
        telemetry.kpi_job(rows_, f"{folder}/checkpoint", f"{folder}/kpis", None).start().awaitTermination()
    typed = telemetry.typed_events(batch_records(spark, landing))
    silver = silver_events(stage_events(telemetry.accepted_events(typed)), cells)
    expected = windowed_kpis(silver).drop("updated_at").where("window_end <= timestamp'2024-01-01 10:40:00'")
    assert expected.count() == 2
    assert rows(spark.read.parquet(f"{folder}/kpis").select(expected.columns)) == rows(expected)


def subscriber(key, status, at, deleted="false"):
    return json.dumps({"subscriber_id": key, "status": status, "updated_at": at, "__deleted": deleted})


def test_both_billing_streams_upsert_and_a_replayed_batch_is_skipped(spark, folder):
    plans = billing.plan_table(spark, f"{folder}/plans")
    subscribers = billing.subscriber_table(spark, f"{folder}/subscribers", parts=2)

    def run():
        queries = billing.start_billing(
            file_records(spark, f"{folder}/plan_log"),
            file_records(spark, f"{folder}/subscriber_log"),
            billing.append_sink(plans),
            billing.append_sink(subscribers),
            f"{folder}/checkpoints",
            interval=None,
        )
        for query in queries:
            query.awaitTermination()

    deliver(spark, f"{folder}/plan_log", json.dumps({"plan_id": "P", "monthly_fee": 1.0, "updated_at": 1}))
    deliver(
        spark, f"{folder}/subscriber_log", subscriber("a", "active", 1), subscriber("a", "suspended", 2),
        subscriber("b", "active", 1),
    )
    run()
    assert rows(subscribers.read(), "subscriber_id", "status") == [("a", "suspended"), ("b", "active")]
    deliver(spark, f"{folder}/subscriber_log", subscriber("b", "active", 2, "true"), subscriber("a", "active", 1))
    version = plans.version()
    run()
    assert rows(subscribers.read(), "subscriber_id", "status") == [("a", "suspended")]
    assert rows(plans.read(), "plan_id", "monthly_fee") == [("P", 1.0)] and plans.version() == version


def test_the_append_sink_ignores_a_batch_it_has_seen(spark, folder):
    table = billing.subscriber_table(spark, folder, parts=2)
    sink = billing.append_sink(table, "test")
    schema = "subscriber_id string, change_ts int, change_epoch int, change_seq int, is_deleted boolean"
    sink(spark.createDataFrame([("a", 1, 0, 1, False)], schema), 0)
    sink(spark.createDataFrame([("b", 1, 0, 1, False)], schema), 0)
    sink(spark.createDataFrame([], schema), 1)
    assert (rows(table.read(), "subscriber_id"), table.version()) == ([("a",)], 0)
    with pytest.raises(ValueError, match="named writer"):
        billing.append_sink(table)(spark.createDataFrame([("a", 1, 0, 1, False)], schema), 2)


def test_deletes_without_their_old_row_reach_the_table(spark, folder):
    table = billing.subscriber_table(spark, f"{folder}/table", parts=1)

    def envelope(op, key, status):
        row = {"subscriber_id": key, "status": status, "updated_at": 1}
        return json.dumps({"before": None, "after": None if op == "d" else row, "op": op})

    data = [("a", envelope("c", "a", "active"), 0), ("b", envelope("c", "b", "active"), 1), ('{"subscriber_id": "a"}', envelope("d", "a", ""), 2)]
    records = spark.createDataFrame(data, "key string, value string, offset long")
    write_records(records.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")), f"{folder}/subs")
    spark.createDataFrame([], "key string, value string, offset long, timestamp timestamp").write.json(f"{folder}/plans")
    nothing = lambda batch, number: None
    queries = billing.start_billing(
        file_records(spark, f"{folder}/plans"), file_records(spark, f"{folder}/subs"), nothing, billing.append_sink(table),
        f"{folder}/checkpoints", None, enveloped=True,
    )
    for query in queries:
        query.awaitTermination()
    assert rows(table.read(), "subscriber_id") == [("b",)]


def span(first, last, p=0, below=None, above=None):
    return {"p": p, "first": first, "last": last, "below": below, "above": above}


def test_epochs_rise_when_the_log_starts_again_or_grows():
    first = epochs.next_epoch(None, [span(0, 9), span(5, 7, p=1)])
    assert first == {"epoch": 0, "newest": {"0": 9, "1": 7}}
    on = epochs.next_epoch(first, [span(10, 12)])
    assert on == {"epoch": 0, "newest": {"0": 12, "1": 7}}
    again = epochs.next_epoch(on, [span(0, 3)])
    assert again == {"epoch": 1, "newest": {"0": 3, "1": 7}}
    assert epochs.next_epoch(again, [span(0, 1, p=2)])["epoch"] == 2
    assert epochs.next_epoch(on, [span(0, 30, below=ts("2024-01-01"), above=ts("2024-01-02"))])["epoch"] == 1
    with pytest.raises(epochs.LogOrderError, match="goes back"):
        epochs.next_epoch(on, [span(4, 20)])
    with pytest.raises(epochs.LogOrderError, match="in one batch"):
        epochs.next_epoch(on, [span(0, 30, below=ts("2024-01-02"), above=ts("2024-01-01"))])


def test_a_batch_without_a_clear_order_is_refused(spark, folder):
    schema = "k string, change_partition int, change_seq long, kafka_timestamp timestamp, v string"
    at = ts("2024-01-01")
    ledger = epochs.LogEpochs(folder)

    def assign(number, *data):
        return ledger.assign(spark.createDataFrame([(k, p, s, at, v) for k, p, s, v in data], schema), number, ["k"])

    with pytest.raises(epochs.LogOrderError, match="several partitions"):
        assign(0, ("a", 0, 1, "x"), ("a", 1, 1, "y"))
    with pytest.raises(epochs.LogOrderError, match="offset 1"):
        assign(0, ("a", 0, 1, "x"), ("b", 0, 1, "x"))
    # The same record twice is no contradiction, and a batch that is replayed keeps its epoch.
    assert rows(assign(0, ("a", 0, 1, "x"), ("a", 0, 1, "x"), (None, 1, 1, "x")), "change_epoch") == [(0,)] * 3
    assert rows(assign(1, ("a", 0, 0, "x")), "change_epoch") == [(1,)]
    assert rows(assign(1, ("a", 0, 0, "x")), "change_epoch") == [(1,)]
    assert rows(assign(2, ("a", 0, 1, "x")), "change_epoch") == [(1,)]
    assert rows(assign(3), "change_epoch") == []


def test_kafka_source_is_declared_with_its_options(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_records(spark, "localhost:1", "topic")
