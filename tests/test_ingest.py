"""The one-pass ingestion job: what each batch writes, what a replay leaves alone, what is shuffled."""

import json
from datetime import timedelta

import pytest
from helpers import plan, rows, ts
from pyspark.sql import functions as F

from tidemark.schemas import BRONZE_EVENT_COLUMNS
from tidemark.sources.files import MetadataFolder, child_folders
from tidemark.sources.streams import batch_records, file_records, write_records
from tidemark.streaming import ingest, telemetry


def event(event_id, at, **fields):
    base = {"event_id": event_id, "event_ts": at and f"2024-01-01T{at}.000Z", "cell_id": "c1", "event_type": "VOICE", "network_type": "4G"}
    return json.dumps({**base, **fields})


class Job:
    """The job, started again for each delivery."""

    def __init__(self, spark, folder):
        self.spark, self.root = spark, folder
        self.outputs = ingest.Outputs(*[f"{folder}/{n}" for n in ("bronze", "quarantine", "late", "state")])

    def deliver(self, *values):
        data = [("k", value, i) for i, value in enumerate(values)]
        records = self.spark.createDataFrame(data, "key string, value string, offset long")
        write_records(records.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")), f"{self.root}/landing")

    def run(self, *values):
        if values:
            self.deliver(*values)
        records = file_records(self.spark, f"{self.root}/landing")
        query = ingest.ingest_job(records, f"{self.root}/checkpoint", self.outputs, None).start()
        query.awaitTermination()
        return query

    def ids(self, name):
        return [r[0] for r in rows(ingest.read_output(self.spark, getattr(self.outputs, name)), "event_id")]


@pytest.fixture
def job(spark, folder):
    return Job(spark, folder)


def test_a_batch_is_split_into_bronze_quarantine_and_late(spark, job):
    job.run(event("1", "10:00:00"), event("1", "10:00:00"), event("2", "10:01:00"), event(None, "10:00:00"), "not json")
    assert ingest.watermark_of(spark, job.outputs).replace(tzinfo=None) == ts("2024-01-01 09:51:00")
    job.run(event("1", "10:00:00"), event("3", "11:00:00"), event("untimed", None))
    job.run(event("late", "10:50:00"), event("late", "10:50:00"), event("in time", "10:50:01"), event("3", "11:00:00"))
    assert job.ids("bronze") == ["1", "2", "3", "in time"]
    assert job.ids("late") == ["late", "late"]
    rejected = ingest.read_output(spark, job.outputs.quarantine)
    assert rows(rejected, "event_id", "reason") == [
        (None, "missing_event_id"), (None, "missing_event_id"), ("untimed", "missing_event_ts"),
    ]
    assert set(ingest.read_output(spark, job.outputs.bronze).columns) == set(BRONZE_EVENT_COLUMNS)


def test_ids_are_forgotten_when_the_watermark_has_passed_them(spark, job):
    for hour in (10, 11, 12):
        job.run(*[event(f"{hour}-{i}", f"{hour}:{i:02d}:00") for i in range(30)])
    recent = MetadataFolder(spark, f"{job.outputs.state}/watermarks").latest()["recent"]
    # Those of the first hour are gone; those of the second had to be there for the third batch.
    assert [r["folder"] for r in recent] == ["ids/batch=000000000001", "ids/batch=000000000002"]


def test_a_replayed_batch_writes_the_same_again(spark, job):
    job.run(event("1", "10:00:00"))
    job.run(event("1", "10:00:00"), event("2", "10:05:00"), event("old", "09:00:00"))
    before = job.ids("bronze"), job.ids("late")
    typed = telemetry.typed_events(batch_records(spark, f"{job.root}/landing"))
    again = typed.where(F.col("event_id").isin("1", "2", "old")).dropDuplicates(["event_id"])
    # Before its commit reached the checkpoint, and after.
    MetadataFolder(spark, f"{job.outputs.state}/watermarks").expire(1)
    ingest._process(again, 1, job.outputs, telemetry.ALLOWED_LATENESS)
    assert job.ids("bronze")[:1] == ["1"] and "2" in job.ids("bronze")
    assert len(before[0]) == 2 and before[1] == ["old"]


def test_a_crash_between_the_outputs_repeats_nothing(spark, job, monkeypatch):
    job.run(event("1", "10:00:00"))
    job.deliver(event("1", "10:00:00"), event("2", "10:05:00"), event("old", "09:00:00"), "broken")
    put = MetadataFolder.put
    monkeypatch.setattr(MetadataFolder, "put", lambda self, number, document: 1 / 0)
    with pytest.raises(Exception, match="(?i)division by zero|ZeroDivision"):
        job.run()
    monkeypatch.setattr(MetadataFolder, "put", put)
    job.run()
    assert (job.ids("bronze"), job.ids("late")) == (["1", "2"], ["old"])
    assert ingest.read_output(spark, job.outputs.quarantine).count() == 1


def test_whole_events_are_shuffled_once(spark, job):
    job.deliver(*[event(f"{i}", "10:00:00") for i in range(50)])
    typed = telemetry.typed_events(batch_records(spark, f"{job.root}/landing"))
    accepted, _, _ = ingest.split_batch(typed, None)
    recent = spark.range(2_000_000).select(F.col("id").cast("string").alias("event_id"))
    text = plan(ingest.unique_in_batch(accepted, recent))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # One of the events, one of the ids alone; at most one row per id and map task is sent.
    assert len(exchanges) == 2 and text.count("WindowGroupLimit") == 2
    assert text.count("from_json") == 1


def test_a_small_batch_writes_few_files(spark, job):
    query = job.run(*[event(f"{i}", "10:00:00") for i in range(500)])
    assert all(not p["stateOperators"] for p in query.recentProgress)
    files = spark.read.parquet(job.outputs.bronze).select(F.input_file_name()).distinct().count()
    assert files <= 2
    assert child_folders(spark, job.outputs.bronze) == ["batch=000000000000"]


def test_nothing_was_written_yet(spark, job):
    assert ingest.watermark_of(spark, job.outputs) is None
    with pytest.raises(FileNotFoundError):
        ingest.read_output(spark, job.outputs.bronze)


def test_the_lateness_is_a_choice(spark, job):
    job.deliver(event("1", "10:00:00"))
    records = file_records(spark, f"{job.root}/landing")
    ingest.ingest_job(records, f"{job.root}/checkpoint", job.outputs, None, timedelta(hours=2)).start().awaitTermination()
    assert ingest.watermark_of(spark, job.outputs, timedelta(hours=2)).replace(tzinfo=None) == ts("2024-01-01 08:00:00")
