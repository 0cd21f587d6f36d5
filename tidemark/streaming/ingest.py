"""Telemetry ingestion in one pass: each micro-batch is parsed once and split into bronze, quarantine and late.

- *Quarantine*: events without id or time, with the reason.
- *Late*: events at or before the watermark, which is the newest event time of the batches before, less the
  allowed lateness. Spark's own watermark drops such rows without a trace; here they are an output.
- *Bronze*: one copy of each other event. Copies in the batch are reduced first, with at most one row per id
  and map task, then those are left out whose id came in an earlier batch that the watermark has not
  passed. Both share one shuffle by id, the only one that moves whole events, and adaptive
  execution joins its partitions to files of useful size, so a batch has as many writers as its bytes need.

Every output is a folder per batch. A batch that is replayed after a crash finds the watermark and the recent ids
of the batch before it and writes the same folders again, so nothing is repeated or lost.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators.latest import latest_per_key
from tidemark.plans.bronze import accepted_events, quarantined_events
from tidemark.schemas import BRONZE_EVENT_COLUMNS
from tidemark.sources.files import MetadataFolder, finished_folders
from tidemark.streaming.telemetry import ALLOWED_LATENESS, FOLDER_COLUMNS, TELEMETRY_TRIGGER, trigger_options, typed_events

_BATCH = "batch"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_POSITION = ("partition", "offset")


@dataclass(frozen=True)
class Outputs:
    """The folders of the job. ``state`` keeps the ids that copies may still come of, and the watermarks."""

    bronze: str
    quarantine: str
    late: str
    state: str


def _batch_folder(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{_BATCH}={number:012d}"


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """What the job has written to one of its folders, whole batches only."""
    folders = [name for name in finished_folders(spark, path) if name.startswith(f"{_BATCH}=")]
    if not folders:
        raise FileNotFoundError(f"no batch was written to {path}")
    return spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{name}" for name in folders]).drop(_BATCH)


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def split_batch(typed: DataFrame, watermark: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accepted, quarantined and late rows of typed events; ``watermark`` in microseconds, None before any event."""
    accepted = accepted_events(typed)
    late = F.lit(False) if watermark is None else _micros("event_ts") <= F.lit(watermark)
    return accepted.where(~late), quarantined_events(typed), accepted.where(late)


def unique_in_batch(accepted: DataFrame, recent: DataFrame | None) -> DataFrame:
    """One copy of each event, without those whose id is in ``recent``."""
    arrival = [c for c in ("kafka_timestamp", *_POSITION) if c in accepted.columns]
    unique = latest_per_key(accepted, ["event_id"], arrival)
    return unique if recent is None else unique.join(recent.select("event_id"), "event_id", "left_anti")


def _process(batch: DataFrame, number: int, outputs: Outputs, lateness: timedelta) -> None:
    spark = batch.sparkSession
    # Streams run without it; this one has no state store whose partitions must stay as they are.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    ledger = MetadataFolder(spark, f"{outputs.state}/watermarks")
    before = ledger.latest_before(number) or {"newest": None, "recent": []}
    margin = lateness // timedelta(microseconds=1)
    watermark = None if before["newest"] is None else before["newest"] - margin
    # Ids of batches whose newest event has left the watermark behind by the lateness cannot come in time again.
    recent = [r for r in before["recent"] if watermark is None or r["newest"] + margin >= watermark]
    batch.persist()
    try:
        accepted, rejected, late = split_batch(batch, watermark)
        ids = spark.read.parquet(*[f"{outputs.state}/{r['folder']}" for r in recent]) if recent else None
        unique = unique_in_batch(accepted, ids).select(*BRONZE_EVENT_COLUMNS)
        unique.write.mode("overwrite").partitionBy(*FOLDER_COLUMNS).parquet(_batch_folder(outputs.bronze, number))
        rejected.write.mode("overwrite").parquet(_batch_folder(outputs.quarantine, number))
        late.select(*BRONZE_EVENT_COLUMNS).write.mode("overwrite").parquet(_batch_folder(outputs.late, number))
    finally:
        batch.unpersist()
    # From what was written, which is narrow and needs no parsing.
    schema = unique.select("event_id", "event_ts").schema
    written = spark.read.schema(schema).parquet(_batch_folder(outputs.bronze, number))
    newest = written.agg(F.max(_micros("event_ts"))).first()[0]
    if newest is not None:
        folder = f"ids/{_BATCH}={number:012d}"
        written.hint("rebalance").write.mode("overwrite").parquet(f"{outputs.state}/{folder}")
        recent.append({"folder": folder, "newest": newest})
    times = [t for t in (before["newest"], newest) if t is not None]
    ledger.put(number, {"newest": max(times, default=None), "recent": recent})
    ledger.expire(100)


def ingest_job(
    records: DataFrame,
    checkpoint: str,
    outputs: Outputs,
    interval: str | None = TELEMETRY_TRIGGER,
    lateness: timedelta = ALLOWED_LATENESS,
) -> DataStreamWriter:
    """The job, ready to be started."""
    position = [c for c in _POSITION if c in records.columns]

    def write(batch: DataFrame, number: int) -> None:
        _process(batch, number, outputs, lateness)

    return (
        typed_events(records, keep=position)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(interval))
    )


def watermark_of(spark: SparkSession, outputs: Outputs, lateness: timedelta = ALLOWED_LATENESS) -> datetime | None:
    """Events up to here would be late in the next batch."""
    known = MetadataFolder(spark, f"{outputs.state}/watermarks").latest()
    if known is None or known["newest"] is None:
        return None
    return _EPOCH + timedelta(microseconds=known["newest"]) - lateness
