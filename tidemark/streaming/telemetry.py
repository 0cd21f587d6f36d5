"""Telemetry ingestion: decode, quarantine, deduplicate, append; and KPIs of closed windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.latest import latest_per_key
from tidemark.operators.lookup import DEFAULT_POLICY, LookupPolicy
from tidemark.plans.bronze import accepted_events, decode_events, quarantined_events, type_events
from tidemark.plans.gold import KPI_WINDOW, windowed_kpis
from tidemark.plans.silver import enrich_events, valid_events
from tidemark.plans.staging import stage_events
from tidemark.schemas import BRONZE_EVENT_COLUMNS
from tidemark.session import CHANGELOG_SETTING

# Fixed values of the ingestion job.
ALLOWED_LATENESS = timedelta(minutes=10)
TELEMETRY_TRIGGER = "20 seconds"
FOLDER_COLUMNS = ("event_date", "network_type")

COPY_SLOTS = 16
FILES_PER_FOLDER = 8


def _interval(duration: timedelta) -> str:
    return f"{int(duration.total_seconds())} seconds"


def trigger_options(interval: str | None) -> dict:
    """Fixed-interval micro-batches, or with no interval: work off what is there, then stop."""
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def start_job(
    job: DataStreamWriter, spark: SparkSession, state_partitions: int | None = None, snapshots: bool = False
) -> StreamingQuery:
    """Start a job with a chosen number of state partitions.

    The number is fixed with the first start on a checkpoint, so it should come from the expected
    state size and core count, not from the setting that batch queries happen to use.

    ``snapshots`` is for jobs that work off large batches and stop: each batch uploads the new files of the state
    store, where else it writes every change once more, and each start does every change again. A checkpoint can
    be gone on with either way.
    """
    settings = {}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if snapshots:
        settings[CHANGELOG_SETTING] = "false"
    before = {name: spark.conf.get(name, None) for name in settings}
    # A query takes a copy of the session's settings when it starts.
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return job.start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def typed_events(records: DataFrame, ingested_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Broker records to typed events, before any row is dropped."""
    return type_events(decode_events(records, keep), ingested_at)


def _arrival_slot(columns: Sequence[str], slots: int) -> Column:
    """Spreads the copies of an event by when they arrived; the same on every retry."""
    return F.pmod(F.xxhash64(*columns), F.lit(slots))


def unique_within_watermark(
    events: DataFrame,
    lateness: timedelta = ALLOWED_LATENESS,
    arrival: Sequence[str] = ("kafka_timestamp",),
    slots: int = COPY_SLOTS,
) -> DataFrame:
    """First copy of each event id, for as long as a copy can still arrive in time.

    The state of an id is dropped once the watermark has passed it, so the state store holds
    about ``lateness`` worth of ids. Deduplication by id alone would keep every id for ever.
    Rows older than the watermark are dropped; see :func:`missing_events`.

    A stream has no map-side combine for this, and all copies of one id go to one task. So the
    copies are first reduced per id and arrival slot, in ``slots`` tasks, and only what is left
    meets under the id. Without much repeated events, ``slots=1`` saves that first shuffle.
    """
    timed = events.withWatermark("event_ts", _interval(lateness))
    if slots > 1:
        spread = timed.withColumn("__slot", _arrival_slot(arrival, slots))
        timed = spread.dropDuplicatesWithinWatermark(["event_id", "__slot"]).drop("__slot")
    return timed.dropDuplicatesWithinWatermark(["event_id"])


def bronze_stream(
    records: DataFrame, lateness: timedelta = ALLOWED_LATENESS, slots: int = COPY_SLOTS
) -> DataFrame:
    """Accepted, deduplicated bronze events of a record stream."""
    position = [c for c in ("partition", "offset") if c in records.columns]
    accepted = accepted_events(typed_events(records, keep=position))
    unique = unique_within_watermark(accepted, lateness, ("kafka_timestamp", *position), slots)
    return unique.select(*BRONZE_EVENT_COLUMNS)


def append_job(
    rows: DataFrame,
    checkpoint: str,
    path: str,
    interval: str | None = TELEMETRY_TRIGGER,
    partition_cols: tuple[str, ...] = (),
) -> DataStreamWriter:
    """An append-only Parquet sink, ready to be started. Restarting it on the same checkpoint
    neither repeats nor skips rows."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**trigger_options(interval))
    )
    return writer.partitionBy(*partition_cols) if partition_cols else writer


def table_append_job(rows: DataFrame, checkpoint: str, interval: str | None = TELEMETRY_TRIGGER) -> DataStreamWriter:
    """The same for a catalog table; start it with ``toTable(name)``."""
    return (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(interval))
    )


def bronze_job(
    records: DataFrame,
    checkpoint: str,
    path: str,
    interval: str | None = TELEMETRY_TRIGGER,
    lateness: timedelta = ALLOWED_LATENESS,
    slots: int = COPY_SLOTS,
    files_per_folder: int = FILES_PER_FOLDER,
) -> DataStreamWriter:
    """Telemetry into the bronze event table, in folders by day and network type.

    After the deduplication every task holds rows of every folder. Rows are brought together per
    folder first, in ``files_per_folder`` groups, so a micro-batch writes that many files to a
    folder and not one per task. Choose it for files of about 128 MB at the expected rate.
    """
    group = F.pmod(F.xxhash64("event_id"), F.lit(files_per_folder))
    rows = bronze_stream(records, lateness, slots).repartition(*[F.col(c) for c in FOLDER_COLUMNS], group)
    return append_job(rows, checkpoint, path, interval, FOLDER_COLUMNS)


def quarantine_job(
    records: DataFrame, checkpoint: str, path: str, interval: str | None = TELEMETRY_TRIGGER
) -> DataStreamWriter:
    """Events without id or event time, kept with the reason. They are split off before the
    deduplication, where a null event time would be neither expired nor deduplicated."""
    return append_job(quarantined_events(typed_events(records)), checkpoint, path, interval)


def missing_events(landed: DataFrame, bronze: DataFrame) -> DataFrame:
    """Accepted events of a landing area that bronze does not hold: those that came too late.

    Both are batch frames, one result row per event. Copies are reduced before the join, so a
    much repeated id stays small; limit both sides to the same days on a long history.
    """
    accepted = latest_per_key(accepted_events(landed), ["event_id"], ["kafka_timestamp"])
    return accepted.join(bronze.select("event_id"), "event_id", "left_anti")


def kpi_stream(
    events: DataFrame,
    cells: DataFrame,
    width: timedelta = KPI_WINDOW,
    lateness: timedelta = ALLOWED_LATENESS,
    policy: LookupPolicy = DEFAULT_POLICY,
    slots: int = COPY_SLOTS,
) -> DataFrame:
    """KPIs of closed windows over a bronze event stream, by the batch model's own expressions.

    The cell reference is a batch frame and is joined before the aggregation without a shuffle
    of the stream when it fits the broadcast limits.
    """
    valid = valid_events(stage_events(events).drop("raw_payload", "kafka_key"))
    unique = unique_within_watermark(valid, lateness, slots=slots)
    enriched = enrich_events(unique, cells, policy)
    return windowed_kpis(enriched, width).drop("updated_at")


def kpi_job(
    rows: DataFrame, checkpoint: str, path: str, interval: str | None = TELEMETRY_TRIGGER
) -> DataStreamWriter:
    """Append closed KPI windows."""
    return append_job(rows, checkpoint, path, interval)
