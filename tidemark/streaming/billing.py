"""Billing change capture: one idempotent change set per micro-batch and table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.changes import LOG_ORDER, parse_changes, parse_envelopes
from tidemark.operators.upsert import merge_into
from tidemark.schemas import PLAN_PAYLOAD, SUBSCRIBER_PAYLOAD
from tidemark.sources.changelog import ChangeTable
from tidemark.streaming.epochs import EPOCH, LogEpochs
from tidemark.streaming.telemetry import trigger_options

# Fixed values of the change-capture job.
CHANGE_TRIGGER = "30 seconds"
Sink = Callable[[DataFrame, int], None]


def plan_table(spark: SparkSession, path: str, parts: int = 1) -> ChangeTable:
    """Current billing plans; a small table, so its base is one file."""
    return _table(spark, path, "plan_id", parts)


def subscriber_table(spark: SparkSession, path: str, parts: int = 64) -> ChangeTable:
    """Current subscribers. Choose ``parts`` so that a file of the folded base is a few hundred megabytes."""
    return _table(spark, path, "subscriber_id", parts)


def _table(spark: SparkSession, path: str, key: str, parts: int) -> ChangeTable:
    return ChangeTable(spark, path, [key], LOG_ORDER, "is_deleted", parts, (EPOCH, "change_ts"))


def _query_id(batch: DataFrame) -> str:
    """Id of the running query; it belongs to the checkpoint and survives restarts."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("a batch outside of a stream needs a named writer")
    return found


def append_sink(table: ChangeTable, writer: str | None = None) -> Sink:
    """Append each micro-batch; one that is replayed after a crash changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.append(batch, batch_id, writer or _query_id(batch))

    return write


def merge_sink(table: str, keys: Sequence[str], order_cols: Sequence[str] = (EPOCH, *LOG_ORDER)) -> Sink:
    """The same through ``MERGE INTO``; a replay is harmless because it is not newer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_into(table, batch, keys, order_cols)

    return write


def change_job(
    records: DataFrame,
    schema: T.StructType,
    sink: Sink,
    checkpoint: str,
    interval: str | None = CHANGE_TRIGGER,
    enveloped: bool = False,
    key_column: str | None = None,
) -> DataStreamWriter:
    """One table's change stream, ready to be started.

    ``key_column`` is the column of the row's key, the first of the payload by default. A delete that
    brings no old row is found by the key of its record. Epochs are kept in a folder next to ``checkpoint``.
    """
    key = key_column or schema[0].name
    if enveloped:
        changes = parse_envelopes(records, schema, key, with_partition=True)
    else:
        changes = parse_changes(records, schema, with_partition=True)
    epochs = LogEpochs(f"{checkpoint.rstrip('/')}-epochs")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read for the epoch, the emptiness test and the sink
        try:
            sink(epochs.assign(batch, batch_id, [key]), batch_id)
        finally:
            batch.unpersist()

    return (
        changes.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(interval))
    )


def start_billing(
    plan_records: DataFrame,
    subscriber_records: DataFrame,
    plan_sink: Sink,
    subscriber_sink: Sink,
    checkpoints: str,
    interval: str | None = CHANGE_TRIGGER,
    enveloped: bool = False,
) -> list[StreamingQuery]:
    """Start both change streams in one application; each has its own checkpoint folder."""
    jobs = (
        ("billing_plans", plan_records, PLAN_PAYLOAD, plan_sink, "plan_id"),
        ("subscribers", subscriber_records, SUBSCRIBER_PAYLOAD, subscriber_sink, "subscriber_id"),
    )
    return [
        change_job(records, schema, sink, f"{checkpoints.rstrip('/')}/{name}", interval, enveloped, key)
        .queryName(f"changes-{name}")
        .start()
        for name, records, schema, sink, key in jobs
    ]
