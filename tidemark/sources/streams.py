"""Stream readers. All of them give the broker's columns, so jobs do not care which one is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BROKER_RECORD, struct

# The same record as JSON lines, where key and value are text.
_TEXT_RECORD = struct("key string, value string, timestamp timestamp, offset long, partition int")


def kafka_records(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """Records of one topic from its beginning, going on if old records were expired.

    Needs the Kafka connector on the class path. Pass ``maxOffsetsPerTrigger`` and
    ``minPartitions`` in ``options`` to bound a backlog's batches and to read wide.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    return reader.options(**(options or {})).load()


def file_records(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """The same records from a folder of JSON-lines files that grows."""
    reader = spark.readStream.schema(_TEXT_RECORD).options(**(options or {}))
    return _as_broker_records(reader.json(path))


def batch_records(spark: SparkSession, path: str) -> DataFrame:
    """One-off read of such a folder."""
    return _as_broker_records(spark.read.schema(_TEXT_RECORD).json(path))


def _as_broker_records(text: DataFrame) -> DataFrame:
    return text.select(*[F.col(f.name).cast(f.dataType) for f in BROKER_RECORD])


def write_records(records: DataFrame, path: str) -> None:
    """Append records (text or binary key and value) as JSON lines for :func:`file_records`; a log
    without partitions may leave that column out."""
    fields = [f for f in _TEXT_RECORD if f.name in records.columns or f.name != "partition"]
    records.select(*[F.col(f.name).cast(f.dataType) for f in fields]).write.mode("append").json(path)


def copy_records(spark: SparkSession, source: str, path: str) -> None:
    """Append the records of one such folder to another, line by line as they are."""
    spark.read.text(source).write.mode("append").text(path)
