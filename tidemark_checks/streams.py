"""Stream queries: the given tables delivered slice by slice to jobs that are restarted each time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.plans.bronze import accepted_events
from tidemark.schemas import SUBSCRIBER_PAYLOAD
from tidemark.session import shared_folder
from tidemark.sources.streams import copy_records, file_records, write_records
from tidemark.streaming import billing, ingest, telemetry
from tidemark_checks import inputs
from tidemark_checks.queries import Query, _zoneless

# Limits between slices, by arrival; together the slices are the whole table.
_EVENT_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
# Columns that hold the arrival of a copy, or text whose field order is not part of the result.
_ARRIVAL = ("kafka_timestamp", "ingested_at", "raw_payload")


def _slices(records: DataFrame, cuts: tuple[str, ...]) -> list[DataFrame]:
    limits = [F.lit(c).cast("timestamp") for c in cuts]
    arrival = F.col("timestamp")
    conditions: list[Column] = [arrival < limits[0]]
    conditions += [(arrival >= low) & (arrival < high) for low, high in zip(limits, limits[1:])]
    conditions += [arrival >= limits[-1]]
    return [records.where(c) for c in conditions]


def _log_halves(records: DataFrame) -> tuple[list[DataFrame], int]:
    """A change log in two deliveries, cut by its offsets as a log is; the first offset of the second one."""
    middle = records.agg(F.max("offset")).first()[0] // 2
    later = records.where(F.col("offset") > middle)
    return [records.where(F.col("offset") <= middle), later], later.agg(F.min("offset")).first()[0]


def _run(spark: SparkSession, job: DataStreamWriter) -> None:
    telemetry.start_job(job, spark, spark.sparkContext.defaultParallelism, snapshots=True).awaitTermination()


def _deliver(slices: list[DataFrame], folder: str, work: Callable[[], None], times: int = 1) -> None:
    """One slice after the other in folders below ``folder``, each as often as ``times`` says; the jobs catch up
    after each delivery. A slice that comes again brings the same bytes, so they are copied and not made again."""
    for i, part in enumerate(slices):
        write_records(part, f"{folder}/{i}-0")
        work()
        for again in range(1, times):
            copy_records(part.sparkSession, f"{folder}/{i}-0", f"{folder}/{i}-{again}")
            work()


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of all that :func:`_deliver` has put below ``folder``."""
    return file_records(spark, f"{folder}/*")


def _bronze_run(spark: SparkSession, slices: list[DataFrame], extra_runs: int = 0, times: int = 1) -> tuple[str, str]:
    """Deliver the slices to the telemetry job; the landing folder and the bronze folder."""
    root = shared_folder(spark, "telemetry")
    landing, bronze = f"{root}/landing", f"{root}/bronze"

    def work() -> None:
        _run(spark, telemetry.bronze_job(_landed(spark, landing), f"{root}/checkpoint", bronze, None))

    _deliver(slices, landing, work, times)
    for _ in range(extra_runs):
        work()
    return landing, bronze


def stream_bronze_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.event_records(spark, sf_dir)
    _, bronze = _bronze_run(spark, _slices(records, _EVENT_CUTS))
    return _zoneless(spark.read.parquet(bronze)).drop(*_ARRIVAL)


def stream_restart_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct ids per day after restarts on one checkpoint, the last one without data."""
    records = inputs.event_records(spark, sf_dir)
    _, bronze = _bronze_run(spark, _slices(records, _EVENT_CUTS[:1]), extra_runs=1)
    days = spark.read.parquet(bronze).groupBy("event_date")
    return days.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_events"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slice is delivered twice. Copies meet the state of their id, or the watermark."""
    records = inputs.event_records(spark, sf_dir)
    _, bronze = _bronze_run(spark, _slices(records, _EVENT_CUTS[:1]), times=2)
    return _zoneless(spark.read.parquet(bronze).select("event_id", "event_ts"))


def _ingest_run(spark: SparkSession, slices: list[DataFrame], purpose: str, times: int = 1) -> ingest.Outputs:
    """Deliver the slices to the job that splits each batch."""
    root = shared_folder(spark, purpose)
    outputs = ingest.Outputs(f"{root}/bronze", f"{root}/quarantine", f"{root}/late", f"{root}/state")

    def work() -> None:
        _run(spark, ingest.ingest_job(_landed(spark, f"{root}/landing"), f"{root}/checkpoint", outputs, None))

    _deliver(slices, f"{root}/landing", work, times)
    return outputs


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One kind of device delivers after all others: the rows that the job has put aside as too late."""
    records = inputs.event_records(spark, sf_dir)
    device = F.get_json_object(F.col("value").cast("string"), "$.device_type")
    late = F.coalesce(device == "mifi", F.lit(False))
    outputs = _ingest_run(spark, [*_slices(records.where(~late), _EVENT_CUTS[:1]), records.where(late)], "late")
    # Each copy is a row of its own there.
    return _zoneless(ingest.read_output(spark, outputs.late).select("event_id", "event_ts").distinct())


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of the one-pass job, every slice delivered twice: copies in a batch and across batches."""
    records = inputs.event_records(spark, sf_dir)
    outputs = _ingest_run(spark, _slices(records, _EVENT_CUTS[:1]), "ingest", times=2)
    return _zoneless(ingest.read_output(spark, outputs.bronze)).drop(*_ARRIVAL)


def stream_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected rows of the same job, whole."""
    outputs = _ingest_run(spark, _slices(inputs.event_records(spark, sf_dir), _EVENT_CUTS[:1]), "rejected")
    rejected = ingest.read_output(spark, outputs.quarantine)
    return _zoneless(rejected.select("reason", "event_id", F.col("kafka_timestamp")))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "quarantine")

    def work() -> None:
        records = _landed(spark, f"{root}/landing")
        _run(spark, telemetry.quarantine_job(records, f"{root}/checkpoint", f"{root}/rejected", None))

    _deliver(_slices(inputs.event_records(spark, sf_dir), _EVENT_CUTS[:1]), f"{root}/landing", work)
    rejected = spark.read.parquet(f"{root}/rejected")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def stream_network_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs of the windows that the watermark has closed."""
    root = shared_folder(spark, "kpis")
    cells = inputs.cells(spark, sf_dir)

    def work() -> None:
        events = accepted_events(telemetry.typed_events(_landed(spark, f"{root}/landing")))
        _run(spark, telemetry.kpi_job(telemetry.kpi_stream(events, cells), f"{root}/checkpoint", f"{root}/kpis", None))

    _deliver(_slices(inputs.event_records(spark, sf_dir), _EVENT_CUTS[:1]), f"{root}/landing", work)
    return _zoneless(spark.read.parquet(f"{root}/kpis"))


def stream_cdc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both change streams in one application; subscribers with the plan that they are on."""
    root = shared_folder(spark, "billing")
    plans = billing.plan_table(spark, f"{root}/plans")
    subscribers = billing.subscriber_table(spark, f"{root}/subscribers", parts=4)

    def work() -> None:
        queries = billing.start_billing(
            file_records(spark, f"{root}/plan_log"),
            _landed(spark, f"{root}/subscriber_log"),
            billing.append_sink(plans),
            billing.append_sink(subscribers),
            f"{root}/checkpoints",
            interval=None,
        )
        for query in queries:
            query.awaitTermination()

    write_records(inputs.plan_records(spark, sf_dir), f"{root}/plan_log")
    halves, _ = _log_halves(inputs.subscriber_records(spark, sf_dir))
    _deliver(halves, f"{root}/subscriber_log", work)
    offers = plans.read().select("plan_id", "plan_name", "monthly_fee")
    state = subscribers.read().select("subscriber_id", "full_name", "plan_id", "home_cell_id", "status", "updated_at")
    return _zoneless(state.join(offers, "plan_id", "left"))


def cdc_restarted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over a log that starts again at offset 0 half way, with deletes that bring no old row."""
    root = shared_folder(spark, "restarted")
    subscribers = billing.subscriber_table(spark, f"{root}/subscribers", parts=4)
    (before, after), first = _log_halves(inputs.subscriber_envelopes(spark, sf_dir))

    def work() -> None:
        records = _landed(spark, f"{root}/log")
        sink = billing.append_sink(subscribers)
        job = billing.change_job(records, SUBSCRIBER_PAYLOAD, sink, f"{root}/checkpoint", None, True, "subscriber_id")
        job.start().awaitTermination()

    _deliver([before, after.withColumn("offset", F.col("offset") - first)], f"{root}/log", work)
    columns = ("subscriber_id", "full_name", "plan_id", "home_cell_id", "status", "activated_at", "updated_at")
    return _zoneless(subscribers.read().select(*columns))


STREAM_QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        stream_bronze_telemetry,
        stream_restart_exactly_once,
        stream_dedup,
        stream_late_rows,
        stream_ingest,
        stream_ingest_quarantine,
        stream_quarantine,
        stream_network_kpis,
        stream_cdc_upsert,
        cdc_restarted_log,
    )
}
