"""The jobs for ``spark-submit``: two streams, the refresh run, and what goes with them.

    telemetry  --servers broker:9092 --topic events --bronze PATH --quarantine PATH --late PATH --checkpoints PATH
    billing    --servers broker:9092 --plan-topic plans --subscriber-topic subs --tables PATH --checkpoints PATH
    fold       --tables PATH
    refresh    --cells cells.csv --bronze PATH --tables PATH --lakehouse PATH [--full] [--select gold billing]
    freshness  --bronze PATH

With ``--files`` a topic is the name of a folder of JSON-lines records below that path. ``--once``
works off what is there and stops. ``fold`` merges what the billing job has appended. ``refresh`` ends with status 1 if a check blocked it,
``freshness`` if bronze is empty or its newest row too old; a warning is printed before that.
"""

from __future__ import annotations

import argparse
import sys
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import ERROR, PASS
from tidemark.plans.refresh import Lakehouse, RefreshOptions
from tidemark.plans.suites import freshness_report
from tidemark.session import prepare
from tidemark.sources.streams import file_records, kafka_records
from tidemark.sources.tables import load_seed
from tidemark.streaming import billing, ingest, telemetry


def _stream_options(command: argparse.ArgumentParser) -> None:
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="broker addresses")
    source.add_argument("--files", help="folder with one folder of records per topic")
    command.add_argument("--checkpoints", required=True)
    command.add_argument("--max-offsets", help="records per micro-batch")
    command.add_argument("--once", action="store_true")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidemark.jobs")
    commands = root.add_subparsers(dest="command", required=True)

    events = commands.add_parser("telemetry")
    _stream_options(events)
    events.add_argument("--topic", required=True)
    events.add_argument("--bronze", required=True)
    events.add_argument("--quarantine", required=True)
    events.add_argument("--late", help="events behind the watermark; a folder beside bronze by default")
    events.add_argument("--lateness-minutes", type=float, default=telemetry.ALLOWED_LATENESS.total_seconds() / 60)
    events.add_argument("--state-partitions", type=int, help="tasks that look for copies")

    changes = commands.add_parser("billing")
    _stream_options(changes)
    changes.add_argument("--plan-topic", required=True)
    changes.add_argument("--subscriber-topic", required=True)
    changes.add_argument("--tables", required=True)
    changes.add_argument("--subscriber-parts", type=int, default=64)
    changes.add_argument("--enveloped", action="store_true", help="records are before/after envelopes")

    fold = commands.add_parser("fold")
    fold.add_argument("--tables", required=True)
    fold.add_argument("--subscriber-parts", type=int, default=64, help="files of the folded subscribers")

    refresh = commands.add_parser("refresh")
    refresh.add_argument("--cells", required=True, help="CSV file of the cell reference")
    refresh.add_argument("--bronze", required=True)
    refresh.add_argument("--tables", required=True)
    refresh.add_argument("--lakehouse", required=True)
    refresh.add_argument("--full", action="store_true")
    refresh.add_argument("--as-of", type=datetime.fromisoformat)
    refresh.add_argument("--select", nargs="*", default=())
    refresh.add_argument("--subscriber-parts", type=int, default=64)

    fresh = commands.add_parser("freshness")
    fresh.add_argument("--bronze", required=True)
    fresh.add_argument("--as-of", type=datetime.fromisoformat)
    return root


def _records(spark: SparkSession, args: argparse.Namespace, topic: str) -> DataFrame:
    if args.files:
        return file_records(spark, f"{args.files.rstrip('/')}/{topic}")
    options = {"maxOffsetsPerTrigger": args.max_offsets} if args.max_offsets else {}
    return kafka_records(spark, args.servers, topic, options)


def run_telemetry(spark: SparkSession, args: argparse.Namespace) -> int:
    interval = None if args.once else telemetry.TELEMETRY_TRIGGER
    base = args.checkpoints.rstrip("/")
    late = args.late or f"{args.bronze.rstrip('/')}-late"
    outputs = ingest.Outputs(args.bronze, args.quarantine, late, f"{base}/bronze-state")
    lateness = timedelta(minutes=args.lateness_minutes)
    job = ingest.ingest_job(_records(spark, args, args.topic), f"{base}/bronze", outputs, interval, lateness)
    return _wait(spark, [telemetry.start_job(job, spark, args.state_partitions)], args.once)


def run_billing(spark: SparkSession, args: argparse.Namespace) -> int:
    plans, subscribers = _billing_tables(spark, args)
    queries = billing.start_billing(
        _records(spark, args, args.plan_topic),
        _records(spark, args, args.subscriber_topic),
        billing.append_sink(plans),
        billing.append_sink(subscribers),
        args.checkpoints,
        None if args.once else billing.CHANGE_TRIGGER,
        args.enveloped,
    )
    return _wait(spark, queries, args.once)


def run_fold(spark: SparkSession, args: argparse.Namespace) -> int:
    for table in _billing_tables(spark, args):
        if table.version() is not None:
            table.fold()
    return 0


def run_refresh(spark: SparkSession, args: argparse.Namespace) -> int:
    house = Lakehouse(spark, args.lakehouse)
    # Staged per run: a seed that the checks refuse never replaces the one in use.
    seed = f"{args.lakehouse.rstrip('/')}/seeds/{uuid.uuid4().hex}"
    load_seed(spark, args.cells, seed)
    plans, subscribers = _billing_tables(spark, args)
    sources = {
        "bts_metadata": spark.read.parquet(seed),
        "bronze_telecom_events": ingest.read_output(spark, args.bronze),
        "bronze_billing_plans": plans.read(include_deleted=True),
        "bronze_subscribers": subscribers.read(include_deleted=True),
    }
    options = RefreshOptions(as_of=args.as_of, full=args.full)
    result = house.refresh(sources, options, args.select)
    if result.published:
        load_seed(spark, args.cells, f"{args.lakehouse.rstrip('/')}/bts_metadata")
    for name in result.failed:
        print(f"blocked by {name}", file=sys.stderr)
    return 0 if result.published else 1


def run_freshness(spark: SparkSession, args: argparse.Namespace) -> int:
    found = freshness_report({"bronze_telecom_events": ingest.read_output(spark, args.bronze)}, args.as_of).where(F.col("status") != PASS).collect()
    for row in found:
        print(f"{row['status']}: {row['table_name']} was last loaded at {row['max_loaded_at']}", file=sys.stderr)
    return int(any(row["status"] == ERROR for row in found))


def _billing_tables(spark: SparkSession, args: argparse.Namespace):
    base = args.tables.rstrip("/")
    return (
        billing.plan_table(spark, f"{base}/billing_plans"),
        billing.subscriber_table(spark, f"{base}/subscribers", args.subscriber_parts),
    )


def _wait(spark: SparkSession, queries: list, once: bool) -> int:
    """Wait for all queries of a one-off run; otherwise end with the first that stops."""
    if once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return 0


_RUNNERS = {"telemetry": run_telemetry, "billing": run_billing, "fold": run_fold, "refresh": run_refresh, "freshness": run_freshness}


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(arguments)
    session = spark or SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
    return _RUNNERS[args.command](prepare(session), args)


if __name__ == "__main__":
    sys.exit(main())
