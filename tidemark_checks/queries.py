"""Batch queries: each takes the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as dq
from tidemark.operators.changes import LOG_ORDER, flatten_envelopes, parse_changes, parse_envelopes, snapshot_with_changes
from tidemark.operators.lookup import LookupPolicy, lookup_join
from tidemark.operators.upsert import latest_changes, live_rows, upsert
from tidemark.plans import bronze, gold, serving, silver, staging
from tidemark.plans.refresh import Lakehouse, RefreshOptions
from tidemark.schemas import CELL_REFERENCE, SUBSCRIBER_PAYLOAD
from tidemark.session import shared_folder
from tidemark.sources.changelog import ChangeTable
from tidemark.sources.tables import append_partitioned, load_seed
from tidemark_checks import inputs
from tidemark_checks.inputs import AS_OF, FIRST_CUT

Query = Callable[[SparkSession, str], DataFrame]

DAY = timedelta(days=1)
_CHANGE_ORDER = ("updated_at", "chg_offset")
# Changes apply in the order of the log, whatever their times say.
_LOG_ORDER = ("chg_offset",)


def _zoneless(df: DataFrame) -> DataFrame:
    """Times as the given tables have them: without a zone."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# --- models -----------------------------------------------------------------------------------


def stg_telecom_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_events(inputs.events(spark, sf_dir))


def dedup_latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.unique_events(silver.valid_events(stg_telecom_events(spark, sf_dir), AS_OF))


def silver_cell_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_events(stg_telecom_events(spark, sf_dir), inputs.cells(spark, sf_dir), AS_OF)


def network_kpis_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.windowed_kpis(silver_cell_events(spark, sf_dir), as_of=AS_OF)


def network_kpis_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.windowed_kpis(silver_cell_events(spark, sf_dir), DAY, AS_OF)


def cell_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.cell_heatmap(network_kpis_15m(spark, sf_dir))


def cell_heatmap_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.cell_heatmap(network_kpis_1d(spark, sf_dir))


def stg_billing_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_plans(inputs.plans(spark, sf_dir), _CHANGE_ORDER)


def stg_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_subscribers(inputs.subscribers(spark, sf_dir), _CHANGE_ORDER)


def _subscriber_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current subscribers as the change stream would leave them."""
    return latest_changes(inputs.subscribers(spark, sf_dir), ["subscriber_id"], _LOG_ORDER)


def _customers(spark: SparkSession, sf_dir: str, heatmap: DataFrame) -> DataFrame:
    return gold.customer_360(
        staging.stage_subscribers(_subscriber_state(spark, sf_dir), _CHANGE_ORDER),
        stg_billing_plans(spark, sf_dir),
        heatmap,
        AS_OF,
        policy=None,
    )


def customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir, cell_heatmap(spark, sf_dir))


def customer_360_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir, cell_heatmap_1d(spark, sf_dir))


def plan_revenue_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.plan_revenue_impact(customer_360(spark, sf_dir), AS_OF)


def plan_revenue_impact_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.plan_revenue_impact(customer_360_1d(spark, sf_dir), AS_OF)


def lookup_large_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer, under a policy that forbids the broadcast."""
    orders = inputs.given_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = inputs.given_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return lookup_join(orders, customers, "o_custkey", "inner", LookupPolicy(broadcast_rows=0))


# --- ingestion and change capture ---------------------------------------------------------------


def parse_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.event_records(spark, sf_dir)
    typed = bronze.type_events(bronze.decode_events(records), F.col("kafka_timestamp"))
    return _zoneless(bronze.identified_events(typed)).drop("raw_payload")


def quarantine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.event_records(spark, sf_dir)
    typed = bronze.type_events(bronze.decode_events(records), F.col("kafka_timestamp"))
    rejected = bronze.quarantined_events(typed)
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def _parsed_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_changes(inputs.subscriber_records(spark, sf_dir), SUBSCRIBER_PAYLOAD, F.col("kafka_timestamp"))


def cdc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(_parsed_subscribers(spark, sf_dir)).drop("kafka_timestamp", "ingested_at")


def cdc_flatten_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_envelopes(inputs.subscriber_envelopes(spark, sf_dir), SUBSCRIBER_PAYLOAD, "subscriber_id")
    return _zoneless(parse_changes(flat, SUBSCRIBER_PAYLOAD)).drop("kafka_timestamp", "ingested_at")


def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subscriber_state(spark, sf_dir)


def cdc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping change sets in an order that is not the order of the changes."""
    changes = inputs.subscribers(spark, sf_dir)
    status = F.col("status")
    first = upsert(changes.where(F.lit(False)), changes.where(status == "suspended"), ["subscriber_id"], _LOG_ORDER)
    second = upsert(first, changes.where(status != "suspended"), ["subscriber_id"], _LOG_ORDER)
    replayed = upsert(second, changes.where(status == "terminated"), ["subscriber_id"], _LOG_ORDER)
    return live_rows(replayed)


def cdc_upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by append and fold, newest changes first, with a batch that is delivered twice."""
    changes = inputs.subscribers(spark, sf_dir)
    folder, status = shared_folder(spark, "subscribers"), F.col("status")
    table = ChangeTable(spark, folder, ["subscriber_id"], _LOG_ORDER, "is_deleted", parts=4)
    table.append(changes.where(status == "suspended"), 0)
    table.fold()
    table.append(changes.where(status == "terminated"), 1)
    table.append(changes.where(status == "terminated"), 1)
    table.fold()
    table.append(changes.where(~status.isin("suspended", "terminated")), 2)
    return table.read()


def cdc_snapshot_plus_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the initial copy, orders as the changes after it."""
    changes = inputs.subscribers(spark, sf_dir).withColumnRenamed("chg_offset", "change_seq")
    customers = inputs.given_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("subscriber_id"),
        F.col("c_name").alias("full_name"),
        F.lit("P0").alias("plan_id"),
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("home_cell_id"),
        F.lit("active").alias("status"),
        *[F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias(c) for c in ("activated_at", "updated_at")],
        F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("ingested_at"),
    )
    both = snapshot_with_changes(customers, changes)
    return live_rows(latest_changes(both, ["subscriber_id"], ("change_seq",)))


def cdc_recreated_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers that were deleted and came back: the log decides, not the times of the rows."""
    parsed = parse_envelopes(inputs.subscriber_envelopes(spark, sf_dir), SUBSCRIBER_PAYLOAD, "subscriber_id")
    changes = _stored(parsed, "changes")  # read twice
    state = live_rows(latest_changes(changes, ["subscriber_id"], LOG_ORDER))
    deleted = changes.where("is_deleted").select("subscriber_id")
    return _zoneless(state.join(deleted, "subscriber_id", "left_semi")).drop("kafka_timestamp", "ingested_at")


# --- tables -------------------------------------------------------------------------------------


def seed_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "seed")
    inputs.cells(spark, sf_dir).write.option("header", True).csv(f"{folder}/csv")
    load_seed(spark, f"{folder}/csv", f"{folder}/table")
    return spark.read.schema(CELL_REFERENCE).parquet(f"{folder}/table")


def bronze_partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written in folders by day and network type, and read back whole."""
    folder = shared_folder(spark, "bronze")
    rows = inputs.events(spark, sf_dir)
    append_partitioned(rows, folder)
    return spark.read.parquet(folder).select(*rows.columns)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kpi_incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First everything up to a cut, then only the windows since; equal to one full build."""
    staged, cells = stg_telecom_events(spark, sf_dir), inputs.cells(spark, sf_dir)
    first = silver.silver_events(staged, cells, FIRST_CUT)
    table = _stored(gold.windowed_kpis(first, as_of=AS_OF), "kpis")
    bound = gold.aligned_lower_bound(AS_OF, lookback=AS_OF - FIRST_CUT)
    recent = silver.silver_events(gold.events_since(staged, bound), cells, AS_OF)
    return upsert(table, gold.windowed_kpis(recent, as_of=AS_OF), gold.KPI_KEYS)


def kpi_late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default options; the events of one kind of device are handed over after the first run, with the stamps
    that they always had."""
    late = F.coalesce(F.col("device_type") == "mifi", F.lit(False))
    house, sources, bronze = _landed(spark, sf_dir, inputs.events(spark, sf_dir).where(~late))
    house.refresh(sources, RefreshOptions(as_of=AS_OF, **_ORDER))
    append_partitioned(inputs.events(spark, sf_dir).where(late), bronze)
    second = {**sources, "bronze_telecom_events": spark.read.parquet(bronze)}
    house.refresh(second, RefreshOptions(as_of=AS_OF, **_ORDER))
    return house.tables(second)["gold_network_kpis"].drop("updated_at")


def kpi_moved_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of events come on other days, first as the newer copy, then as the older one."""
    events = inputs.events(spark, sf_dir)
    house, sources, bronze = _landed(spark, sf_dir, events)
    for hour, days, seconds in ((None, 0, 0), (9, 3, 3667), (10, -2, -3667)):
        if hour is not None:
            moved = {"event_ts": F.col("event_ts") + timedelta(days=days), "event_date": F.date_add("event_date", days)}
            moved["ingested_at"] = F.col("ingested_at") + timedelta(seconds=seconds)
            append_partitioned(events.where(F.hour("event_ts") == hour).withColumns(moved), bronze)
        now = {**sources, "bronze_telecom_events": spark.read.parquet(bronze)}
        house.refresh(now, RefreshOptions(as_of=AS_OF, **_ORDER))
    return house.tables(now)["gold_network_kpis"].drop("updated_at")


def upsert_schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch brings a new column and no longer has another."""
    kpis = network_kpis_1d(spark, sf_dir)
    columns = [*gold.KPI_KEYS, "total_events", "dropped_calls"]
    table = _stored(kpis.select(*columns), "sync")
    recent = kpis.where(F.col("window_start") >= F.lit(FIRST_CUT.isoformat(" ")).cast("timestamp_ntz"))
    return upsert(table, recent.select(*columns[:-1], "qoe_issue_events"), gold.KPI_KEYS)


def _lakehouse(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, dict[str, DataFrame]]:
    """A lakehouse and its stored source tables."""
    return _landed(spark, sf_dir, inputs.events(spark, sf_dir))[:2]


def _landed(spark: SparkSession, sf_dir: str, events: DataFrame) -> tuple[Lakehouse, dict[str, DataFrame], str]:
    """The same with only these events so far, and the folder to which more can be appended."""
    root = shared_folder(spark, "lakehouse")
    append_partitioned(events, f"{root}/bronze_telecom_events")
    others = {
        "bts_metadata": inputs.cells(spark, sf_dir),
        "bronze_billing_plans": inputs.plans(spark, sf_dir),
        "bronze_subscribers": _subscriber_state(spark, sf_dir),
    }
    for name, frame in others.items():
        frame.write.parquet(f"{root}/{name}")
    names = [*others, "bronze_telecom_events"]
    sources = {name: spark.read.parquet(f"{root}/{name}") for name in names}
    return Lakehouse(spark, f"{root}/published"), sources, f"{root}/bronze_telecom_events"


_ORDER = {"plan_order": _CHANGE_ORDER, "subscriber_order": _CHANGE_ORDER}


def publish_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run, then an incremental one, and what is published at the end."""
    house, sources = _lakehouse(spark, sf_dir)
    house.refresh(sources, RefreshOptions(as_of=FIRST_CUT, full=True, **_ORDER))
    house.refresh(sources, RefreshOptions(as_of=AS_OF, **_ORDER))
    return house.tables(sources)["gold_plan_revenue_impact"].drop("updated_at")


# --- quality ------------------------------------------------------------------------------------


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.NotNull("event_ts").violations(inputs.events(spark, sf_dir)).select("event_id", "cell_id", "ingested_at")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.Unique("event_id").violations(inputs.events(spark, sf_dir))


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = dq.AcceptedValues("network_type", silver.NETWORK_TYPES)
    return check.violations(stg_telecom_events(spark, sf_dir)).select("event_id", "network_type", "ingested_at")


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = dq.References("cell_id", inputs.cells(spark, sf_dir), "cell_id")
    return check.violations(stg_telecom_events(spark, sf_dir)).select("event_id", "cell_id", "ingested_at")


def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = dq.AcceptedRange("monthly_fee", 0.0, 500_000.0)
    return check.violations(inputs.plans(spark, sf_dir)).select("plan_id", "monthly_fee")


def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables: the silver events, and the events of cells that are not known to exist."""
    staged = stg_telecom_events(spark, sf_dir)
    unknown = staged.where(F.col("network_type") == "2G")
    tables = {"stg_telecom_events": staged, "unknown_network": unknown}
    results = [dq.NotEmpty().violations(df).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return results[0].unionByName(results[1])


def dq_coordinate_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box around the northern cells, so the southern ones violate it."""
    check = dq.CoordinateBox(south=12.0, east=107.0)
    return check.violations(silver_cell_events(spark, sf_dir)).select("event_id", "cell_id", "latitude", "longitude")


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.Freshness().status(inputs.events(spark, sf_dir), AS_OF)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a full run: all suites over the sources and the tables that were built."""
    house, sources = _lakehouse(spark, sf_dir)
    return house.refresh(sources, RefreshOptions(as_of=AS_OF, full=True, **_ORDER)).report


# --- serving ------------------------------------------------------------------------------------


def serve_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = customer_360(spark, sf_dir)
    return serving.table_counts(
        {
            "bronze_telecom_events": inputs.events(spark, sf_dir),
            "bronze_subscribers": _subscriber_state(spark, sf_dir),
            "gold_customer_360": customers,
            "gold_plan_revenue_impact": gold.plan_revenue_impact(customers, AS_OF),
        }
    )


def serve_heatmap_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.heatmap_points(cell_heatmap_1d(spark, sf_dir))


def serve_drop_rate_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.drop_rate_trend(network_kpis_15m(spark, sf_dir))


def serve_churn_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.churn_breakdown(customer_360_1d(spark, sf_dir))


def serve_revenue_by_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.revenue_by_plan(plan_revenue_impact(spark, sf_dir))


def serve_fee_vs_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.fee_vs_quality(customer_360_1d(spark, sf_dir))


def serve_revenue_at_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.revenue_at_risk(plan_revenue_impact_1d(spark, sf_dir))


def serve_top_loaded_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_loaded_cells(cell_heatmap_1d(spark, sf_dir))


def serve_high_risk_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.high_risk_customers(customer_360_1d(spark, sf_dir))


def serve_top_risk_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_risk_customers(customer_360_1d(spark, sf_dir))


def serve_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_events(inputs.events(spark, sf_dir))


def serve_plan_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.plan_list(inputs.plans(spark, sf_dir))


BATCH_QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        stg_telecom_events, dedup_latest_event, silver_cell_events, network_kpis_15m, network_kpis_1d,
        cell_heatmap, cell_heatmap_1d, stg_billing_plans, stg_subscribers, customer_360, customer_360_1d,
        plan_revenue_impact, plan_revenue_impact_1d, parse_json_events, quarantine_events, cdc_parse,
        cdc_flatten_envelope, cdc_latest_state, cdc_upsert, cdc_upsert_stored, cdc_snapshot_plus_changes,
        cdc_recreated_key, lookup_large_reference, kpi_late_arrivals, kpi_moved_copies,
        seed_reference, bronze_partitioned_write, kpi_incremental_upsert, upsert_schema_sync, publish_audited,
        dq_not_null, dq_unique, dq_accepted_values, dq_relationships, dq_accepted_range, dq_not_empty,
        dq_coordinate_box, dq_freshness, dq_report, serve_table_counts, serve_heatmap_points,
        serve_drop_rate_trend, serve_churn_breakdown, serve_revenue_by_plan, serve_fee_vs_quality,
        serve_revenue_at_risk, serve_top_loaded_cells, serve_high_risk_customers, serve_top_risk_customers,
        serve_latest_events, serve_plan_list,
    )
}
