"""A refresh run: build the models in order, check what was built, then publish all of it at once.

Tables are written to the folder of the run and read back, which also cuts the lineage between
layers: the loss of an executor never recomputes more than one layer. Nothing is visible to
readers until the checks have passed and one small publication file is in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.digests import day_filters, days_that_may_hold, differing, file_digests, row_digests
from tidemark.operators.lookup import DEFAULT_POLICY, LookupPolicy
from tidemark.operators.quality import blocking, empty_report, quality_report
from tidemark.plans import gold, silver, staging
from tidemark.plans.suites import SUITES
from tidemark.sources.days import day_of, read_days, write_days
from tidemark.sources.files import MetadataFolder

VIEW, TABLE, INCREMENTAL = "view", "table", "incremental"
_DAY = timedelta(days=1)
SILVER_TABLE = "silver_cell_events"
KPI_TABLE = "gold_network_kpis"
HEATMAP_TABLE = "gold_cell_heatmap"
# The ids of the silver events before they meet their cells, with what decides between copies, and
# the Bloom filter of each day's ids.
IDS_TABLE = "event_ids"
FILTER_TABLE = "event_id_filters"
_TIME = {SILVER_TABLE: "event_ts", KPI_TABLE: "window_start"}
# Not part of a row's content: the record as it came, which the columns were read from.
_RAW_COLUMNS = ("raw_payload", "kafka_key")


@dataclass(frozen=True)
class RefreshOptions:
    """``as_of`` stands for now; ``gate_layers`` are the layers whose failed checks block.

    An incremental run compares digests of the days of bronze with those of the published run and rebuilds the
    days of silver and the KPI windows where they differ, whenever and in whatever order events came.
    """

    as_of: datetime | None = None
    full: bool = False
    width: timedelta = gold.KPI_WINDOW
    gate_layers: tuple[str, ...] = ("gold",)
    plan_order: tuple[str, ...] = ("updated_at", "ingested_at")
    subscriber_order: tuple[str, ...] = ("updated_at", "ingested_at")
    policy: LookupPolicy = DEFAULT_POLICY


@dataclass
class Run:
    """What a model builder can see: the tables built so far, and what an incremental run keeps.

    ``days`` are the days to rebuild from their events, None for all, and ``trimmed`` those that lose rows. ``beaten`` holds the ids among these of
    which another day has a newer copy; ``lost`` the days and ids of other days of which these have one. ``published`` has the published silver of the trimmed days, and
    under ``changed`` the rows of the last table written by day, of the changed days, and the published heatmap.
    """

    tables: dict[str, DataFrame]
    options: RefreshOptions
    days: list[str] | None = None
    beaten: DataFrame | None = None
    lost: DataFrame | None = None
    published: dict[str, DataFrame] = field(default_factory=dict)
    trimmed: list[str] = field(default_factory=list)

    def of_days(self, events: DataFrame, days: list[str] | None) -> DataFrame:
        if days is None:
            return events
        dates = [date.fromisoformat(d) for d in days]
        since = F.to_date("event_ts").isin(dates)
        return events.where(since & F.col("event_date").isin(dates) if "event_date" in events.columns else since)

    def staging_events(self) -> DataFrame:
        return staging.stage_events(self.tables["bronze_telecom_events"])

    def staged_events(self) -> DataFrame:
        """All events, or those of the days to rebuild that are not older copies of events of other days."""
        events = self.of_days(self.tables["stg_telecom_events"], self.days)
        return events if self.beaten is None else events.join(self.beaten, "event_id", "left_anti")

    def silver(self) -> DataFrame:
        rebuilt = silver.silver_events(
            self.staged_events(), self.tables["bts_metadata"], self.options.as_of, self.options.policy
        )
        if not self.trimmed:
            return rebuilt
        # Days that only lost an event to a newer copy elsewhere keep their rows but for these.
        kept = self.published[SILVER_TABLE].join(self.lost.select("event_id"), "event_id", "left_anti")
        return rebuilt.unionByName(kept)

    def heatmap(self) -> DataFrame:
        """The latest KPI row of each cell. Where only some days changed, it is the published one or lies on these days;
        all days are looked at only for cells that have lost the row that was their latest."""
        kpis, before = self.tables[KPI_TABLE], self.published.get(HEATMAP_TABLE)
        if self.days is None or before is None:
            return gold.cell_heatmap(kpis)
        changed = self.published["changed"]
        gone = F.col("day").isin(self.changed)
        known = before.drop("severity").withColumn("day", day_of("window_start"))
        newest = changed.groupBy("cell_id").agg(F.max("window_start").alias("newest"))
        replaced = known.where(gone).join(newest, "cell_id", "left")
        lost = replaced.where(F.col("newest").isNull() | (F.col("newest") < F.col("window_start"))).select("cell_id")
        candidates = known.where(~gone).drop("day").unionByName(changed)
        if not lost.isEmpty():
            candidates = candidates.unionByName(kpis.join(lost, "cell_id", "left_semi"))
        return gold.cell_heatmap(candidates)

    @property
    def changed(self) -> list[str] | None:
        """The days whose tables are written anew, None for all."""
        return None if self.days is None else sorted({*self.days, *self.trimmed})


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    kind: str
    build: Callable[[Run], DataFrame]
    tags: frozenset[str] = frozenset()

    def selected(self, selectors: frozenset[str]) -> bool:
        return not selectors or bool(selectors & ({self.name, self.layer} | self.tags))


_DASHBOARD = frozenset({"gold", "dashboard"})
_BILLING = _DASHBOARD | {"billing"}

# In order of dependency; sources come first under the names used in SUITES.
MODELS: tuple[Model, ...] = (
    Model(
        "stg_telecom_events", "staging", VIEW, lambda run: run.staging_events()
    ),
    Model(
        "stg_billing_plans",
        "staging",
        VIEW,
        lambda run: staging.stage_plans(run.tables["bronze_billing_plans"], run.options.plan_order),
    ),
    Model(
        "stg_subscribers",
        "staging",
        VIEW,
        lambda run: staging.stage_subscribers(run.tables["bronze_subscribers"], run.options.subscriber_order),
    ),
    Model(
        SILVER_TABLE,
        "silver",
        INCREMENTAL,
        lambda run: run.silver(),
    ),
    Model(
        KPI_TABLE,
        "gold",
        INCREMENTAL,
        lambda run: gold.windowed_kpis(run.published["changed"], run.options.width, run.options.as_of),
        frozenset({"gold"}),
    ),
    # A table, as its readers would each rank the whole KPI history.
    Model(HEATMAP_TABLE, "gold", TABLE, lambda run: run.heatmap(), _DASHBOARD),
    Model(
        "gold_customer_360",
        "gold",
        TABLE,
        lambda run: gold.customer_360(
            run.tables["stg_subscribers"],
            run.tables["stg_billing_plans"],
            run.tables["gold_cell_heatmap"],
            run.options.as_of,
            policy=run.options.policy,
        ),
        _BILLING,
    ),
    Model(
        "gold_plan_revenue_impact",
        "gold",
        TABLE,
        lambda run: gold.plan_revenue_impact(run.tables["gold_customer_360"], run.options.as_of),
        _BILLING,
    ),
)


@dataclass(frozen=True)
class RefreshResult:
    run: int
    published: bool
    failed: list[str] = field(default_factory=list)
    report: DataFrame | None = None


class Lakehouse:
    """The published tables below one folder, and the runs that renew them.

    ``sources`` holds ``bts_metadata``, ``bronze_telecom_events``, ``bronze_billing_plans`` and
    ``bronze_subscribers``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = path.rstrip("/")
        self._publications = MetadataFolder(spark, f"{self._path}/publications")

    def tables(
        self, sources: dict[str, DataFrame], options: RefreshOptions = RefreshOptions()
    ) -> dict[str, DataFrame]:
        """Everything that was last published, with the views over it."""
        current = self._publications.latest()
        if current is None:
            raise FileNotFoundError(f"nothing was published in {self._path}")
        run = Run(dict(sources), options)
        for model in MODELS:
            run.tables[model.name] = self._published(model, current) if model.kind != VIEW else model.build(run)
        return run.tables

    def _published(self, model: Model, publication: dict) -> DataFrame:
        if model.kind == INCREMENTAL:
            return self._days(publication, model.name)
        return self._spark.read.parquet(f"{self._path}/{publication['tables'][model.name]}")

    def _days(self, publication: dict, name: str, only: Iterable[str] | None = None, but: Iterable[str] = ()) -> DataFrame:
        table = publication["days"][name]
        return read_days(self._spark, self._path, table["folders"], T.StructType.fromJson(table["schema"]), only, but)

    def refresh(
        self,
        sources: dict[str, DataFrame],
        options: RefreshOptions = RefreshOptions(),
        select: Iterable[str] = (),
    ) -> RefreshResult:
        """Build the selected models (by name, layer or tag; all by default), check, publish.

        Models that are not selected keep their published content. A failed check of a gated
        layer leaves the publication as it was.
        """
        current = self._publications.latest()
        number = 0 if current is None else current["run"] + 1
        selectors = frozenset(select)
        # One clock for the whole run.
        options = replace(options, as_of=options.as_of or datetime.now(timezone.utc).replace(tzinfo=None))
        # A full run starts the incremental tables again; otherwise the published days are the base.
        incremental = [m for m in MODELS if m.kind == INCREMENTAL]
        fresh = options.full or current is None or "days" not in current or options.width > _DAY
        run = Run(dict(sources), options)
        published = {
            "run": number,
            "tables": dict(current["tables"]) if current else {},
            "days": dict(current.get("days", {})) if current else {},
            "seen": current.get("seen") if current else None,
        }
        if all(m.selected(selectors) for m in incremental):
            # Read before the build: what arrives meanwhile is left to the next run.
            published["seen"] = self._look(sources["bronze_telecom_events"], None if fresh else current["seen"], options)
            self._place_ids(run, number, published, None if fresh else current)
            if not fresh:
                run.published[HEATMAP_TABLE] = self._spark.read.parquet(f"{self._path}/{current['tables'][HEATMAP_TABLE]}")
        elif any(m.selected(selectors) for m in incremental):
            raise ValueError("silver and KPIs are rebuilt together, since they share the days to rebuild")
        built = []
        for model in MODELS:
            chosen = model.selected(selectors)
            if chosen or model.kind == VIEW:
                run.tables[model.name] = self._build(model, run, number, published)
            elif current is None:
                raise ValueError(f"{model.name} was never published, so it must be selected")
            else:
                run.tables[model.name] = self._published(model, current)
            if chosen:
                built.append(model)
        report = self._audit(run, built, number)
        gated = [m.name for m in built if m.layer in options.gate_layers]
        failures = blocking(report.where(report.table_name.isin(gated))).collect() if gated else []
        if failures:
            names = [f"{row['table_name']}.{row['check_name']}" for row in failures]
            return RefreshResult(number, False, names, report)
        self._publications.write(number, published)
        return RefreshResult(number, True, [], report)

    def _build(self, model: Model, run: Run, number: int, published: dict) -> DataFrame:
        rows = model.build(run)
        if model.kind == VIEW:
            return rows
        if model.kind == INCREMENTAL:
            return self._replace_days(model.name, rows, day_of(_TIME[model.name]), run, number, published)
        folder = f"{model.name}/run-{number:012d}-{uuid.uuid4().hex[:12]}"
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self._path}/{folder}")
        published["tables"][model.name] = folder
        return self._spark.read.schema(rows.schema).parquet(f"{self._path}/{folder}")

    def _replace_days(self, name: str, rows: DataFrame, day: Column, run: Run, number: int, published: dict) -> DataFrame:
        """Write the changed days of a table and publish them beside the folders of the others."""
        folder = f"{name}/run-{number:012d}-{uuid.uuid4().hex[:12]}"
        written = write_days(rows, self._path, folder, day)
        kept = {}
        if run.changed is not None:
            changed = set(run.changed)
            kept = {d: f for d, f in published["days"][name]["folders"].items() if d not in changed}
            if written.keys() - changed:
                raise ValueError(f"{name} reaches into days that did not change: {sorted(written.keys() - changed)}")
        published["days"][name] = {"folders": kept | written, "schema": rows.schema.jsonValue()}
        run.published["changed"] = self._days(published, name, run.changed)
        return self._days(published, name)

    def _look(self, events: DataFrame, before: dict | None, options: RefreshOptions) -> dict:
        """The digests of the days of bronze. Rows are read of days only whose files are not those of the last run."""
        day = day_of("event_ts")
        files = file_digests(events, day_of("event_date")) if "event_date" in events.columns else None
        told = files is not None and before is not None and before["files"] is not None
        if not told:
            return {"as_of": options.as_of.isoformat(), "files": files, "rows": row_digests(events, day, _RAW_COLUMNS)}
        suspects = differing(before["files"], files)
        rows = {d: x for d, x in before["rows"].items() if d not in suspects}
        if suspects:
            rows |= row_digests(Run({}, options).of_days(events, suspects), day, _RAW_COLUMNS)
        return {"as_of": options.as_of.isoformat(), "files": files, "rows": rows}

    def _changed_days(self, before: dict, seen: dict) -> list[str]:
        """Days with other rows than the published run saw, and those of events that lay in the future then, or do now."""
        clocks = sorted(datetime.fromisoformat(x["as_of"]) + silver.FUTURE_SKEW for x in (before, seen))
        ripe = [] if clocks[0] == clocks[1] else [d for d in seen["rows"] if clocks[0].date().isoformat() <= d <= clocks[1].date().isoformat()]
        return sorted({*differing(before["rows"], seen["rows"]), *ripe})

    def _place_ids(self, run: Run, number: int, published: dict, current: dict | None) -> None:
        """Find the days to rebuild, and on which day the winning copy of each of their events lies.

        Only the ids of these days are read, the filters of all days, and the ids of days that their filter does
        not rule out for an id that is new on its day.
        """
        if current is not None:
            run.days = self._changed_days(current["seen"], published["seen"])
        staged = run.of_days(run.staging_events(), run.days)
        valid = silver.valid_events(staged, run.options.as_of)
        order = silver.tie_break(valid)
        ids = silver.unique_events(valid.select("event_id", *order)).withColumn("day", day_of("event_ts"))
        if current is not None:
            own = self._days(current, IDS_TABLE, run.days)
            ids = self._scratch(ids, "ids", number)
            fresh = ids.join(own.select("event_id"), "event_id", "left_anti")
            days = days_that_may_hold(fresh, self._days(current, FILTER_TABLE, but=run.days))
            if days:
                rank = F.struct(*order)
                other = self._days(current, IDS_TABLE, days).select("event_id", "day", rank.alias("theirs"))
                met = fresh.select("event_id", rank.alias("ours")).join(other, "event_id")
                met = self._scratch(met.select("event_id", "day", (F.col("theirs") >= F.col("ours")).alias("beaten")), "copies", number)
                run.beaten, run.lost = met.where("beaten").select("event_id"), met.where("not beaten").select("day", "event_id")
                run.trimmed = sorted(r["day"] for r in run.lost.select("day").distinct().collect())
                ids = ids.join(run.beaten, "event_id", "left_anti")
                if run.trimmed:
                    kept = self._days(current, IDS_TABLE, run.trimmed).join(run.lost.select("event_id"), "event_id", "left_anti")
                    ids = ids.unionByName(kept)
                    run.published[SILVER_TABLE] = self._days(current, SILVER_TABLE, run.trimmed)
        self._replace_days(IDS_TABLE, ids, F.col("day"), run, number, published)
        self._replace_days(FILTER_TABLE, day_filters(run.published["changed"]), F.col("day"), run, number, published)

    def _scratch(self, rows: DataFrame, name: str, number: int) -> DataFrame:
        """Written, so that it is computed once and survives lost executors."""
        path = f"{self._path}/scratch/{name}-{number:012d}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(path)
        return self._spark.read.schema(rows.schema).parquet(path)

    def _audit(self, run: Run, built: list[Model], number: int) -> DataFrame:
        """Report of the sources and the built models; written, so that it can be read for free."""
        names = [*[n for n in run.tables if n not in {m.name for m in MODELS}], *[m.name for m in built]]
        suites = [(n, run.tables[n], SUITES[n](run.tables)) for n in names if n in SUITES]
        report = quality_report(suites) if suites else empty_report(self._spark)
        path = f"{self._path}/quality/run-{number:012d}"
        report.coalesce(1).write.mode("overwrite").parquet(path)
        return self._spark.read.schema(report.schema).parquet(path)
