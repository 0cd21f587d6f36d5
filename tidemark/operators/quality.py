"""Data-quality checks. Each check gives the violating rows; a report counts them per check.

Row checks of one table share a single scan in the report: they are conditions, counted side by
side in one map-side combined aggregate. Only uniqueness and reference checks need their own pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators.lookup import DEFAULT_POLICY, LookupPolicy, lookup_join

ERROR = "error"
WARN = "warn"
PASS = "pass"
FAIL = "fail"


@dataclass(frozen=True)
class Check:
    """Common part of all checks. Only a failing ``error`` check blocks publication."""

    severity: str = field(default=ERROR, kw_only=True)

    @property
    def name(self) -> str:
        raise NotImplementedError

    def violations(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError


@dataclass(frozen=True)
class RowCheck(Check):
    """A check that can be decided on each row alone."""

    def violated(self) -> Column:
        raise NotImplementedError

    def violations(self, df: DataFrame) -> DataFrame:
        return df.where(self.violated())


@dataclass(frozen=True)
class NotNull(RowCheck):
    column: str

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def violated(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues(RowCheck):
    """Nulls pass."""

    column: str
    values: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"accepted_values({self.column})"

    def violated(self) -> Column:
        return F.col(self.column).isNotNull() & ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class AcceptedRange(RowCheck):
    """Bounds are inclusive and optional; nulls pass."""

    column: str
    minimum: float | None = None
    maximum: float | None = None

    @property
    def name(self) -> str:
        return f"accepted_range({self.column})"

    def violated(self) -> Column:
        outside = F.lit(False)
        if self.minimum is not None:
            outside = outside | (F.col(self.column) < self.minimum)
        if self.maximum is not None:
            outside = outside | (F.col(self.column) > self.maximum)
        return F.col(self.column).isNotNull() & outside


@dataclass(frozen=True)
class CoordinateBox(RowCheck):
    """Both coordinates must be present and inside the box. Defaults are fixed values."""

    latitude: str = "latitude"
    longitude: str = "longitude"
    south: float = 8.0
    north: float = 23.5
    west: float = 102.0
    east: float = 110.5

    @property
    def name(self) -> str:
        return f"coordinate_box({self.latitude},{self.longitude})"

    def violated(self) -> Column:
        inside = F.col(self.latitude).between(self.south, self.north) & F.col(self.longitude).between(
            self.west, self.east
        )
        return ~F.coalesce(inside, F.lit(False))


@dataclass(frozen=True)
class Unique(Check):
    """One violation per repeated value; nulls pass. Counts combine before the shuffle."""

    column: str

    @property
    def name(self) -> str:
        return f"unique({self.column})"

    def violations(self, df: DataFrame) -> DataFrame:
        values = df.where(F.col(self.column).isNotNull()).groupBy(self.column)
        return values.agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


@dataclass(frozen=True)
class References(Check):
    """Every non-null value must occur in ``parent[parent_column]``."""

    column: str
    parent: DataFrame
    parent_column: str
    policy: LookupPolicy = DEFAULT_POLICY

    @property
    def name(self) -> str:
        return f"relationships({self.column})"

    def violations(self, df: DataFrame) -> DataFrame:
        known = self.parent.where(F.col(self.parent_column).isNotNull()).select(
            F.col(self.parent_column).alias(self.column)
        )
        children = df.where(F.col(self.column).isNotNull())
        return lookup_join(children, known.distinct(), self.column, "left_anti", self.policy)


@dataclass(frozen=True)
class NotEmpty(Check):
    @property
    def name(self) -> str:
        return "not_empty"

    def violations(self, df: DataFrame) -> DataFrame:
        # A limit below the count lets the scan stop at the first row.
        return df.limit(1).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") == 0)


@dataclass(frozen=True)
class Freshness:
    """Age of the newest row. Defaults are fixed values; an empty table is an error."""

    column: str = "ingested_at"
    warn_after: timedelta = timedelta(minutes=5)
    error_after: timedelta = timedelta(minutes=30)

    def status(self, df: DataFrame, as_of: datetime | None = None) -> DataFrame:
        """One row: the newest time, the instant it is compared with, and pass, warn or error."""
        now = clock(as_of)
        newest = df.agg(F.max(self.column).alias("max_loaded_at"))
        state = (
            F.when(F.col("max_loaded_at").isNull(), ERROR)
            .when(F.col("max_loaded_at") < now - F.lit(self.error_after), ERROR)
            .when(F.col("max_loaded_at") < now - F.lit(self.warn_after), WARN)
            .otherwise(PASS)
        )
        return newest.select("max_loaded_at", now.alias("checked_at"), state.alias("status"))


def _row_check_counts(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """``(check, violations)`` rows for row checks and emptiness, from one scan."""
    counted = []
    for position, check in checks:
        if isinstance(check, NotEmpty):
            counted.append(F.count(F.lit(1)).alias(f"c{position}"))
        else:
            counted.append(F.count_if(check.violated()).alias(f"c{position}"))
    totals = df.agg(*counted)
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            (
                F.when(F.col(f"c{position}") == 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
                if isinstance(check, NotEmpty)
                else F.col(f"c{position}")
            ).alias("violations"),
        )
        for position, check in checks
    ]
    return totals.select(F.inline(F.array(*entries)))


def table_report(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Columns ``table_name, check_name, severity, violations, status``; one row per check."""
    scanned = [(i, c) for i, c in enumerate(checks) if isinstance(c, (RowCheck, NotEmpty))]
    counts = [_row_check_counts(df, scanned)] if scanned else []
    for position, check in enumerate(checks):
        if not isinstance(check, (RowCheck, NotEmpty)):
            rows = check.violations(df).agg(F.count(F.lit(1)).alias("violations"))
            counts.append(rows.select(F.lit(position).alias("position"), "violations"))
    merged = reduce(DataFrame.unionByName, counts)

    def pick(values: Sequence[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("position") + 1)

    return merged.select(
        F.lit(table).alias("table_name"),
        pick([c.name for c in checks]).alias("check_name"),
        pick([c.severity for c in checks]).alias("severity"),
        "violations",
        F.when(F.col("violations") == 0, PASS).otherwise(FAIL).alias("status"),
    )


def quality_report(suites: Sequence[tuple[str, DataFrame, Sequence[Check]]]) -> DataFrame:
    """Reports of several tables in one frame."""
    return reduce(DataFrame.unionByName, [table_report(t, df, checks) for t, df, checks in suites if checks])


def blocking(report: DataFrame) -> DataFrame:
    """Failed checks that must stop a publication."""
    return report.where((F.col("status") == FAIL) & (F.col("severity") == ERROR))


def empty_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "table_name string, check_name string, severity string, violations long, status string"
    )
