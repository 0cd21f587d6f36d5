"""Joins of a large table with a reference table that has one row per key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class LookupPolicy:
    """Bounds of what :func:`lookup_join` sends to every executor."""

    broadcast_bytes: int = 128 * 1024 * 1024
    broadcast_rows: int = 1_000_000


DEFAULT_POLICY = LookupPolicy()


def _row_bytes(schema: T.StructType) -> Column:
    """In-memory size of one row: measured for text and binary, fixed for the other types."""
    size = F.lit(16 + 8 * len(schema))
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return size


def fits_broadcast(df: DataFrame, policy: LookupPolicy = DEFAULT_POLICY) -> bool:
    """Measure ``df`` and tell whether it is within the broadcast limits.

    Each task counts its rows and bytes and hands on these two numbers, however large ``df`` is.
    """
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df.schema)).alias("bytes")).first()
    return row["n"] <= policy.broadcast_rows and (row["bytes"] or 0) <= policy.broadcast_bytes


def lookup_join(
    fact: DataFrame, reference: DataFrame, key: str, how: str = "inner", policy: LookupPolicy | None = DEFAULT_POLICY
) -> DataFrame:
    """Join ``fact`` with ``reference`` on the column ``key``, present on both sides.

    ``reference`` must hold one row per key; ``how`` is ``inner``, ``left`` or ``left_anti``. A
    reference table that measures within the policy is broadcast and the fact table is not
    shuffled. A larger one is joined by shuffle; adaptive execution splits the partitions of hot
    keys, and sees the size of what was shuffled, so it may still broadcast.

    Measuring reads the reference once, so it is meant for stored tables. ``policy`` None leaves the
    choice to adaptive execution alone, for a reference that is costly to compute.
    """
    if policy is not None and fits_broadcast(reference, policy):
        reference = F.broadcast(reference)
    return fact.join(reference, key, how)
