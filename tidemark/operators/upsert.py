"""Upsert of a change set into a keyed table, as a DataFrame operator and as SQL ``MERGE``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key


def sync_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """Give ``target`` the columns of ``source``: new ones are added as null, others dropped."""
    have = set(target.columns)
    return target.select(
        *[
            F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in source.schema
        ]
    )


def latest_changes(changes: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the newest change. Several changes of a key would break a ``MERGE``."""
    present = changes.where(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    return latest_per_key(present, keys, order_cols)


def latest_across_epochs(
    changes: DataFrame, keys: Sequence[str], epoch: str, time: str, order_cols: Sequence[str], newest: str = "epoch_ts"
) -> DataFrame:
    """One row per key where ``order_cols`` compare changes within one ``epoch`` of the log only.

    Within an epoch the last change counts, whatever its time. Between epochs no position can be compared, so
    the epoch in which the key has the newest ``time`` wins, and of equal ones the later. ``newest`` holds
    that time in the result, so a result may be reduced again together with changes that come later in
    the log, or that came before, once more.
    """
    present = changes.where(F.expr(" and ".join(f"`{k}` is not null" for k in [*keys, epoch])))
    known = F.greatest(F.col(newest), F.col(time)) if newest in changes.columns else F.col(time)
    # Both combine on the map side, so a much changed key reaches its task as a few rows.
    times = present.groupBy(*keys, epoch).agg(F.max(known).alias(newest))
    last = latest_per_key(present.drop(newest), [*keys, epoch], order_cols)
    return latest_per_key(last.join(times, [*keys, epoch]), keys, [newest, epoch, *order_cols]).select(
        *[c for c in changes.columns if c != newest], newest
    )


def live_rows(state: DataFrame, delete_col: str = "is_deleted") -> DataFrame:
    """Rows that are not marked as deleted."""
    return state.where(~F.coalesce(F.col(delete_col), F.lit(False)))


def upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = ()
) -> DataFrame:
    """The state of ``target`` after ``changes``, with the schema of ``changes``.

    For a key on both sides the change wins if its ``order_cols`` are not older, so replays and
    late arrivals cannot undo newer state. A delete stays in the state as a marked row: without
    it, a change older than the delete would bring the key back. Read with :func:`live_rows`.
    Both sides hold one row per key once the changes are reduced, so the join cannot skew.
    """
    columns = changes.columns
    if order_cols:
        changes = latest_changes(changes, keys, order_cols)
    old = sync_schema(target, changes).select(*keys, F.struct(*columns).alias("old"))
    new = changes.select(*keys, F.struct(*columns).alias("new"))
    newer = _not_older(order_cols)
    row = F.when(F.col("old").isNull() | (F.col("new").isNotNull() & newer), F.col("new")).otherwise(F.col("old"))
    return old.join(new, list(keys), "full_outer").select(row.alias("row")).select("row.*")


def _not_older(order_cols: Sequence[str]) -> Column:
    if not order_cols:
        return F.lit(True)
    # Struct comparison ranks null lowest, field by field.
    return F.struct(*[F.col(f"new.{c}") for c in order_cols]) >= F.struct(*[F.col(f"old.{c}") for c in order_cols])


def merge_statement(table: str, columns: Sequence[str], keys: Sequence[str], order_cols: Sequence[str],
                    delete_col: str | None = "is_deleted") -> str:
    """``MERGE`` text with the same rules as :func:`upsert`; ``{changes}`` stands for the source.

    Matched and deleted keys are removed, other matched keys updated, and unknown keys inserted
    unless the change is a delete. Deleted keys leave no marker here, so changes of one key must
    arrive in order.
    """

    def order(side: str) -> str:
        return f"struct({', '.join(f'{side}.`{c}`' for c in order_cols)})"

    match = " and ".join(f"target.`{k}` = source.`{k}`" for k in keys)
    newer = f"{order('source')} >= {order('target')}" if order_cols else "true"
    assigned = ", ".join(f"target.`{c}` = source.`{c}`" for c in columns if c not in keys)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"source.`{c}`" for c in columns)
    clauses = [f"merge into {table} as target using {{changes}} as source on {match}"]
    insert_if = ""
    if delete_col:
        clauses.append(f"when matched and {newer} and source.`{delete_col}` then delete")
        insert_if = f" and not coalesce(source.`{delete_col}`, false)"
    clauses.append(f"when matched and {newer} then update set {assigned}")
    clauses.append(f"when not matched{insert_if} then insert ({names}) values ({values})")
    return "\n".join(clauses)


def merge_into(
    table: str,
    changes: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    delete_col: str | None = "is_deleted",
) -> None:
    """Run :func:`merge_statement` on a table whose catalog supports row-level changes."""
    statement = merge_statement(table, changes.columns, keys, order_cols, delete_col)
    changes.sparkSession.sql(statement, changes=latest_changes(changes, keys, order_cols))
