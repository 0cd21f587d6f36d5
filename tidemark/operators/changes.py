"""Change-data-capture records: unwrapping, decoding and combining with a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETED_MARK = "__deleted"
# The position in the log orders the changes of a key; the clocks of the row and of the broker do not.
# The time decides only where records come without a position.
LOG_ORDER = ("change_seq", "change_ts")
# Epoch-millisecond columns of the change payloads.
EPOCH_MILLIS_COLUMNS = ("created_at", "updated_at", "activated_at")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _unwrapped(column: str) -> Column:
    """The JSON below ``$.payload`` when the converter adds that wrapper, else the JSON itself."""
    value = _text(column)
    # Looking for the wrapper parses the whole text; without its name, or an escape that may spell it, there is none.
    wrapped = value.contains("payload") | value.contains("\\")
    return F.when(wrapped, F.coalesce(F.get_json_object(value, "$.payload"), value)).otherwise(value)


def _log_columns(records: DataFrame, with_partition: bool) -> list[Column]:
    """Broker time and, where the source has it, the position in the change log, and its partition if asked for."""
    position = F.col("offset") if "offset" in records.columns else F.lit(None)
    log = [F.col("timestamp").alias("kafka_timestamp"), position.cast("long").alias("change_seq")]
    if with_partition:
        log.append((F.col("partition") if "partition" in records.columns else F.lit(None)).cast("int").alias("change_partition"))
    return log


def _key_value(key_column: str) -> Column:
    """The row key from the record key: a field of it where that is a JSON object, else its text."""
    key = _text("key")
    return F.coalesce(
        F.get_json_object(_unwrapped("key"), f"$.{key_column}"), F.when(~F.coalesce(key.startswith("{"), F.lit(False)), key)
    )


def _row_images(records: DataFrame, row_schema: T.StructType, key_column: str | None) -> tuple[DataFrame, list[Column]]:
    """The records of envelopes that bring a row, and the columns of that row with the deleted mark at the end."""
    image = T.StructType([f for f in row_schema if f.name != DELETED_MARK])
    envelope = T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
        ]
    )
    # The generator keeps the filter on the row from being pushed down with further parsers, even below joins.
    parts = F.inline(F.array(F.from_json(_unwrapped("value"), envelope))).alias("__before", "__after", "__op")
    decoded = records.where(F.col("value").isNotNull()).select("*", parts)
    is_delete = F.col("__op") == "d"
    before = F.col("__before")
    if key_column is not None:
        only_key = [
            (_key_value(key_column) if f.name == key_column else F.lit(None)).cast(f.dataType).alias(f.name) for f in image
        ]
        before = F.coalesce(before, F.when(_key_value(key_column).isNotNull(), F.struct(*only_key)))
    row = F.when(is_delete, before).otherwise(F.col("__after"))
    mark = F.when(is_delete, F.lit("true")).otherwise(F.lit("false"))
    fields = [*[F.col(f"__row.{f.name}").alias(f.name) for f in image], mark.alias(DELETED_MARK)]
    return decoded.withColumn("__row", row).where(F.col("__row").isNotNull()), fields


def flatten_envelopes(records: DataFrame, row_schema: T.StructType, key_column: str | None = None) -> DataFrame:
    """Turn ``before / after / op`` envelopes into flat JSON rows.

    Keeps the new row state only, drops tombstones (null values), and rewrites a delete to the
    old row with the deleted mark set. With ``key_column``, a delete that brings no old row keeps the
    key of its record, which is all that an upsert needs; without, it is dropped. The result has the columns of the input, with ``value``
    replaced, so :func:`parse_changes` reads it like records that were flattened at the source.
    """
    decoded, fields = _row_images(records, row_schema, key_column)
    return decoded.withColumn("value", F.to_json(F.struct(*fields))).drop("__before", "__after", "__op", "__row")


def parse_envelopes(
    records: DataFrame, schema: T.StructType, key_column: str | None = None, ingested_at: Column | None = None, with_partition: bool = False
) -> DataFrame:
    """:func:`parse_changes` of what :func:`flatten_envelopes` gives, without writing and reading the rows as JSON."""
    decoded, fields = _row_images(records, schema, key_column)
    return _typed(decoded.select(*fields, *_log_columns(records, with_partition)), ingested_at)


def parse_changes(
    records: DataFrame, schema: T.StructType, ingested_at: Column | None = None, with_partition: bool = False
) -> DataFrame:
    """Decode flat change records into typed rows with a two-valued ``is_deleted``.

    Adds ``kafka_timestamp``, ``change_seq`` (log position) and ``change_ts``. The last one is
    the row's ``updated_at``, or the broker time where the row has none; for a delete, whose row
    image may hold only the key, it is the later of the two. ``with_partition`` also adds
    ``change_partition``, null where the source has none.
    """
    # The generator keeps filters on the fields from being pushed down with a second parser.
    row = F.inline(F.array(F.from_json(_unwrapped("value"), schema)))
    return _typed(records.select(row, *_log_columns(records, with_partition)), ingested_at)


def _typed(parsed: DataFrame, ingested_at: Column | None) -> DataFrame:
    stamps = {c: F.timestamp_millis(c) for c in EPOCH_MILLIS_COLUMNS if c in parsed.columns}
    typed = parsed.withColumns(stamps).withColumns(
        {
            "is_deleted": F.col(DELETED_MARK).eqNullSafe("true"),
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        }
    )
    change_ts = F.when(F.col("is_deleted"), F.greatest("updated_at", "kafka_timestamp")).otherwise(
        F.coalesce("updated_at", "kafka_timestamp")
    )
    return typed.withColumn("change_ts", change_ts).drop(DELETED_MARK)


def snapshot_with_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """An initial table copy followed by its change log, as one change set.

    Snapshot rows are never deletes, and their log position of -1 sorts before every logged change.
    """
    base = snapshot.withColumns({"is_deleted": F.lit(False), "change_seq": F.lit(-1).cast("long")})
    return base.select(*[c for c in changes.columns if c in base.columns]).unionByName(
        changes, allowMissingColumns=True
    )
