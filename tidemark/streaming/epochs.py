"""Epochs of a change log: an order of changes that survives a topic that is made anew or gets more partitions.

Within a partition the offset orders the changes of a key. It does so no longer once offsets start again or a
key moves to another partition. Micro-batches are read one after the other, so whenever one of that is
seen in a batch, its changes get a higher epoch, and offsets are compared within one epoch only (see
``latest_across_epochs``). What was decided for a batch is kept in one small document per batch, beside the checkpoint, and a
batch that is replayed gets the same epoch again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import MetadataFolder

PARTITION, POSITION, TIME, EPOCH = "change_partition", "change_seq", "kafka_timestamp", "change_epoch"

# Documents that stay; only those of batches that may still be replayed are needed.
KEPT = 100


class LogOrderError(ValueError):
    """The order of the changes in a batch cannot be told."""


def _seen(batch: DataFrame, newest: dict[str, int]) -> list[dict]:
    """Per partition its offsets and, where some lie at or below the newest known one and some above, the times
    at that border. One row per partition reaches the driver."""
    partition = F.coalesce(F.col(PARTITION), F.lit(0))
    placed = batch.where(F.col(POSITION).isNotNull()).select(partition.alias("p"), F.col(POSITION).alias("at"), F.col(TIME).alias("time"))
    if newest:
        known = batch.sparkSession.createDataFrame([(int(p), n) for p, n in newest.items()], "p int, newest long")
        placed = placed.join(F.broadcast(known), "p", "left")
    else:
        placed = placed.withColumn("newest", F.lit(None).cast("long"))
    below = F.col("at") <= F.col("newest")
    spans = placed.groupBy("p").agg(
        F.min("at").alias("first"),
        F.max("at").alias("last"),
        F.max(F.when(below, F.col("time"))).alias("below"),
        F.min(F.when(~below, F.col("time"))).alias("above"),
    )
    return [row.asDict() for row in spans.collect()]


def next_epoch(before: dict | None, spans: list[dict]) -> dict:
    """The document after a batch with these ``spans``: the epoch of its changes, the newest offsets since."""
    epoch, newest = (before["epoch"], dict(before["newest"])) if before else (0, {})
    rises = False
    for span in spans:
        known = newest.get(str(span["p"]))
        if known is None:
            # With more partitions a key may have moved here.
            rises = rises or bool(newest)
        elif span["first"] <= known:
            if span["first"] != 0:
                raise LogOrderError(
                    f"partition {span['p']} goes back from offset {known} to {span['first']}: neither a log that goes on nor one that starts again"
                )
            if span["below"] and span["above"] and span["below"] > span["above"]:
                raise LogOrderError(f"partition {span['p']} brings the old log and one that starts again in one batch")
            rises = True
    if rises:
        epoch, newest = epoch + 1, {p: n for p, n in newest.items() if p not in {str(s["p"]) for s in spans}}
    for span in spans:
        key = str(span["p"])
        newest[key] = max(newest.get(key, -1), span["last"])
    return {"epoch": epoch, "newest": newest}


class LogEpochs:
    """The epochs of one stream, in the folder ``path``."""

    def __init__(self, path: str):
        self._path = path

    def assign(self, batch: DataFrame, number: int, keys: list[str]) -> DataFrame:
        """``batch`` with its epoch, decided once per batch number.

        Fails where the order is unknown: a key in several partitions of the batch, an offset with several
        changes.
        """
        ledger = MetadataFolder(batch.sparkSession, self._path)
        known = ledger.latest_number()
        if known is None or known < number:
            before = None if known is None else ledger.read(known)
            self._require_order(batch, keys)
            ledger.write(number, next_epoch(before, _seen(batch, before["newest"] if before else {})))
            ledger.expire(KEPT)
        return batch.withColumn(EPOCH, F.lit(ledger.read(number)["epoch"]).cast("long")).drop(PARTITION)

    @staticmethod
    def _require_order(batch: DataFrame, keys: list[str]) -> None:
        places = batch.where(F.col(POSITION).isNotNull())
        keyed = places.where(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
        spread = keyed.groupBy(*keys).agg(F.min(PARTITION).alias("low"), F.max(PARTITION).alias("high")).where("low < high")
        if found := spread.take(1):
            raise LogOrderError(f"key {[found[0][k] for k in keys]} changes in several partitions of one batch")
        content = F.xxhash64(*[c for c in batch.columns if c not in (TIME, "change_ts", "ingested_at")])
        repeated = places.groupBy(PARTITION, POSITION).agg(F.min(content).alias("low"), F.max(content).alias("high")).where("low < high")
        if found := repeated.take(1):
            raise LogOrderError(f"offset {found[0][POSITION]} has several changes in one batch")
