"""Filter interaction audit by incremental retraction streaming.

What five filters do in every order follows from how many documents fail which of them. So the audit keeps
counters per part and mask (bit k set: the document fails filter k) and derives all orders from them.

1. *Micro-batches.* A stream reads all files of the table in some micro-batches (available now) and
   computes the masks of the four filters that look at one text.
2. *Combining.* Every task first reduces its copies of a text to one row per part, with the least id, so a text
   that holds a third of all rows reaches its state as a few rows per batch.
3. *State.* Per text (by its SHA-256) it holds the least id so far and what was counted for it; one state
   object has the texts of one small range of hashes. The least id passes the copy filter, every larger one fails it. When a smaller id arrives, the old holder's
   mask is retracted from its counter (-1) and counted again as a copy (+1).
4. *Counters.* Each micro-batch writes the sums of its changes under its own number, so a batch that is
   replayed after a crash replaces what it wrote. Their total does not depend on the order of the files.

A restart on the same folder goes on after the last finished micro-batch.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.llm.frames import stored
from tidemark.session import shared_folder
from tidemark.sources.files import MetadataFolder

FILTERS = "ABCDE"
COPY = 16
# Fixed values of the filters.
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"
_CAPITALS, _CONTINUATION = bytes(range(0x41, 0x5B)), bytes(range(0x80, 0xC0))
MICRO_BATCHES = 4
# One state holds the least ids of about so many texts, since calling a function for each text alone costs
# more than all its work.
TEXTS_PER_STATE = 2000

_COUNTERS = "part string, mask int, n long, good long, toxic long"
_CHANGES = "part string, mask int, good boolean, toxic boolean, n long"
_CHANGE = ["part", "mask", "good", "toxic"]
_COMBINED = "bucket long, text_key string, mask int, part string, good boolean, toxic boolean, least long, n_least long, n long"
_STATE = "held binary"
_HELD = pa.schema(
    [
        ("text_key", pa.string()), ("mask", pa.int32()), ("part", pa.string()), ("good", pa.bool_()), ("toxic", pa.bool_()),
        ("least", pa.int64()), ("n_least", pa.int64()),
    ]
)


def own_mask(text: bytes) -> int:
    """The bits of the filters A to D, which a UTF-8 text fails or passes on its own."""
    words = text.split()  # at the ASCII blanks, 0x20 and 0x09 to 0x0D
    capitals, points = len(text) - len(text.translate(None, _CAPITALS)), len(text.translate(None, _CONTINUATION))
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * capitals > MOST_CAPITAL_PERCENT * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << k for k, fail in enumerate(fails) if fail)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks, keys = [], []
        for value in batch.column(2).cast(pa.binary()):
            text = value.as_buffer().to_pybytes()
            masks.append(own_mask(text))
            keys.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(keys, pa.string())],
            names=["doc_id", "part", "mask", "text_key"],
        )


def _flags(labels: DataFrame) -> DataFrame:
    """Per labelled id (once, however often it is labelled) whether it is good or toxic, if it is either."""
    marked = labels.select("doc_id", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    marked = marked.where((F.col("good") | F.col("toxic")) & F.col("doc_id").isNotNull())
    return marked.groupBy(F.col("doc_id").alias("labelled")).agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one text, part and label in a batch as one: the least id, its rows, and all rows."""
    names = ["bucket", "text_key", "mask", "part", "good", "toxic"]
    for batch in batches:
        counted = pa.table(batch).group_by([*names, "doc_id"]).aggregate([([], "count_all")])
        counted = counted.append_column("known", pa.compute.is_valid(counted["doc_id"])).sort_by("doc_id")
        # Rows without an id are nobody's copy; they stay by themselves.
        least = counted.group_by([*names, "known"], use_threads=False)
        least = least.aggregate([("doc_id", "first"), ("count_all", "first"), ("count_all", "sum")])
        columns = [*[least[n] for n in names], least["doc_id_first"], least["count_all_first"], least["count_all_sum"]]
        out = pa.table(columns, names=[*names, "least", "n_least", "n"])
        yield from out.combine_chunks().to_batches()


def _held_table(held: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(held, schema=_HELD, preserve_index=False)
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, _HELD) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()


def _retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The changes of the counters that new rows of some texts lead to; per text, the state holds its least id
    and how often that was counted for which part and labels."""
    names, held = _HELD.names, _HELD.empty_table().to_pandas()
    if state.exists:
        held = pa.ipc.open_stream(state.get[0]).read_all().to_pandas()
    for frame in frames:
        alone = frame[frame["least"].isna()]
        new = frame[frame["least"].notna()].astype({"least": "int64"})
        both = pd.concat([held.assign(n=0), new], ignore_index=True)
        stays = both["least"].to_numpy() == both.groupby("text_key")["least"].transform("min").to_numpy()
        old = both.index.to_numpy() < len(held)
        lost, came, above = both[old & ~stays], both[~old], both[~old].assign(n_least=both["n"] - both["n_least"])
        found = [
            # The holders that a smaller id has replaced are taken back and become copies.
            lost.assign(n=-lost["n_least"]),
            lost.assign(n=lost["n_least"], mask=lost["mask"] | COPY),
            came.assign(n=came["n_least"], mask=came["mask"] | np.where(stays[~old], 0, COPY)),
            above.assign(n=above["n_least"], mask=above["mask"] | COPY),
            alone,
        ]
        changes = pd.concat(found).groupby(_CHANGE, as_index=False)["n"].sum()
        yield changes[changes["n"] != 0][[*_CHANGE, "n"]]
        held = both[stays].groupby([n for n in names if n != "n_least"], as_index=False)["n_least"].sum()[names]
    state.update((_held_table(held),))


def _buckets(spark: SparkSession, rows: int, folder: str) -> int:
    """Into how many states the texts are dealt; fixed with the first start on a folder."""
    known = MetadataFolder(spark, f"{folder}/buckets")
    if known.latest() is None:
        known.write(0, {"buckets": max(1, math.ceil(rows / TEXTS_PER_STATE))})
    return known.latest()["buckets"]


def count_masks(
    spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES, folder: str | None = None
) -> DataFrame:
    """Counters (``part``, ``mask``, ``n``, ``good``, ``toxic``) of the documents in the Parquet table ``path``.

    ``folder`` keeps the stream's checkpoint and counters; give the same one again to go on after a crash
    or to count files that came since.
    """
    root = folder or shared_folder(spark, "filter-audit")
    given = spark.read.parquet(path)
    files, name = given.inputFiles(), path.rstrip("/").rsplit("/", 1)[-1]
    if files and files[0].endswith(f"/{name}"):
        path = f"{path[:-1]}[{path[-1]}]"  # a stream takes one file only as a pattern
    at_once = max(1, math.ceil(len(files) / micro_batches))
    stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", at_once)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stream.parquet(path).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    rows = rows.mapInArrow(_scan, "doc_id long, part string, mask int, text_key string")
    # Null ids match no label; they are dealt by text, not all to one task.
    spread = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("text_key"), F.lit(1024))).otherwise(0)
    flags = stored(_flags(labels), "filter-audit-labels").withColumn("of", F.lit(0).cast("long"))
    rows = rows.withColumn("spread", spread.cast("long"))
    bucket = F.pmod(F.xxhash64("text_key"), F.lit(_buckets(spark, given.count(), root)))
    rows = rows.join(flags, (F.col("doc_id") == F.col("labelled")) & (F.col("spread") == F.col("of")), "left").select(
        bucket.alias("bucket"), "text_key", "mask", "part", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")], "doc_id"
    )
    changes = (
        rows.mapInArrow(_combine, _COMBINED)
        .groupBy("bucket")
        .applyInPandasWithState(_retract, _CHANGES, _STATE, "update", GroupStateTimeout.NoTimeout)
    )

    def add(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask").agg(
            F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")]
        )
        sums.coalesce(1).write.mode("overwrite").parquet(f"{root}/counters/batch={number}")

    spark.createDataFrame([], _COUNTERS).write.mode("overwrite").parquet(f"{root}/counters/batch=-1")
    query = (
        changes.writeStream.foreachBatch(add)
        .outputMode("update")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    counters = spark.read.schema(_COUNTERS).parquet(f"{root}/counters")
    return counters.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def interactions(counters: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counters of masks.

    What a step does depends on its filter and on the set of the earlier ones only, so per part these few
    combinations are computed first and then listed for every order.
    """
    spark, size = counters.sparkSession, len(filters)
    bits = {name: 1 << k for k, name in enumerate(filters)}
    sets = [(bit, before) for bit in bits.values() for before in range(1 << size) if not before & bit]
    orders = {bit_before: math.factorial(bit_before[1].bit_count()) * math.factorial(size - 1 - bit_before[1].bit_count()) for bit_before in sets}
    cases = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(s).alias("before"), F.lit(orders[b, s]).cast("long").alias("orders")) for b, s in sets])
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0)).alias("x")

    each = counters.select("*", F.inline(cases)).groupBy("part", "bit", "before", "orders")
    each = each.agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    shares = each.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = []
    for order in permutations(filters):
        earlier = 0
        for k, name in enumerate(order, 1):
            steps.append(("".join(order), k, bits[name], earlier))
            earlier |= bits[name]
    listed = spark.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    return (
        each.join(shares, ["part", "bit"])
        .join(F.broadcast(listed), ["bit", "before"])
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )


def audit(
    spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES, folder: str | None = None
) -> DataFrame:
    """What each filter does at each step of every order, per part (``lang``; null is the empty string).

    ``path`` is a Parquet table with ``doc_id``, ``text`` and ``lang``; other columns are not read. Null texts are
    empty. A row without an id is never a copy and makes none. Rows that repeat an id with the same
    text are not copies of one another. An id is good (toxic) if any of its labels says so. An empty
    table has no parts and gives no rows.
    """
    return interactions(count_masks(spark, path, labels, micro_batches, folder))
