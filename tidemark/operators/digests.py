"""Which days of a table have changed: digests that depend on the rows, not on their order or on a clock."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _halves(content: Column) -> list[Column]:
    """Sums of the signed halves of 64-bit hashes: they add up in any order and stay far from overflow."""
    return [F.sum(F.shiftright(content, 32)).alias("high"), F.sum(F.shiftright(F.shiftleft(content, 32), 32)).alias("low")]


def _as_text(grouped: DataFrame) -> dict[str, str]:
    """One short text per day reaches the driver."""
    return {row["day"]: f"{row['n']}:{row['high']}:{row['low']}" for row in grouped.where("day is not null").collect()}


def row_digests(rows: DataFrame, day: Column, leave_out: Iterable[str] = ()) -> dict[str, str]:
    """Per day the number of rows and the sum of their hashes, over all columns but ``leave_out``."""
    columns = [c for c in rows.columns if c not in set(leave_out)]
    hashed = rows.select(day.alias("day"), F.xxhash64(*columns).alias("h"))
    return _as_text(hashed.groupBy("day").agg(F.count(F.lit(1)).alias("n"), *_halves(F.col("h"))))


def file_digests(rows: DataFrame, day: Column) -> dict[str, str] | None:
    """The same over the files that hold rows of a day: name, size and rows. Where ``day`` is a folder column this
    reads no data. None if the rows do not come from files."""
    try:
        files = rows.select(day.alias("day"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    except AnalysisException:
        return None
    counted = files.groupBy("day", "path", "size").agg(F.count(F.lit(1)).alias("rows"))
    hashed = counted.select("day", F.xxhash64("path", "size", "rows").alias("h"))
    return _as_text(hashed.groupBy("day").agg(F.count(F.lit(1)).alias("n"), *_halves(F.col("h"))))


def differing(before: dict[str, str], now: dict[str, str]) -> list[str]:
    """Days whose digest is new, gone or another one."""
    return sorted(day for day in before.keys() | now.keys() if before.get(day) != now.get(day))


# --- days that hold given ids ---------------------------------------------------------------------

# Bits of one block, which is one built-in bitmap of 4 KB, and ids that a block is meant for.
BLOCK_BITS = 32768
IDS_PER_BLOCK = 1024
HASHES = 8


def _places(ids: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Per id one hash that chooses the block and one for the bits in it."""
    return ids.select(*keep, F.xxhash64("event_id").alias("at"), F.xxhash64("event_id", F.lit(1)).alias("bits"))


def _bit(k: Column | int) -> Column:
    step = F.shiftrightunsigned("bits", 32).bitwiseOR(F.lit(1))
    return F.pmod(F.col("bits").bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(k) * step, F.lit(BLOCK_BITS)).cast("int")


# A bit in its word: the first byte is the highest one, which hex writes first; in a byte the lowest bit comes first.
_MASK = "shiftleft(1L, 56 - 8 * (shiftright(bit, 3) & 7) + (bit & 7))"
# The words of a block one after the other, with zeros for those that are missing.
_JOINED = (
    "unhex(rpad(array_join(transform(words, (w, i) -> concat("
    "repeat('0', 16 * (w.word - if(i = 0, -1, words[i - 1].word) - 1)), w.text)), ''), "
    f"{BLOCK_BITS // 4}, '0'))"
)


def _is_set(bit: str) -> Column:
    """Whether the bitmap of a row has the bit."""
    byte = f"cast(conv(hex(substring(bitmap, shiftright({bit}, 3) + 1, 1)), 16, 10) as int)"
    return F.expr(f"shiftright({byte}, {bit} & 7) & 1") == 1


def day_filters(ids: DataFrame) -> DataFrame:
    """A Bloom filter of the ``event_id`` of each ``day``, as rows (``day``, ``blocks``, ``block``, ``bitmap``).

    The bits of an id lie in one block; the number of blocks is a power of two that follows the ids of the
    day, at 32 bits an id. A bitmap has the layout of the engine's own. It is put together from words of 64 bits, as
    the engine's bitmap aggregate sorts a row per bit: ids are shuffled once, bits meet in a hash aggregate.
    """
    sizes = ids.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    power = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / IDS_PER_BLOCK)))
    placed = _places(ids, ["day"]).join(sizes.select("day", F.pow(F.lit(2.0), power).cast("long").alias("blocks")), "day")
    bits = F.explode(F.array(*[_bit(k) for k in range(HASHES)]))
    place = ["day", "blocks", "block"]
    dealt = placed.select("day", "blocks", F.pmod("at", "blocks").alias("block"), "bits").repartition(*place)
    marked = dealt.select(*place, bits.alias("bit")).select(*place, F.shiftright("bit", 6).alias("word"), F.expr(_MASK).alias("mask"))
    words = marked.groupBy(*place, "word").agg(F.bit_or("mask").alias("mask"))
    listed = F.array_sort(F.collect_list(F.struct("word", F.lpad(F.hex("mask"), 16, "0").alias("text"))))
    return words.groupBy(*place).agg(listed.alias("words")).select(*place, F.expr(_JOINED).alias("bitmap"))


def _probe(ids: DataFrame, filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """The day of each pair of an id and a filter, of one of ``sizes``, that has all its bits."""
    asked = _places(ids, []).withColumn("blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
    names = [f"bit{k}" for k in range(HASHES)]
    asked = asked.select("blocks", F.pmod("at", "blocks").alias("block"), *[_bit(k).alias(name) for k, name in enumerate(names)])
    # Plain conditions, not a function over an array of bits: they are compiled, and the first bit that is 0 ends the test.
    return filters.join(asked, ["blocks", "block"]).where(reduce(and_, [_is_set(name) for name in names])).select("day")


def days_that_may_hold(ids: DataFrame, filters: DataFrame) -> list[str]:
    """Days whose filter does not rule out all of ``ids`` (``event_id``); some of them may hold none."""
    sizes = [r["blocks"] for r in filters.select("blocks").distinct().collect()]  # powers of two, so a few
    return sorted(r["day"] for r in _probe(ids, filters, sizes).distinct().collect()) if sizes else []
