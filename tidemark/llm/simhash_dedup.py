"""SimHash near-duplicates by multi-index hashing.

1. *Fingerprints.* Bit b of a document's 64 is set if it is set in more than half of the XXH64 hashes of
   its word shingles, repeats included.
2. *Classes.* Documents with equal fingerprints are one point, so copies never meet as pairs.
3. *Segments.* 64 bits are cut into ``reach // 2 + 1`` segments. If two fingerprints differ in ``reach`` bits
   at most, they differ in one bit at most in some segment. The table of a segment holds each
   fingerprint under its bits there; each fingerprint fetches what lies in the Hamming ball of radius 1
   around its own bits. Links have no direction, so of the ball only the centre and the
   neighbours with one bit less are looked up: the other end looks up the rest.
4. *Crowded places.* Where more than ``crowd`` fingerprints share the bits of a segment, the other bits are cut
   into ``reach + 1`` blocks, of which linked fingerprints share one; there, both sides are dealt
   by segment, block and the block's bits as well. No candidate is dropped.
5. *Verification* of the whole distance, and components of the links.

Distinct fingerprints have a bounded number of neighbours in reach, so links are in proportion to the
classes, however many copies a class has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import discard, stored
from tidemark.llm.jaccard_join import components

SHINGLE = 3
SEED = 42
REACH = 3
CROWD = 256
_BITS = 64
# Shingles whose bits are counted at once.
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit number; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(shingle, len(words))
    count, total = np.zeros(_BITS, np.int64), len(words) - span + 1
    for k in range(0, total, _AT_ONCE):
        m = min(_AT_ONCE, total - k)
        pairs = zip(starts[k : k + m].tolist(), ends[k + span - 1 : k + span - 1 + m].tolist(), strict=True)
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in pairs], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, ``fp`` long) of all documents."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def _cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """Position and width of the parts of ``width`` bits, as even as possible."""
    edges = [width * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bits(column: str, at: int, width: int) -> Column:
    value = F.shiftrightunsigned(column, at)
    return value if width == _BITS else value.bitwiseAND(F.lit((1 << width) - 1))


def _without(column: str, at: int, width: int) -> Column:
    """The bits outside a segment, as one number."""
    if width == _BITS:
        return F.lit(0).cast("long")
    low, high = _bits(column, 0, at) if at else F.lit(0).cast("long"), F.lit(0).cast("long")
    if at + width < _BITS:
        high = F.shiftleft(F.shiftrightunsigned(column, at + width), at)
    return low.bitwiseOR(high)


def _table(classes: DataFrame, segments: list[tuple[int, int]]) -> DataFrame:
    """Rows (``seg``, ``key``, ``rest``, ``fp``): each fingerprint once per segment."""
    places = [
        F.struct(F.lit(k).alias("seg"), _bits("fp", at, width).alias("key"), _without("fp", at, width).alias("rest"))
        for k, (at, width) in enumerate(segments)
    ]
    return classes.select("fp", F.inline(F.array(*places))).select("seg", "key", "rest", "fp")


def _probes(table: DataFrame, width: int) -> DataFrame:
    """Rows (``seg``, ``key``, ``rest``, ``fp``, ``exact``): the keys that each fingerprint looks up."""
    cleared = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)),
        lambda bit: F.col("key").bitwiseAND(bit) != 0,
    )
    keys = F.concat(F.array("key"), F.transform(cleared, lambda bit: F.col("key").bitwiseXOR(bit)))
    looked = table.select("seg", F.col("key").alias("own"), "rest", "fp", F.explode(keys).alias("key"))
    return looked.select("seg", "key", "rest", "fp", (F.col("key") == F.col("own")).alias("exact"))


def _in_blocks(rows: DataFrame, width: int, reach: int) -> DataFrame:
    """``rows`` once per block of the other bits, with the block's bits in ``block``."""
    cuts = enumerate(_cuts(width, reach + 1))
    blocks = [F.struct(F.lit(k).alias("nr"), _bits("rest", at, w).alias("bits")) for k, (at, w) in cuts if w]
    return rows.withColumn("block", F.explode(F.array(*blocks)))


def _meet(table: DataFrame, probes: DataFrame, on: list[str], reach: int) -> DataFrame:
    # Always a shuffle: the rows that one fingerprint is made into are not in the optimiser's estimate of the size.
    found = probes.withColumnRenamed("fp", "p").drop("rest").join(table.withColumnRenamed("fp", "c").drop("rest").hint("shuffle_merge"), on)
    near = F.bit_count(F.col("p").bitwiseXOR(F.col("c"))) <= reach
    found = found.where(near & (~F.col("exact") | (F.col("c") < F.col("p"))))
    # The two ends may find each other in different segments.
    return found.select(F.greatest("p", "c").alias("p"), F.least("p", "c").alias("c"))


def links(classes: DataFrame, reach: int = REACH, crowd: int = CROWD) -> DataFrame:
    """Pairs (``p``, ``c``) of the distinct fingerprints ``fp`` that differ in 1 to ``reach`` bits, each once."""
    segments = _cuts(_BITS, reach // 2 + 1)
    widest, least = max(w for _, w in segments), min(w for _, w in segments)
    table = _table(classes, segments)
    probes = _probes(table, widest)
    crowded = stored(table.groupBy("seg", "key").count().where(F.col("count") > crowd).select("seg", "key"), "simhash-crowded")
    if crowded.isEmpty():
        found = _meet(table, probes, ["seg", "key"], reach)
    else:
        on = ["seg", "key"]
        found = _meet(table.join(crowded, on, "left_anti"), probes, on, reach)
        # The key of a crowded place is in its other bits' way no longer: these are cut instead.
        sides = [_in_blocks(x.join(crowded, on, "left_semi"), _BITS - least, reach) for x in (table, probes)]
        found = found.unionByName(_meet(*sides, [*on, "block"], reach))
    return found.distinct()


def near_duplicates(
    docs: DataFrame,
    reach: int = REACH,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowd: int = CROWD,
) -> DataFrame:
    """One row per document: id, ``fp`` and ``component_id``, the least id reachable over links.

    Null texts and texts without words have fingerprint zero and are linked like any other. Null ids are
    never the least; a component without any id has none. Ids may repeat: every row is returned.
    Other columns are not read; an empty table gives an empty result.
    """
    scanned = stored(fingerprints(docs, shingle, SEED, id_col, text_col), "simhash-fingerprints")
    classes = stored(scanned.groupBy("fp").agg(F.min(id_col).alias("label")), "simhash-classes")
    linked = stored(links(classes.select("fp"), reach, crowd), "simhash-links")
    reached = components(linked, classes.withColumnRenamed("fp", "c"))
    labels = classes.join(reached.select(F.col("c").alias("fp"), F.col("label").alias("least")), "fp", "left")
    # Stored, so that a class of very many copies can be split in the join.
    labels = stored(labels.select("fp", F.coalesce("least", "label").alias("component_id")), "simhash-labels")
    discard(linked)
    return scanned.join(labels, "fp", "left").select(id_col, "fp", "component_id")
