"""N-gram Jaccard join in the metric space of word-shingle sets.

Jaccard distance is a metric, and two sets are linked if it is at most ``reach`` = 1/4.

1. *Regions.* The first pivots are single shingles. A document lies at distance 1 - 1/n from each
   of its own shingles and at 1 from all others, so its nearest pivots are its own shingles. Of two
   linked documents with at most n shingles, at most n - ceil(3n/4) of the larger one's are not
   shared, so in any fixed order of all shingles each of both has a shared shingle among its first
   n - ceil(3n/4) + 1. These are the regions a document is copied to. Equal sets are one point.
   This is done twice: the first time, hashes order the shingles, ``f(n)`` = 1 + n/16 more of them
   are looked at, and documents that do not share as many of these with others as a link needs are
   done. Among the rest shingles are counted, and the order puts frequent
   ones last, so a passage that many documents share makes a region only of documents that
   consist of it. The counts are kept in a table of fixed size; places that shingles share make
   the order worse, never the result.
2. *Recursion.* Each region elects a document in its middle as pivot, and the regions of one pivot
   become one, the pivot's cell: copies share most of their shingles, so they meet there once.
   The exact distance of every member to the pivot is computed. Members within reach of it are linked, and so connected with one
   another; a cell of one component is done. The members of the others are dealt into rings of width
   ``reach`` around the pivot: by the triangle inequality, partners lie in the same ring or in neighbouring ones, so
   these are what a member is replicated to. Rings are cut into blocks of bounded size, and each pair of
   blocks is compared in one task as a product of sparse matrices. It hands on as many links as connect what
   belongs together, so neither pairs nor links of a crowded cell become rows.
3. *Components* of the links, by repeated hooking to the smallest neighbour.

No pair is missed and no region is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidemark.llm import arrays
from tidemark.llm.frames import discard, free_name, stored

SHINGLE = 5
SKETCH_BITS = 18
NEEDED_BITS = 22
LEVEL_BITS = 24
# Bounds of a block: members, and shingles of all of them.
BLOCK_MEMBERS = 256
BLOCK_SHINGLES = 1 << 17
# Columns of a block that are multiplied at once.
_COLUMNS = 1 << 11
# Linked if SHARE[1] * intersection >= SHARE[0] * union.
SHARE = (75, 100)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one, of all of them."""
    for a, b in arrays.pieces(offsets):
        part = offsets[a : b + 1]
        low = arrays.LOWER[data[part[0] : part[-1]]]
        starts, ends, own = arrays.words(low, part - part[0], arrays.NOT_BLANK)
        h = arrays.span_hashes(low, starts, ends)
        grams, at = arrays.ngram_hashes(h, own, shingle)
        for k in range(b - a):
            if at[k + 1] > at[k]:
                yield np.unique(grams[at[k] : at[k + 1]])
            elif own[k + 1] > own[k]:
                whole = h[own[k] : own[k + 1]]
                yield arrays.ngram_hashes(whole, np.array([0, len(whole)]), len(whole))[0]
            else:
                yield grams[:0]


def set_key(members: np.ndarray) -> int:
    """Hash of a sorted set."""
    with np.errstate(over="ignore"):
        h = arrays.mix(members + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64) + np.uint64(len(members))
        return int(arrays.mix(np.array([h]))[0].view(np.int64))


def _scan(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Per document its id, set size and set key; per task one more row with the sketch of its sets."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, id_type = np.zeros(1 << SKETCH_BITS, np.uint32), None
        names = [id_col, "n", "c", "sketch"]
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(1))
            sizes, keys, id_type = [], [], batch.column(0).type
            for members in shingle_sets(data, offsets, shingle):
                sizes.append(len(members))
                keys.append(set_key(members) if len(members) else None)
                np.add.at(sketch, (members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.nulls(len(sizes), pa.binary())], names=names
            )
        if id_type is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([sketch.tobytes()], pa.binary())], names=names
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n long, c long, sketch binary")


def _sum_sketches(rows: DataFrame) -> np.ndarray:
    """The sum of all sketches, added up in a tree of at most 32 a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                x = np.frombuffer(value.as_py(), np.uint32)
                total = x.astype(np.uint64) if total is None else total + x
        if total is not None:
            low = np.minimum(total, 2**32 - 1).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([low.tobytes()], pa.binary())], names=["sketch"])

    n = rows.count()
    while n > 32:
        n = -(-n // 32)
        rows = rows.repartition(n).mapInArrow(add, "sketch binary")
    parts = [np.frombuffer(r["sketch"], np.uint32).astype(np.uint64) for r in rows.collect()]
    return sum(parts) if parts else np.zeros(1 << SKETCH_BITS, np.uint64)


def _levels(sketch: np.ndarray) -> np.ndarray:
    """How frequent the shingles of a sketch place are: 0 for all usual ones, then powers of two."""
    usual = 4 * (sketch.mean() + 1)
    return np.clip(np.floor(np.log2(np.maximum(sketch, 1) / usual)) + 1, 0, 15).astype(np.uint8)


def _regions_of(n: int) -> int:
    """Of so many first shingles, a linked set shares one at least."""
    return n + (-n * SHARE[0]) // SHARE[1] + 1


def _more(n):
    """Of the first n - ceil(3n/4) + f(n) shingles of both, linked sets share the lesser f."""
    return n // 16 + 1


def _regions(docs: DataFrame, levels: np.ndarray, shingle: int, text_col: str) -> DataFrame:
    """Rows (``o``, ``c``): the regions of each set, and ``_more`` others, once per task. The four high
    bits of ``o`` hold the level, so regions sort rare first."""
    shared = docs.sparkSession.sparkContext.broadcast(levels.tobytes())  # 2**SKETCH_BITS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = np.frombuffer(shared.value, np.uint8), set()
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(0))
            out, keys = [], []
            for members in shingle_sets(data, offsets, shingle):
                n = len(members)
                if not n or (key := set_key(members)) in seen:
                    continue
                seen.add(key)
                order = (level[(members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(60)) | (members >> np.uint64(4))
                out.append(np.sort(order)[: _regions_of(n) - 1 + _more(n)])
                keys.append(key)
            if out:
                count = [len(x) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(keys, count))], names=["o", "c"]
                )

    return docs.select(text_col).mapInArrow(run, "o long, c long")


def _with_pivots(rows: DataFrame) -> DataFrame:
    """Members of regions with two sets or more, with the region's pivot ``p``: the set whose shingles
    are the most common, which lies in the middle of copies that were changed in different places."""
    pivots = rows.groupBy("o").agg(F.max(F.struct("w", "c", "n", "s")).alias("pivot"), F.min("c").alias("first"), F.max("c").alias("last"))
    pivots = pivots.where("first < last").select("o", F.col("pivot.c").alias("p"), F.col("pivot.n").alias("pn"), F.col("pivot.s").alias("ps"))
    return rows.join(pivots, "o").where("c != p")


def _in_company(regions: DataFrame, classes: DataFrame) -> DataFrame:
    """Of ``classes`` (``c``, ``n``, ...) those that share as many regions with others as a linked set does.

    Rows of shingles that are frequent by the sketch meet a small table, which Spark may broadcast;
    the others are dealt by shingle once, for finding the shared ones and for their members.
    """

    def shared(rows: DataFrame) -> DataFrame:
        common = rows.groupBy("o").agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first < last")
        return rows.join(common.select("o"), "o").select("o", "c")

    frequent = F.expr("shiftrightunsigned(o, 60) > 0")
    partitions = int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    company = shared(regions.where(~frequent).repartition(partitions, "o")).unionByName(shared(regions.where(frequent)))
    # A set that several tasks have met counts more than once, which keeps too many, never too few.
    met = company.groupBy("c").agg(F.count(F.lit(1)).alias("met"))
    # The least size of a linked set decides how many are needed.
    needed = F.floor(F.ceil(F.col("n") * SHARE[0] / SHARE[1]) / 16) + 1
    return met.join(classes, "c").where(F.col("met") >= needed).select(*classes.columns)


def _count_levels(sets: DataFrame) -> np.ndarray:
    """For each place of the count table the highest level of its shingles: 0 where each is in one
    set, then the power of two of the sets that have it. At most 2**LEVEL_BITS rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                values = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(0).slice(k, 512)]
                h, count = np.unique(np.concatenate(values), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(count)], names=["h", "n"])

    counted = sets.select("members").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    place = F.shiftrightunsigned("h", 64 - LEVEL_BITS).cast("int")
    level = F.least(F.floor(F.log2("n")), F.lit(15)).cast("int")
    found = counted.select(place.alias("place"), level.alias("level")).groupBy("place").agg(F.max("level").alias("level")).toArrow()
    out = np.zeros(1 << LEVEL_BITS, np.uint8)
    out[found["place"].to_numpy()] = found["level"].to_numpy()
    return out


def _second_regions(sets: DataFrame, levels: np.ndarray) -> DataFrame:
    """Rows (``o``, ``c``, ``n``, ``w``, ``s``): the regions of each set, rare shingles first, but those of no
    other set. ``w`` is the mean level of the set's shingles, the highest where copies were made from
    it; ``s`` counts the shingles that other sets may have, so no intersection is larger."""
    shared = sets.sparkSession.sparkContext.broadcast(levels.tobytes())  # 2**LEVEL_BITS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            out, count, sizes, common, held = [], [], [], [], []
            for value in batch.column(1):
                members = np.frombuffer(value.as_buffer(), np.uint64)
                n = len(members)
                own = level[(members >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)].astype(np.uint64)
                order = np.sort((own << np.uint64(60)) | (members >> np.uint64(4)))[: _regions_of(n)]
                order = order[order >= np.uint64(1 << 60)]
                out.append(order)
                count.append(len(order))
                sizes.append(n)
                common.append(own.mean())
                held.append(int((own > 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), count)),
                    pa.array(np.repeat(sizes, count).astype(np.int32)), pa.array(np.repeat(common, count).astype(np.float32)),
                    pa.array(np.repeat(held, count).astype(np.int32)),
                ],
                names=["o", "c", "n", "w", "s"],
            )

    return sets.select("c", "members").mapInArrow(run, "o long, c long, n int, w float, s int")


def _bit(key, id_hash):
    return (key ^ id_hash) & ((1 << NEEDED_BITS) - 1)


def _needed(near: DataFrame, docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """The sets (``c``, ``members``) of ``near`` (``c``, ``id``), read from the document with that id; by chance
    of a few more, and of repeated documents repeatedly."""
    found = near.select(
        F.col("c").bitwiseXOR(F.xxhash64("id")).bitwiseAND((1 << NEEDED_BITS) - 1).cast("int").alias("bit")
    )
    found = found.distinct().toArrow()  # at most 2**NEEDED_BITS rows
    bits = np.zeros(1 << NEEDED_BITS, bool)
    bits[found.column(0).to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = np.unpackbits(np.frombuffer(shared.value, np.uint8)), set()
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(1))
            keys, sets = [], []
            for id_hash, members in zip(batch.column(0).to_pylist(), shingle_sets(data, offsets, shingle), strict=True):
                if len(members) and (key := set_key(members)) not in seen and wanted[_bit(key, id_hash)]:
                    seen.add(key)
                    keys.append(key)
                    sets.append(members.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["c", "members"])

    return docs.select(F.xxhash64(id_col).alias("h"), text_col).mapInArrow(run, "c long, members binary")


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``p``, ``c``) with the sizes of intersection and union."""
    joined = pairs.join(sets.select(F.col("c").alias("p"), F.col("members").alias("a")), "p").join(
        sets.select("c", F.col("members").alias("b")), "c"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, all_ = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                both.append(common)
                all_.append(len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(all_, pa.int64())], names=["p", "c", "both", "all"]
            )

    near = joined.select("p", "c", "a", "b").mapInArrow(run, "p long, c long, both long, `all` long")
    return near.dropDuplicates(["p", "c"])


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` (``c``, ``label``) with ``label`` replaced by the least one reachable over ``edges``
    (``p``, ``c``), for the nodes on edges: every round hooks each node and all its neighbours to the
    least node among them, until nothing changes."""
    both = stored(edges.select("p", "c").unionByName(edges.select(F.col("c").alias("p"), F.col("p").alias("c"))).distinct(), "join-edges")
    if both.isEmpty():
        return labels.where("false")
    nodes = both.select(F.col("p").alias("c")).distinct()
    state = stored(labels.join(nodes, "c"), "join-labels")
    while True:
        near = both.join(state, "c").groupBy("p").agg(F.min("label").alias("near"))
        stepped = state.join(near.withColumnRenamed("p", "c"), "c").select("c", "label", F.least("label", "near").alias("least"))
        # A node also takes what the nodes of its old label found.
        jump = stepped.groupBy("label").agg(F.min("least").alias("best"))
        lower = F.least("least", "best")
        jumped = stepped.join(jump.withColumnRenamed("label", "old"), F.col("label").eqNullSafe(F.col("old")))
        changed = lower.isNotNull() & (F.col("label").isNull() | (lower < F.col("label")))
        moved = stored(jumped.select("c", lower.alias("label"), changed.alias("moved")), "join-labels")
        state = moved.select("c", "label")
        if moved.where("moved").isEmpty():
            return state


def grouped(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``scanned`` rows (id, ``n``, ``c``: the key of the set, null if empty) of all documents, and for the
    sets that are linked with others the least key of their component (``c``, ``label``)."""
    whole = stored(_scan(docs, shingle, id_col, text_col), "join-scan")
    scanned = whole.where("sketch is null").select(id_col, "n", "c")
    levels = _levels(_sum_sketches(whole.where("sketch is not null").select("sketch")))
    regions = stored(_regions(docs, levels, shingle, text_col), "join-regions")
    classes = scanned.where("c is not null").groupBy("c").agg(F.first("n").alias("n"), F.min(id_col).alias("id"))
    near = stored(_in_company(regions, classes), "join-near")
    discard(regions)
    sets = stored(_needed(near, docs, shingle, id_col, text_col), "join-sets")
    members = stored(_second_regions(sets, _count_levels(sets)).dropDuplicates(["o", "c"]), "join-members")
    return scanned, _groups(members, sets)


def _groups(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Components (``c``, ``label``) of all linked sets of ``members`` (``o``, ``c``, ``n``, ``w``, ``s``)."""

    def close(most: str) -> Column:
        """Sizes bound the share of two sets, and so does what they can have in common at all."""
        return F.expr(
            f"{SHARE[1]} * least(n, pn) >= {SHARE[0]} * greatest(n, pn) and {SHARE[1]} * {most} >= {SHARE[0]} * (n + pn - {most})"
        )

    is_link = f"{SHARE[1]} * both >= {SHARE[0]} * `all`"
    placed = _with_pivots(members)
    near = stored(_distances(placed.where(close("least(s, ps)")).select("p", "c").distinct(), sets), "join-distances")
    found = near.where(is_link).select("p", "c")
    distance = near.select("p", "c", (1 - F.col("both") / F.col("all")).alias("d"))
    cells = placed.select("p", "c", "n").dropDuplicates(["p", "c"]).join(distance, ["p", "c"], "left")
    cells = stored(cells, "join-cells")
    discard(members)
    nodes = stored(cells.select("c").unionByName(cells.select(F.col("p").alias("c"))).distinct().withColumn("label", F.col("c")), "join-nodes")
    whole = components(found, nodes)
    left = stored(_unsettled(cells, whole), "join-members")
    if left.isEmpty():
        return whole
    new = stored(_block_links(left, sets), "join-links")
    return whole if new.isEmpty() else components(found.unionByName(new), nodes)


def _unsettled(cells: DataFrame, whole: DataFrame) -> DataFrame:
    """Members (``p``, ``c``, ``n``, ``own``, ``ring``) of cells with more than one component; ``ring`` is null where the
    distance to the pivot was not needed."""
    labelled = cells.join(whole, "c", "left").withColumn("own", F.coalesce("label", "c")).drop("label")
    # The pivot was compared with all that may be linked with it, so two components are needed without it.
    mixed = labelled.groupBy("p").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high").select("p")
    reach = 1 - SHARE[0] / SHARE[1]
    # A little wider than the reach, so that rounding moves no partner two rings away.
    ring = F.floor(F.col("d") / (reach + 1e-6)).cast("int")
    return labelled.join(mixed, "p", "left_semi").select("p", "c", "n", "own", ring.alias("ring"))


def _block_links(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (``p``, ``c``) that connect what is linked among the members of each cell, from pairs of blocks."""
    ring = F.coalesce("ring", F.lit(-1))
    rings = left.groupBy("p", ring.alias("ring")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    blocks = F.ceil(F.greatest(F.col("k") / BLOCK_MEMBERS, F.col("n") / BLOCK_SHINGLES)).cast("int")
    # At most one entry per ring of the unit interval.
    plan = rings.groupBy("p").agg(F.collect_list(F.struct("ring", blocks.alias("blocks"))).alias("rings"))
    placed = left.withColumn("ring", ring).join(plan, "p")
    count = F.filter("rings", lambda r: r["ring"] == F.col("ring"))[0]["blocks"]
    own = F.struct("ring", F.pmod(F.xxhash64("c"), count).cast("int").alias("block"))
    others = F.filter("rings", lambda r: (F.abs(r["ring"] - F.col("ring")) <= 1) | (r["ring"] < 0) | (F.col("ring") < 0))
    every = F.flatten(
        F.transform(others, lambda r: F.transform(F.sequence(F.lit(0), r["blocks"] - 1), lambda k: F.struct(r["ring"].alias("ring"), k.alias("block"))))
    )
    met = placed.select("p", "c", "own", own.alias("mine"), F.explode(every).alias("other"))
    met = met.select("p", "c", "own", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))
    rows = met.join(sets, "c")
    return rows.groupBy("p", "a", "b").applyInArrow(_compare_blocks, "p long, c long").distinct()


def _intersections(members: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs of different sets."""
    count = np.array([len(m) for m in members])
    row = np.repeat(np.arange(len(members)), count)
    _, column, times = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], np.unique(column[order], return_inverse=True)[1]
    both = np.zeros((len(members), len(members)), np.float32)
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        at = slice(*np.searchsorted(column, [k, k + _COLUMNS]))
        part = np.zeros((len(members), _COLUMNS), np.float32)
        part[row[at], column[at] - k] = 1
        both += part @ part.T  # whole numbers below 2**24, so exact
    return both.astype(np.int64)


def _compare_blocks(key: tuple, table: pa.Table) -> pa.Table:
    """Of the linked members of two blocks, each with the least of those it is connected with."""
    c, first = np.unique(table["c"].to_numpy(), return_index=True)  # a set may have been read twice
    own = table["own"].to_numpy()[first]
    pairs = np.zeros((0, 2), np.int64)
    if len(np.unique(own)) > 1:
        blobs = table["members"].combine_chunks()
        members = [np.frombuffer(blobs[int(k)].as_buffer(), np.uint64) for k in first]
        sizes = np.array([len(m) for m in members])
        both = _intersections(members)
        linked = SHARE[1] * both >= SHARE[0] * (sizes[:, None] + sizes[None, :] - both)
        linked |= own[:, None] == own[None, :]
        label, before = np.arange(len(c)), None
        while before is None or (label != before).any():
            before = label
            label = np.where(linked, label[None, :], len(c)).min(axis=1)
            label = label[label]
        moved = np.flatnonzero(label != np.arange(len(c)))
        pairs = np.stack([c[moved], c[label[moved]]], axis=1)
    return pa.table({"p": pa.array(pairs[:, 0], pa.int64()), "c": pa.array(pairs[:, 1], pa.int64())})


def _classes(scanned: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """For each set (``c``) the least id of its component, ``label``."""
    least = scanned.where("c is not null").groupBy("c").agg(F.min(id_col).alias("least"))
    placed = stored(least.join(groups, "c", "left").select("c", "least", F.coalesce("label", "c").alias("group")), "join-placed")
    # Stored, so that a component of very many sets can be split in the join.
    best = stored(placed.groupBy("group").agg(F.min("least").alias("label")), "join-best")
    return placed.join(best, "group").select("c", "label")


def join(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``, the least id reachable by links.

    Equal sets are linked. Null and wordless texts have an empty set, are linked with nothing and keep
    their own id. Ids may be null (a null id is never the least) or repeat. Other columns are not read.
    """
    scanned, groups = grouped(docs, shingle, id_col, text_col)
    labels = stored(_classes(scanned, groups, id_col), "join-labels")
    return scanned.join(labels, "c", "left").select(
        id_col, F.col("n").alias("n_shingles"), F.coalesce("label", id_col).alias("component_id")
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the least id of each component, with all its columns; of rows that repeat it,
    one. Documents without words stay. Ids should differ between different texts; if components
    share a least id, or have none, one document of each distinct set stays."""
    scanned, groups = grouped(docs, shingle, id_col, text_col)
    labels = _classes(scanned, groups, id_col)
    rows = scanned.where("c is not null").join(labels, "c").where(F.col(id_col).eqNullSafe(F.col("label")))
    kept = stored(rows.groupBy("c").agg(F.count(F.lit(1)).alias("copies")), "join-kept")
    text_at, names = docs.columns.index(text_col), docs.columns
    key, least_id, copies = (free_name(docs, n) for n in ("set_key", "least_id", "copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(text_at))
            keys = [set_key(m) if len(m) else None for m in shingle_sets(data, offsets, shingle)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=[*names, key])

    keyed = docs.mapInArrow(run, StructType([*docs.schema.fields]).add(key, LongType()))
    least = labels.join(kept, "c").select(F.col("c").alias(key), F.col("label").alias(least_id), F.col("copies").alias(copies))
    joined = keyed.where(F.col(key).isNotNull()).join(stored(least, "join-least"), key)
    joined = joined.where(F.col(id_col).eqNullSafe(F.col(least_id)))
    single = joined.where(F.col(copies) == 1).select(*names)
    # The same id and set more than once: few rows, of which one stays.
    several = joined.where(F.col(copies) > 1).dropDuplicates([key]).select(*names)
    return keyed.where(F.col(key).isNull()).select(*names).unionByName(single).unionByName(several)
