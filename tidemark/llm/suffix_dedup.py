"""Removal of repeated byte strings with a sparse suffix array, built by distributed prefix doubling.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is removed. Ranking all
byte positions would shuffle many times the input, so the array is sparse:

1. *Sampled positions.* Among the hashes of 16 bytes at each position, every window keeps its least
   one. Equal strings of ``length`` bytes so keep the same positions in them, and at least two.
2. *Doubling.* A sampled position's first rank names the bytes up to its successor. Each round pairs
   a position's rank with the one 2**i positions on and ranks the pairs anew. A position leaves when
   its rank is unique, or when the ranked string is ``length`` bytes or longer: if such a string
   repeats, all its bytes go.
3. *Ends.* Up to where the sample can decide, repeats are removed now. The positions that are left lie
   at the ends of repeats: their string holds sampled ranks that all repeat, but is not inside a
   string already removed. They, and those positions of the same sampled ranks that could hold the
   same string, are compared in two steps: blocks of neighbours by the bytes all their strings share,
   then the positions of blocks that agree, by the hash of their whole string.

Matches never cross documents. Equal texts are one text whose every position repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays
from tidemark.llm.frames import batch_bytes, discard, stored

LENGTH = 400
GRAM = 16
FILTER_BITS = 24
# Positions whose strings are compared together before each is compared alone.
BLOCK = 16
# Texts and positions that a task handles at a time; a longer text is a batch of its own.
BATCH_BYTES = "4m"
# Bytes of neighbouring texts that are worked on together, so that short texts do not cost some hundred calls of numpy each.
PIECE_BYTES = 1 << 17


def window_of(length: int) -> int:
    """Hashes per window: two windows, at the start and at the end of a string, share no position."""
    if length < 4 * GRAM:
        raise ValueError(f"strings of fewer than {4 * GRAM} bytes are not supported")
    return (length - GRAM - 32) // 2 if length >= 160 else (length - GRAM) // 2


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def _load(padded: np.ndarray, n: int) -> np.ndarray:
    return np.ndarray((n,), "<u8", padded, strides=(1,))


def sample(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Positions that hold the least hash of some window of their text, and their hashes."""
    width = window_of(length)
    n = len(data) - GRAM + 1
    h = arrays.chain(arrays.mix(_load(data, n)), _load(data[8:], n))
    least = _sliding(h, width, np.minimum)
    # Windows that reach into the next text count for none.
    over = (offsets[1:-1, None] - np.arange(1, width + GRAM - 1)).ravel()
    least[over[(over >= 0) & (over < len(least))]] = 0
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    at = np.flatnonzero(_sliding(around, width, np.maximum) == h)
    return at, h[at]


def _least_in(at: np.ndarray, h: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Per sampled position, the first window of its text in which it is the last position with the least hash; the
    windows up to that of the next position are its own.

    A window belongs to the position that no earlier one in it undercuts and no later one reaches. So these windows
    end behind the nearest earlier position with a smaller hash, and before the nearest later one that is not greater.
    """
    text = np.searchsorted(offsets[1:], at, "right")
    starts, below, base = [], [], -1
    places, hashes = at.tolist(), h.tolist()
    for j, (x, value, first) in enumerate(zip(places, hashes, offsets[text].tolist(), strict=True)):
        if first != base:
            below, base = [], first
        while below and hashes[below[-1]] >= value:
            below.pop()
        starts.append(max(x - width + 1, places[below[-1]] + 1 if below else 0, base))
        below.append(j)
    beyond = offsets[1:] - GRAM + 1 - width + 1
    starts = np.minimum(np.array(starts, np.int64), beyond[text])
    return np.minimum.accumulate(starts[::-1])[::-1]


def doubled(data: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Hashes of the 8, 16, 32, ... bytes at each position, up to ``longest``: every step doubles."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    size, out = 8, {8: arrays.mix(_load(padded, len(data)))}
    while 2 * size <= longest:
        out[2 * size] = arrays.chain(out[size][:-size], out[size][size:])
        size *= 2
    return out


def part_hashes(hashes: dict[int, np.ndarray], start: np.ndarray, length: int) -> np.ndarray:
    """Hash of each part of ``length`` bytes, 8 or more, from the two doubled hashes that cover it."""
    size = min(1 << int(np.log2(length)), max(hashes))
    return arrays.chain(arrays.chain(hashes[size][start], hashes[size][start + length - size]), np.uint64(length))


def _text_key(data: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = arrays.utf8(column)
    for a, b in zip(offsets, offsets[1:], strict=False):
        yield data[a:b]


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([_text_key(t) for t in texts], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                names=[id_col, "key", "n_bytes", "sha"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, key long, n_bytes long, sha string")


def _sampled(docs: DataFrame, length: int, text_col: str) -> DataFrame:
    """Rows (``key``, ``pos``, ``size``, ``rank``): sampled positions but the last of each text, the bytes
    to the next one, and a name of the bytes up to it. A text counts once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(0))
            keys, texts, rows = [], [], []
            for a, b in zip(offsets.tolist(), offsets.tolist()[1:], strict=False):
                if b - a < length or (key := _text_key(data[a:b])) in seen:
                    continue
                seen.add(key)
                keys.append(key)
                texts.append(data[a:b])
            ends = np.cumsum([0, *map(len, texts)])
            for a, b in arrays.pieces(ends, PIECE_BYTES):
                piece, starts = np.concatenate(texts[a:b]), ends[a : b + 1] - ends[a]
                at, _ = sample(piece, starts, length)
                text = np.searchsorted(starts[1:], at, "right")
                own = np.flatnonzero(text[1:] == text[:-1])
                text, first, last = text[own], at[own], at[own + 1]
                rank = arrays.span_hashes(piece, first, last + GRAM).view(np.int64)
                rows.append((np.array(keys[a:b], np.int64)[text], first - starts[text], (last - first).astype(np.int32), rank))
            if rows:
                columns = [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "pos", "size", "rank"])

    return docs.select(text_col).mapInArrow(run, "key long, pos long, size int, rank long")


def _in_two_places(rows: DataFrame, value: str, place: tuple[str, str]) -> DataFrame:
    """The values that stand at two different places. Bounds of plain numbers keep the aggregate hashed."""
    bounds = [f(c).alias(f"{n}{i}") for i, c in enumerate(place) for n, f in (("least", F.min), ("most", F.max))]
    return rows.groupBy(value).agg(*bounds).where("least0 != most0 or least1 != most1").select(value)


def _repeating(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The rows whose rank two different positions have, and the stored tables it reads. The ranks are stored, so
    that Spark can split the rows of a very frequent one."""
    ranks = stored(_in_two_places(rows, "rank", ("key", "pos")), "suffix-ranks")
    return rows.join(ranks, "rank"), [rows, ranks]


def _double(rows: DataFrame, length: int, level: int) -> DataFrame:
    """Positions whose string is still short, paired with the one where it ends."""
    first = rows.where(F.col("size") + GRAM < length).select(
        "key", F.col("pos").alias("start"), F.col("size").alias("half"), F.col("rank").alias("name"), (F.col("pos") + F.col("size")).alias("pos")
    )
    return first.join(rows, ["key", "pos"]).select(
        "key", F.col("start").alias("pos"), (F.col("half") + F.col("size")).alias("size"), F.xxhash64("name", "rank", F.lit(level)).alias("rank")
    )


def _union(spans: np.ndarray, n: int) -> np.ndarray:
    """Which bytes lie in the spans (rows of start and end)."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def _open_positions(data: np.ndarray, offsets: np.ndarray, copied: np.ndarray, blocks: list[np.ndarray], sure: np.ndarray, length: int):
    """Positions whose sampled ranks all repeat, their first sampled position, their text, and whether the string is
    not yet removed. ``blocks[i]`` are the positions that still repeat at doubling i."""
    width = window_of(length)
    at, h = sample(data, offsets, length)
    low, high = offsets[:-1], offsets[1:] - length + 1
    # The first and the last window of a string change only at some positions; between two of these lies a run.
    starts = _least_in(at, h, offsets, width)
    shift = length - GRAM + 1 - width
    text = np.searchsorted(offsets[1:], at, "right")
    cuts = [low, high, np.minimum(starts, high[text]), np.clip(starts - shift, low[text], high[text])]
    cuts = np.unique(np.concatenate(cuts))
    text = np.searchsorted(offsets[1:], cuts[:-1], "right")
    inside = cuts[:-1] < high[text]
    run, text, size = cuts[:-1][inside], text[inside], np.diff(cuts)[inside]
    first = np.searchsorted(starts, run, "right") - 1
    last = np.searchsorted(starts, run + shift, "right") - 1
    level = np.log2(np.maximum(last - first, 1)).astype(np.int64)
    good = np.zeros(len(run), bool)
    for i, block in enumerate(blocks):
        flag = np.zeros(len(at), bool)
        flag[np.searchsorted(at, block)] = True
        own = np.flatnonzero(level == i)
        good[own] = flag[first[own]] & flag[last[own] - (1 << i)]
    size, text = size[good], np.repeat(text[good], size[good])
    p = np.repeat(run[good] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    whole = np.concatenate([[0], np.cumsum(_union(sure, len(data)))])
    return p, np.repeat(at[first[good]], size), text, (whole[p + length] - whole[p] < length) & ~copied[text]


def _cores(hashes: dict[int, np.ndarray], p: np.ndarray, start: np.ndarray, length: int):
    """For positions ``p`` and their first sampled positions: the first of each block, where the block's core begins,
    and the hash of the core.

    A block is up to ``BLOCK`` neighbouring positions, counted from their first sampled position; its core are the
    bytes that the strings of all of them share. Equal strings have equal samples, so they have equal cores.
    """
    block = (start - p) // BLOCK
    at = start - BLOCK * block
    edge = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    at, block = at[edge], block[edge]
    return edge, at, arrays.chain(part_hashes(hashes, at, length - BLOCK + 1), block.astype(np.uint64))


def _pieces(batch: pa.RecordBatch):
    """Neighbouring texts of about ``PIECE_BYTES``: their keys, bytes and offsets, whether they have copies, positions
    that repeat at each doubling (or are found otherwise), and the spans that are removed for sure."""
    data, offsets = arrays.utf8(batch.column(1))
    keys, copied = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
    lists = [(c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()) for c in batch.columns[3:]]
    for a, b in arrays.pieces(offsets, PIECE_BYTES):
        part = offsets[a : b + 1] - offsets[a]
        starts, ends, *blocks = (v[o[a] : o[b]] + np.repeat(part[:-1], np.diff(o[a : b + 1])) for v, o in lists)
        yield keys[a:b], data[offsets[a] : offsets[b]], part, copied[a:b], blocks, np.stack([starts, ends], axis=1)


def _asked(texts: DataFrame, length: int) -> DataFrame:
    """Blocks of open positions that are not removed yet: ``core`` and where it lies (``key``, ``at``), and for
    each of the positions how far it lies before that (``back``) and the hash of its string. Of removed positions
    only the ``core`` is told, once per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = []
            for keys, data, offsets, copied, blocks, sure in _pieces(batch):
                p, start, text, open_ = _open_positions(data, offsets, copied, blocks, sure, length)
                if not len(p):
                    continue
                hashes = doubled(data, length)
                if not open_.all():
                    removed.append(np.unique(_cores(hashes, p[~open_], start[~open_], length)[2]))
                p, start, text = p[open_], start[open_], text[open_]
                if len(p):
                    edge, at, core = _cores(hashes, p, start, length)
                    size, text = np.diff(edge, append=len(p)), text[edge]
                    ends = pa.array(np.append(edge, len(p)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(core.view(np.int64)), pa.array(keys[text]), pa.array(at - offsets[text]),
                            pa.ListArray.from_arrays(ends, pa.array((np.repeat(at, size) - p).astype(np.int8))),
                            pa.ListArray.from_arrays(ends, pa.array(part_hashes(hashes, p, length).view(np.int64))),
                        ],
                        names=["core", "key", "at", "back", "strings"],
                    )
            if removed:
                core = pa.array(np.unique(np.concatenate(removed)).view(np.int64))
                none = [pa.nulls(len(core), t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int8()), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([core, *none], names=["core", "key", "at", "back", "strings"])

    return texts.mapInArrow(run, "core long, key long, at long, back array<byte>, strings array<long>")


def _bitmap(rows: DataFrame, column: str) -> bytes:
    """Bits of the last places of a hash: 2**FILTER_BITS / 8 bytes however many rows there are."""
    bits = rows.select(F.col(column).bitwiseAND((1 << FILTER_BITS) - 1).cast("int").alias("bit")).distinct().toArrow()
    held = np.zeros(1 << FILTER_BITS, bool)
    held[bits.column(0).to_numpy()] = True
    return np.packbits(held).tobytes()


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = (hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
    return (bits[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1 == 1


def _offered(texts: DataFrame, wanted: bytes, length: int) -> DataFrame:
    """Strings (``string``) of removed positions whose core is among the ``wanted`` ones, once per batch."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)  # 2**FILTER_BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            found = []
            some = pc.or_(batch.column(2), pc.greater(pc.list_value_length(batch.column(3)), 0))
            for _, data, offsets, copied, blocks, sure in _pieces(batch.filter(some)):
                p, start, _, open_ = _open_positions(data, offsets, copied, blocks, sure, length)
                p, start = p[~open_], start[~open_]
                if len(p):
                    hashes = doubled(data, length)
                    edge, _, core = _cores(hashes, p, start, length)
                    p = p[np.repeat(_held(bits, core), np.diff(edge, append=len(p)))]
                    found.append(np.unique(part_hashes(hashes, p, length)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], names=["string"])

    return texts.mapInArrow(run, "string long")


def _kept(texts: DataFrame, length: int) -> DataFrame:
    """Per text the removed spans and the hash of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for keys, data, offsets, _, (more,), sure in _pieces(batch):
                gone = _union(np.concatenate([sure, np.stack([more, more + length], axis=1)]), len(data))
                for key, a, b in zip(keys.tolist(), offsets.tolist(), offsets.tolist()[1:], strict=False):
                    own = gone[a:b]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).reshape(-1, 2)
                    out.append({
                        "key": key, "n_removed": int(own.sum()), "spans": [{"start": x, "end": y} for x, y in edges.tolist()],
                        "kept": hashlib.sha256(data[a:b][~own].tobytes()).hexdigest(),
                    })
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_pylist(
                out, pa.schema([("key", pa.int64()), ("n_removed", pa.int64()), ("spans", span), ("kept", pa.string())])
            )

    return texts.mapInArrow(run, "key long, n_removed long, spans array<struct<start:long,end:long>>, kept string")


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``spans`` (removed runs as byte offsets, ends
    exclusive) and ``kept_sha256`` of the bytes that are left.

    Null and empty texts have no bytes. Texts shorter than ``length`` lose nothing. Ids may be null or
    repeat: rows are never merged, and rows with equal texts repeat each other whole. Other columns
    are not read.
    """
    with batch_bytes(docs.sparkSession, BATCH_BYTES):
        return _repeated_spans(docs, length, id_col, text_col)


def _repeated_spans(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    documents = stored(_documents(docs, id_col, text_col), "suffix-documents")
    copies = stored(documents.where(f"n_bytes >= {length}").groupBy("key").count().where("count > 1").select("key"), "suffix-copies")
    # Copies of a text have the same keys, so they do not make each other's ranks repeat.
    rows, spent = _repeating(stored(_sampled(docs, length, text_col), "suffix-rank"))
    rows, levels = rows.dropDuplicates(["key", "pos"]), []
    while True:
        levels.append(stored(rows, "suffix-rank"))
        _discard_all(spent)
        if levels[-1].where(F.col("size") + GRAM < length).isEmpty():
            break
        rows, spent = _repeating(stored(_double(levels[-1], length, len(levels)), "suffix-rank"))
    found = [x.select("key", "pos", "size", F.lit(i).alias("level")) for i, x in enumerate(levels)]
    end = F.col("pos") + F.col("size") + GRAM
    sure = end - F.col("pos") >= length
    by_text = reduce(DataFrame.unionByName, found).groupBy("key").agg(
        F.collect_list(F.when(sure, F.struct("pos", end.alias("end")))).alias("sure"),
        *[F.collect_list(F.when(F.col("level") == i, F.col("pos"))).alias(f"b{i}") for i in range(len(levels))],
    )
    by_text = by_text.withColumns({"sure": F.col("sure.pos"), "sure_end": F.col("sure.end")})
    names = ["sure", "sure_end", *[f"b{i}" for i in range(len(levels))]]
    by_text = stored(by_text.select("key", *names), "suffix-found")
    _discard_all(levels)
    texts = _texts_with(docs, by_text, copies, names, text_col)
    _discard_all([by_text])
    result, spent = _ends(texts, length)
    result = stored(_kept(result, length), "suffix-kept")
    _discard_all([texts, *spent])
    whole = documents.join(copies.withColumn("copied", F.lit(True)), "key", "left").join(result, "key", "left")
    span = "array<struct<start:long,end:long>>"
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return whole.select(
        id_col,
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), everything).otherwise(F.coalesce("spans", F.array().cast(span))).alias("spans"),
        F.when(F.col("copied"), F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def _ends(texts: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """The texts that are no copies, with the open positions (``more``) whose string stands elsewhere too, and the
    tables read for it.

    Blocks of positions whose core stands nowhere else are done with; only strings of the others are compared.
    """
    place = ("key", "at")
    told = stored(_asked(texts, length), "suffix-asked")
    asked = told.where("key is not null")
    removed = told.where("key is null").select("core").distinct()
    known = asked.select("core").distinct().join(removed, "core", "left_semi")
    cores = stored(_in_two_places(asked, "core", place).unionByName(known).distinct(), "suffix-cores")
    strings = F.explode(F.arrays_zip("back", "strings")).alias("s")
    again = asked.join(cores, "core", "left_semi").select("core", "key", "at", strings)
    again = stored(again.select("core", "key", (F.col("at") - F.col("s.back")).alias("at"), F.col("s.strings").alias("string")), "suffix-again")
    _discard_all([told, cores])
    offered = _offered(texts, _bitmap(again, "core"), length)
    elsewhere = stored(_in_two_places(again, "string", place).unionByName(offered).distinct(), "suffix-strings")
    more = again.join(elsewhere, "string", "left_semi").groupBy("key").agg(F.collect_list("at").alias("more"))
    more = stored(more, "suffix-more")
    _discard_all([again, elsewhere])
    none = F.array().cast("array<long>")
    names = ["key", "text", "copied", "sure", "sure_end"]
    return texts.where("not copied").join(more, "key", "left").select(*names, F.coalesce("more", none).alias("more")), [more]


def _discard_all(tables: list[DataFrame]) -> None:
    for t in tables:
        discard(t)


def _texts_with(docs: DataFrame, by_text: DataFrame, copies: DataFrame, names: list[str], text_col: str) -> DataFrame:
    """The texts that hold repeating ranks, once each, with what is known of them."""
    mask = (1 << FILTER_BITS) - 1
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(by_text, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = np.frombuffer(shared.value, np.uint8), set()
        for batch in batches:
            keys, texts = [], []
            for data in _texts(batch.column(0)):
                key = _text_key(data)
                low = key & mask
                if key not in seen and wanted[low >> 3] >> (7 - (low & 7)) & 1:
                    seen.add(key)
                    keys.append(key)
                    texts.append(data.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.binary())], names=["key", "text"])

    once = docs.select(text_col).mapInArrow(run, "key long, text binary").dropDuplicates(["key"])
    marked = by_text.join(copies.withColumn("copied", F.lit(True)), "key", "left")
    joined = once.join(marked, "key").select("key", "text", F.coalesce("copied", F.lit(False)).alias("copied"), *names)
    return stored(joined, "suffix-texts")
