"""Benchmark decontamination by winnowing.

Every window of ``window`` consecutive words of a test item that also stands in a document shares
the least k-gram hash of its k-grams, and both sides keep the least hash of each such span. So the
documents keep few fingerprints, and only where one is also a fingerprint of an item are the windows
around it compared with the items' windows: no shared span of ``window`` words is missed. An item
with fewer words is one window of its own length, with its own k and span.

The test side can be any size: a bitmap of fixed size thins out the documents' fingerprints, and the
comparison itself is an equi-join of window hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays
from tidemark.llm.frames import free_name, stored

WINDOW, GRAM = 13, 5
BITMAP_BITS = 22


def _item_words(batch_text) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts and the n + 1 offsets of the texts in them."""
    data, offsets = arrays.utf8(batch_text)
    low = arrays.LOWER[data]
    starts, ends, own = arrays.words(low, offsets, arrays.ALPHANUMERIC)
    return arrays.span_hashes(low, starts, ends), own


def winnow(h: np.ndarray, own: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Selected k-grams of spans of ``window`` words: their hashes, first words and text numbers."""
    k = min(GRAM, window)
    span = window - k + 1
    grams, offsets = arrays.ngram_hashes(h, own, k)
    owner = np.repeat(np.arange(len(own) - 1), np.diff(offsets))
    if len(grams) < span:
        return grams[:0], owner[:0], owner[:0]
    least = np.lib.stride_tricks.sliding_window_view(grams, span).min(axis=1)
    least[owner[: len(least)] != owner[span - 1 :]] = 0  # spans over two texts
    around = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    kept = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(around, span).max(axis=1) == grams)
    return grams[kept], own[owner[kept]] + kept - offsets[owner[kept]], owner[kept]


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct rows (``n``, ``h``, ``item``, ``is_print``): the items' windows of n words, and their fingerprints,
    without an item."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, own = _item_words(batch.column(1))
            sizes = np.diff(own)
            rows = []
            for n in sorted({min(int(s), window) for s in sizes if s}):
                of = np.flatnonzero((sizes == n) if n < window else (sizes >= window))
                some = np.concatenate([[0], np.cumsum(sizes[of])])
                part = np.concatenate([h[own[i] : own[i + 1]] for i in of])
                full, offsets = arrays.ngram_hashes(part, some, n)
                rows.append((n, full, of[np.repeat(np.arange(len(of)), np.diff(offsets))]))
                rows.append((n, winnow(part, some, n)[0], None))
            for n, hashes, owner in rows:
                ids = batch.column(0).take(pa.array(owner)) if owner is not None else pa.nulls(len(hashes), batch.column(0).type)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hashes), n, np.int32)), pa.array(hashes.view(np.int64)), ids, pa.array([owner is None] * len(hashes), pa.bool_())],
                    names=["n", "h", "item", "is_print"],
                )

    known = items.where(F.col(text_col).isNotNull()).select(id_col, text_col)
    return known.mapInArrow(run, f"n int, h long, item {kind}, is_print boolean").distinct()


def _bitmap(rows: DataFrame, bits: int) -> bytes:
    """The low ``bits`` bits of ``h`` that occur; at most 2**bits rows reach the driver."""
    found = rows.select((F.col("h").bitwiseAND((1 << bits) - 1)).cast("int").alias("bit")).distinct().toArrow()
    out = np.zeros(1 << bits, bool)
    out[found.column(0).to_numpy()] = True
    return np.packbits(out).tobytes()


def _in_bitmap(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    low = (h & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bitmap[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1 == 1


def text_key(text_col: str) -> Column:
    """Names a text; equal texts share their hits."""
    return F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_key")


def _scan(docs: DataFrame, lengths: list[int], prints: bytes, windows: bytes, bits: int, id_col: str, text_col: str) -> DataFrame:
    """Per document its word count, the hash of its text, and the windows that may be an item's."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((prints, windows))  # 2 x 2**bits / 8 bytes
    span = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int32()), ("h", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_prints, of_windows = (np.frombuffer(b, np.uint8) for b in shared.value)
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(1))
            count = np.empty(batch.num_rows, np.int64)
            maybe: list = [[] for _ in range(batch.num_rows)]
            for a, b in arrays.pieces(offsets):
                part = offsets[a : b + 1]
                low = arrays.LOWER[data[part[0] : part[-1]]]
                starts, ends, own = arrays.words(low, part - part[0], arrays.ALPHANUMERIC)
                h = arrays.span_hashes(low, starts, ends)
                count[a:b] = np.diff(own)
                for n in lengths:
                    value, first, owner = winnow(h, own, n)
                    hit = _in_bitmap(of_prints, value, bits)
                    first, owner = first[hit], owner[hit]
                    # All windows of n words around the fingerprints, inside their texts.
                    around = first[:, None] - np.arange(n - min(GRAM, n) + 1)
                    inside = (around >= own[owner][:, None]) & (around + n <= own[owner + 1][:, None])
                    begin = np.unique(around[inside])
                    if not len(begin):
                        continue
                    full = np.full(len(begin), np.uint64(n))
                    for k in range(n):
                        full = arrays.chain(full, h[begin + k])
                    good = _in_bitmap(of_windows, full, bits)
                    begin, full = begin[good], full[good]
                    text = np.searchsorted(own, begin, "right") - 1
                    for t, s, x in zip(text.tolist(), (begin - own[text]).tolist(), full.view(np.int64).tolist(), strict=True):
                        maybe[a + t].append({"start": s, "n": n, "h": x})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count), batch.column(2), pa.array(maybe, span)],
                names=[id_col, "n_words", "text_key", "maybe"],
            )

    schema = f"`{id_col}` {kind}, n_words long, text_key string, maybe array<struct<start:long,n:int,h:long>>"
    return docs.select(id_col, text_col, text_key(text_col)).mapInArrow(run, schema)


def _hits(
    docs: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str, item_id_col: str, item_text_col: str, bits: int
) -> tuple[DataFrame, DataFrame]:
    """The scanned documents (id, ``n_words``, ``text_key``), and per text with hits these."""
    test = stored(item_windows(items, window, item_id_col, item_text_col), "test-windows")
    lengths = sorted(r["n"] for r in test.select("n").distinct().collect())  # at most ``window``
    prints = _bitmap(test.where("is_print"), bits)
    windows = _bitmap(test.where("not is_print"), bits)
    scanned = stored(_scan(docs, lengths, prints, windows, bits, id_col, text_col), "doc-windows")
    maybe = scanned.where("size(maybe) > 0").select("text_key", F.explode("maybe").alias("m"))
    maybe = maybe.select("text_key", "m.start", "m.n", "m.h").distinct()  # copies of a text count once
    hits = maybe.join(test.where("not is_print"), ["n", "h"])
    by_text = hits.groupBy("text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(acc["end"], s["start"]))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    # Stored, so that a text with many copies can be split in the join below.
    return scanned, stored(by_text.select("text_key", "spans", "items", covered.alias("n_hit")), "text-hits")


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    bits: int = BITMAP_BITS,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit`` (words inside an occurring window), ``items``
    (ids of the items with occurring windows, sorted as text) and ``spans`` (start and number of words
    of each occurrence).

    Null and empty texts have no words and no hits; an item without words takes no part; the windows of an item
    without id count for the hits, but it cannot be listed; items that share an id count once. Document ids may be null or repeat. Other columns are
    not read.
    """
    scanned, found = _hits(docs, items, window, id_col, text_col, item_id_col, item_text_col, bits)
    return scanned.select(id_col, "n_words", "text_key").join(found, "text_key", "left").select(
        id_col,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,n:int>>")).alias("spans"),
    )


def is_contaminated(n_hit="n_hit", n_words="n_words"):
    """At least one word in twenty stands in a window of a test item."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated texts; all columns are kept."""
    scanned, found = _hits(docs, items, window, id_col, text_col, "item_id", "text", BITMAP_BITS)
    bad = scanned.join(found, "text_key").where(is_contaminated()).select("text_key").distinct()
    key = free_name(docs, "text_key")
    bad = stored(bad.withColumnRenamed("text_key", key), "contaminated-texts")
    return docs.withColumn(key, text_key(text_col)).join(bad, key, "left_anti").select(*docs.columns)
