"""Source divergence audit over a K2-tree (quadtree) of the group-term count matrix.

A row of the matrix is a group, one (lang, source); a column is a term that the lang keeps; a cell counts
the term in the group. With smoothing a group gives the term p = 1 + floor(scale * (count + a) / (N + a * V)).
All cells with count zero of a group have the same value, p0, so two groups differ

- by |p0 - p0'| on each column where both are zero, and by |p - p0'| where only one is. This follows from
  each group's own counts, as a sorted list of its distinct values: *zero quadrants cost nothing to visit*;
- by |p - p'| where both are not zero. *Only quadrants that are not zero on both sides are traversed.*

1. *Counts* per (lang, source, term), combined per task before the shuffle.
2. *Top of the tree.* Columns are cut into stripes of about ``STRIPE`` terms, frequent terms apart from rare
   ones, so that whole stripes of a small group are zero; rows into blocks of about ``BLOCK`` groups.
3. *Joint traversal.* For each stripe and pair of row blocks one task holds the cells of both, builds the
   levels of the tree below (a quadrant is set if one of its four children is) and descends with pairs
   of quadrants of the same columns, as long as both are set. A leaf pair yields, for each pair of its
   rows, what the both-sided columns differ from what the zero prices say.
4. *Sum* of prices and corrections per pair of groups.

All numbers are integers, and exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import stored

LEAST_DOCS = 30
SCALE = 1_000_000_000
SMOOTHING = 5
TOP_TERMS = 50
STRIPE = 1024
BLOCK = 32
# Rows and columns of a leaf.
LEAF = (4, 16)
# Counted terms that a task holds before it hands them on, and leaf pairs that are computed at once.
_HELD, _AT_ONCE = 1 << 18, 1 << 12
# ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``: letters and everything above ASCII; only A-Z are lower-cased.
_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """Rows (``lang``, ``source``, ``term``, ``n``, ``docs``): occurrences, and documents with the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, Counter] = {}
        d: dict[tuple, Counter] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in n.items():
                at = list(counts)
                columns = [[lang] * len(at), [source] * len(at), pa.array(at, pa.binary()).cast(pa.string()), list(counts.values())]
                columns.append([d[lang, source][t] for t in at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) if isinstance(c, list) else c for c, k in zip(columns, [pa.string()] * 3 + [pa.int64()] * 2, strict=True)],
                    names=["lang", "source", "term", "n", "docs"],
                )
            n.clear()
            d.clear()

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                words = value.as_buffer().to_pybytes().translate(_TERM).split()
                if words:
                    n.setdefault((lang, source), Counter()).update(words)
                    d.setdefault((lang, source), Counter()).update(set(words))
            if sum(map(len, n.values())) > _HELD:
                yield from handed_on()
        yield from handed_on()

    counted = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    # Dealt by (lang, term), which also serves the totals over sources.
    return counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_cells(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The non-zero cells of the kept columns, with the term's totals in the lang; ``first`` marks one cell a column."""
    column = Window.partitionBy("lang", "term")
    totals = {"lang_n": F.sum("n").over(column), "lang_docs": F.sum("docs").over(column)}
    cells = term_counts(docs).withColumns(totals).where(F.col("lang_docs") >= least_docs)
    first = F.row_number().over(column.orderBy("source")) == 1
    return cells.withColumn("first", first).drop("docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(scale * (count + a) / (total + a * terms)) in exact arithmetic; null without terms."""
    above = (count + SMOOTHING).cast("decimal(28, 0)") * F.lit(SCALE).cast("decimal(10, 0)")
    below = (total + SMOOTHING * terms).cast("decimal(28, 0)")
    return 1 + F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(28, 0)"))).cast("long")


def _groups(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """Every occurring group: ``n_group``, ``nonzero``, the lang's ``n_lang`` and ``terms``, ``zero`` (the value p0 of
    its zero cells, 0 without terms) and its row block of ``blocks``."""
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.count(F.lit(1)).alias("nonzero"))
    whole = cells.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("first").alias("terms"))
    rows = pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("groups"))
    joined = pairs.join(own, ["lang", "source"], "left").join(rows, "lang").join(whole, "lang", "left")
    joined = joined.na.fill(0, ["n_group", "nonzero", "n_lang", "terms"])
    blocks = F.ceil(F.col("groups") / BLOCK).cast("int")
    return joined.select(
        "lang", "source", "n_group", "nonzero", "n_lang", "terms", blocks.alias("blocks"),
        F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block"),
        F.coalesce(share(F.lit(0).cast("long"), F.col("n_group"), F.col("terms")), F.lit(0).cast("long")).alias("zero"),
    )


def _with_partners(rows: DataFrame) -> DataFrame:
    """``rows`` once for every pair (``a`` <= ``b``) of row blocks that theirs is in."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = rows.withColumn("other", other)
    return paired.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")}).drop("other", "blocks")


def _compared(block: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which rows of the sorted ``block`` column are a pair of the task (a, b): of the same block, or one of each."""
    upper = np.triu(np.ones((len(block), len(block)), bool), 1)
    return upper if a == b else upper & (block[:, None] != block[None, :])


def _pair_rows(lang: str, sources: list[str], chosen: np.ndarray, value: np.ndarray) -> pa.Table:
    i, j = np.nonzero(chosen)
    names = pa.array(sources, pa.string())
    return pa.table(
        {"lang": pa.array([lang] * len(i), pa.string()), "x": names.take(pa.array(i)), "y": names.take(pa.array(j)), "value": value[i, j]}
    )


def _rows_of(table: pa.Table, columns: list[str]) -> tuple[dict, np.ndarray, np.ndarray]:
    """The groups of a task ordered by block and source: their columns, and for each table row its group."""
    groups = table.select(["block", "source", *columns]).to_pandas()
    order = groups.drop_duplicates(["block", "source"]).sort_values(["block", "source"], ignore_index=True)
    at = {key: k for k, key in enumerate(zip(order["block"], order["source"], strict=True))}
    row = np.fromiter((at[k] for k in zip(groups["block"], groups["source"], strict=True)), np.int64, len(groups))
    return {"source": order["source"].tolist(), **{c: order[c].to_numpy() for c in columns}}, order["block"].to_numpy(), row


def _zero_prices(key: tuple, table: pa.Table) -> pa.Table:
    """What all pairs of groups would differ by if no column were non-zero on both sides."""
    lang, a, b = key[0].as_py(), key[1].as_py(), key[2].as_py()
    groups, block, row = _rows_of(table, ["zero", "nonzero", "terms"])
    zero, nonzero = groups["zero"], groups["nonzero"]
    value, times = table["p"].to_numpy(), table["times"].to_numpy()
    one_sided = np.zeros((len(block), len(block)), np.int64)
    for k in range(len(block)):
        p, m = value[row == k], times[row == k]
        order = np.argsort(p)
        p, m = p[order], m[order]
        above = np.searchsorted(p, zero, "right")
        n_low, s_low = np.concatenate([[0], np.cumsum(m)]), np.concatenate([[0], np.cumsum(m * p)])
        n, s = n_low[above], s_low[above]
        one_sided[k] = (n * zero - s) + (s_low[-1] - s) - (n_low[-1] - n) * zero
    neither = groups["terms"][:, None] - nonzero[:, None] - nonzero[None, :]
    prices = one_sided + one_sided.T + neither * np.abs(zero[:, None] - zero[None, :])
    return _pair_rows(lang, groups["source"], _compared(block, a, b), prices)


def tree_levels(set_leaves: np.ndarray) -> list[np.ndarray]:
    """Which quadrants of the tree have a non-zero cell: the leaves, padded to a square of a power of two,
    then each level above up to the root."""
    side = 1 << max(int(n - 1).bit_length() for n in (*set_leaves.shape, 1))
    level = np.zeros((side, side), bool)
    level[: set_leaves.shape[0], : set_leaves.shape[1]] = set_leaves
    levels = [level]
    while len(level) > 1:
        level = level[::2, ::2] | level[1::2, ::2] | level[::2, 1::2] | level[1::2, 1::2]
        levels.append(level)
    return levels


def joint_leaves(levels: list[np.ndarray]) -> np.ndarray:
    """Triples (row I, row J, column) of the leaves with I <= J that are both set, found from the root down."""
    pairs = np.zeros((int(levels[-1][0, 0]), 3), np.int64)
    steps = np.array([(i, j, c) for i in (0, 1) for j in (0, 1) for c in (0, 1)], np.int64)
    for level in reversed(levels[:-1]):
        pairs = (2 * pairs[:, None, :] + steps[None]).reshape(-1, 3)
        i, j, c = pairs.T
        pairs = pairs[(i <= j) & level[i, c] & level[j, c]]
    return pairs


def _corrections(key: tuple, table: pa.Table) -> pa.Table:
    """Over one stripe: what the columns that are non-zero on both sides differ by, less their zero prices."""
    lang, a, b = key[0].as_py(), key[2].as_py(), key[3].as_py()
    groups, block, row = _rows_of(table, ["zero"])
    terms = table["term"].combine_chunks().dictionary_encode()
    r, c = LEAF
    # Terms in the order of their frequency, so that what is zero lies together.
    frequency = np.zeros(len(terms.dictionary), np.int64)
    frequency[terms.indices.to_numpy()] = table["lang_docs"].to_numpy()
    place = np.empty(len(frequency), np.int64)
    place[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
    height, width = -(-len(block) // r) * r, -(-len(frequency) // c) * c
    cells = np.zeros((height, width), np.int64)
    cells[row, place[terms.indices.to_numpy()]] = table["p"].to_numpy()
    zero = np.zeros(height, np.int64)
    zero[: len(block)] = groups["zero"]
    tiles = cells.reshape(height // r, r, width // c, c).transpose(0, 2, 1, 3)
    total = np.zeros((height // r, height // r, r, r), np.int64)
    leaves = joint_leaves(tree_levels(tiles.any(axis=(2, 3))))
    for k in range(0, len(leaves), _AT_ONCE):
        i, j, col = leaves[k : k + _AT_ONCE].T
        x, y = tiles[i, col][:, :, None, :], tiles[j, col][:, None, :, :]
        zx, zy = zero.reshape(-1, r)[i][:, :, None, None], zero.reshape(-1, r)[j][:, None, :, None]
        found = np.abs(x - y) - np.abs(x - zy) - np.abs(y - zx) + np.abs(zx - zy)
        np.add.at(total, (i, j), np.where((x > 0) & (y > 0), found, 0).sum(axis=3))
    value = total.transpose(0, 2, 1, 3).reshape(height, height)[: len(block), : len(block)]
    return _pair_rows(lang, groups["source"], _compared(block, a, b) & (value != 0), value)


def _pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (``lang``, ``x``, ``y``, ``value``): the difference of each pair of groups of a lang, once."""
    distinct = cells.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
    facts = groups.select("lang", "source", "block", "blocks", "zero", "nonzero", "terms")
    # A group without terms has one row, of no times.
    counted = facts.join(distinct, ["lang", "source"], "left").na.fill(0, ["p", "times"])
    schema = "lang string, x string, y string, value long"
    prices = _with_partners(counted).groupBy("lang", "a", "b").applyInArrow(_zero_prices, schema)

    level = F.floor(F.log2("lang_docs")).cast("int")
    sizes = cells.where("first").groupBy("lang", level.alias("level")).agg(F.count(F.lit(1)).alias("size"))
    placed = cells.withColumn("level", level).join(sizes.withColumn("stripes", F.ceil(F.col("size") / STRIPE)), ["lang", "level"])
    stripe = 64 * F.pmod(F.xxhash64("term"), F.col("stripes")) + F.col("level")
    leaves = placed.select("lang", "source", "block", "blocks", "term", "p", "zero", "lang_docs", stripe.alias("stripe"))
    corrections = _with_partners(leaves).groupBy("lang", "stripe", "a", "b").applyInArrow(_corrections, schema)
    return prices.unionByName(corrections).groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).cast("int").alias("rank")
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """How the sources of each lang differ: rows (``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``).

    Part ``pair``: every other source of the lang, by the sum of the differences over all kept terms. Part
    ``term``: the ``top_terms`` terms that the source has and uses more than its lang does. Null text, lang
    and source are empty strings; a source without kept terms is smoothed only; a lang without kept
    terms has pairs of value 0. Rows that repeat count as documents. Other columns are not read.
    """
    text, lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source"))
    cells = stored(kept_cells(docs.select(lang, source, text), least_docs), "divergence-cells")
    groups = stored(_groups(docs.select(lang, source).distinct(), cells), "divergence-groups")
    facts = groups.drop("nonzero")
    valued = cells.join(facts, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("n_group"), F.col("terms")))
    valued = stored(valued.select("*", share(F.col("lang_n"), F.col("n_lang"), F.col("terms")).alias("q")), "divergence-values")
    pairs = stored(_pair_values(valued, groups), "divergence-pairs")
    both = pairs.select("lang", F.inline(F.array(
        F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item"))
    )), "value")
    terms = valued.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(both, "pair").unionByName(_ranked(terms, "term").where(F.col("rank") <= top_terms))
