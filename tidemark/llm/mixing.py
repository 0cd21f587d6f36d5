"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words. Among all document rates that reach it and stay at most
``most``, entropy balancing takes the ones nearest to 1 in relative entropy: rates tilted
exponentially by the document's size, min(most, exp(size * lambda)). Lambda solves the convex dual
of the word constraint; Newton steps, kept inside a bracket, run for all sources at once on the
counts of documents per source and size. The rates are then rounded into whole copies.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import stored

WORD = r"[^\x20\x09-\x0D]+"


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from 0 by code point, null last; sorted by ranges, not in one task."""
    spread = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    row = F.monotonically_increasing_id()
    split = stored(spread.select("*", F.shiftright(row, 33).alias("part"), row.bitwiseAND((1 << 33) - 1).alias("row")), "mix-sources")
    before, at = {}, 0
    for r in split.groupBy("part").count().orderBy("part").collect():  # one row per partition
        before[r["part"]], at = at, at + r["count"]
    if not before:
        return split.select("source", "source_size", F.lit(0).cast("long").alias("place"))
    offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    return split.select("source", "source_size", (F.col("row") + offset[F.col("part")]).alias("place"))


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_size`` and ``target``: ``share`` times all sizes, split by repeating weights in
    order of the sources; a target stops at ``most`` times its size, and the excess is shared anew by
    weight among the others until none is above."""
    ranked = _ranked(sources)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = stored(ranked.select("source", "source_size", weight.alias("weight")), "mix-weights")
    cap = F.col("source_size") * most
    total = weighed.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level, known = 0.0, -1
    while True:
        above = cap < F.col("weight") * level
        row = weighed.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["n"] == known or not row["open"]:
            break
        known, level = row["n"], (share * total - row["stopped"]) / row["open"]
    return weighed.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


def tilts(histogram: DataFrame, goals: DataFrame, most: float, steps: int = 60) -> DataFrame:
    """``source``, ``target``, ``scale`` and ``tilt``: rates are min(most, exp(tilt * size / scale)).

    A source whose target is all it can give has an infinite tilt; one that shall give nothing, or
    has no words, a tilt of minus infinity.
    """
    start = histogram.groupBy("source").agg(
        F.try_divide(F.sum(F.col("size") * F.col("size") * F.col("n")), F.sum(F.col("size") * F.col("n"))).cast("double").alias("scale")
    )
    same = goals["source"].eqNullSafe(start["source"])
    state = goals.join(start, same).select(
        goals["source"], "target", F.coalesce("scale", F.lit(1.0)).alias("scale"),
        F.when(F.col("target") >= most * F.col("source_size"), float("inf")).when(F.col("target") <= 0, float("-inf")).otherwise(0.0).alias("tilt"),
        F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("done"),
    )
    state = stored(state.withColumn("done", F.abs("tilt") == float("inf")), "mix-tilts")
    for _ in range(steps):
        if state.where("not done").isEmpty():
            break
        s = state.alias("s")
        joined = histogram.alias("h").join(s, F.col("h.source").eqNullSafe(F.col("s.source")))
        x = F.col("size") / F.col("scale")
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(math.log(most))))
        sums = joined.groupBy("s.source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("given"),
            F.sum(F.when(F.col("tilt") * x < math.log(most), F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("given") - F.col("target")
        low, high = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")), F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(gap, F.col("slope"))
        middle = (
            F.when((low > -1e6) & (high < 1e6), (low + high) / 2).when(high < 1e6, F.least(high * 2, high - 1)).otherwise(F.greatest(low * 2, low + 1))
        )
        step = F.when((F.col("slope") > 0) & (newton > low) & (newton < high), newton).otherwise(middle)
        close = F.abs(gap) <= F.greatest(F.lit(0.01), F.col("target") * 1e-9)
        moved = s.join(sums.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
            "s.source", "target", "scale",
            F.when(F.col("done") | close, F.col("tilt")).otherwise(step).alias("tilt"),
            low.alias("low"), high.alias("high"), (F.col("done") | close | (high - low < 1e-12)).alias("done"),
        )
        state = stored(moved, "mix-tilts")
    return state.select("source", "target", "scale", "tilt")


def whole_copies(histogram: DataFrame, tilted: DataFrame, most: float) -> DataFrame:
    """``copies`` of all documents of a source and size together: rates times counts, rounded from the
    longest size to the shortest, each handing on what it missed. So a source misses its target by
    about half of its shortest document. A group is the sizes of a source, at most as many rows as
    its longest document has words."""
    kind = histogram.schema["source"].dataType.simpleString()

    def round_down_the_sizes(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False, kind="stable")
        size, n = rows["size"].to_numpy(), rows["n"].to_numpy()
        tilt = float(rows["tilt"].iloc[0])
        if math.isinf(tilt):
            rate = np.full(len(rows), most if tilt > 0 else 0.0)
        else:
            rate = np.exp(np.minimum(tilt * size / float(rows["scale"].iloc[0]), math.log(most)))
        out, missed = np.zeros(len(rows), np.int64), 0.0
        for k in range(len(rows)):
            if size[k]:
                want = n[k] * size[k] * rate[k] + missed
                out[k] = min(max(round(want / size[k]), 0), int(most * n[k]))
                missed = want - float(out[k] * size[k])
        return rows.assign(copies=out)[["source", "size", "n", "copies"]]

    joined = histogram.join(tilted, histogram["source"].eqNullSafe(tilted["source"])).select(histogram["source"], "size", "n", "scale", "tilt")
    return joined.groupBy("source").applyInPandas(round_down_the_sizes, f"source {kind}, size long, n long, copies long")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, ``source``, ``size`` (words), ``source_size``, ``target`` (both of its
    source), ``copies`` (0 to ``most``) and ``taken`` (copies times size).

    Null and empty texts have size 0 and no copies; null is a source like others, the last one. Ids
    may be null or repeat: which documents of equal size and source get a copy more is decided by a
    hash of the id, so reruns agree. An empty table gives an empty result.
    """
    sizes = stored(
        docs.select(
            F.col(id_col), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")
        ),
        "mix-sizes",
    )
    histogram = stored(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = stored(targets(sources, weights, share, float(most)), "mix-targets")
    copies = stored(whole_copies(histogram, tilts(histogram, goals, float(most)), float(most)), "mix-copies")
    # A source and size may hold a third of all documents: they are numbered in buckets by hash.
    buckets = max(1, math.isqrt(histogram.agg(F.sum("n")).first()[0] or 0))
    drawn = F.xxhash64(F.col(id_col), F.lit(11))
    placed = sizes.withColumn("draw", drawn).withColumn("bucket", F.pmod("draw", F.lit(buckets)).cast("int"))
    filled = placed.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    f, c, g = filled.alias("f"), copies.alias("c"), goals.alias("g")
    plan = (
        f.join(c, F.col("f.source").eqNullSafe(F.col("c.source")) & (F.col("f.size") == F.col("c.size")))
        .join(g, F.col("f.source").eqNullSafe(F.col("g.source")))
        .select(
            F.col("f.source").alias("s"), F.col("f.size").alias("z"), F.col("f.bucket").alias("b"), "source_size", "target",
            F.floor(F.col("copies") / F.col("n")).alias("base"), (F.col("copies") % F.col("n") - F.col("before")).alias("more"),
        )
    )
    numbered = placed.withColumn("row", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("draw", id_col)))
    joined = numbered.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bucket") == F.col("b")))
    mixed = joined.select(id_col, "source", "size", "source_size", "target", (F.col("base") + (F.col("row") <= F.col("more")).cast("long")).alias("copies"))
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))
