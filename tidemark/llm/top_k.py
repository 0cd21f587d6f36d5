"""Exact top-k inner products over an impact-ordered index, scored a segment at a time.

Vectors are turned into whole numbers. A block of them is indexed by posting segments: per
dimension, the vectors in order of their value, cut where the quantised value changes. For a query,
each segment has a quantised impact, the most that its vectors gain there above the block's least
gain in that dimension. Segments are processed by descending impact into lower and upper bounds of
the scores; what is open is at most the impact of the next segment for each open dimension. Once the
k-th best lower bound proves that all but a few vectors are out, a query stops, and what is possible is
scored exactly. Queries of a block advance together, some segments of each at a time, as one product of
their gains with the matrix of segments and vectors.

Blocks of vectors and blocks of queries meet in a grid of equal, bounded tasks; each returns its k
best per query, and these are ranked.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = 8
BLOCK, QUERY_BLOCK = 8192, 1024
# Queries that advance together, and the shares of the segments after which bounds are compared.
_TOGETHER, _STEPS = 128, (0.25, 0.5, 1.0)
# Whole numbers are exact in products of doubles below this, and fit a long below the other.
_DOUBLE_EXACT, _LONG = 2**53, 2**63


class ImpactIndex:
    """Posting segments of a block: for each dimension and quantised value, the vectors that have it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: int = LEVELS):
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id
        self.ids, self.vectors = ids[order], vectors[order]
        n, dims = self.vectors.shape
        dim, low, high, posting = [], [], [], []
        for d in range(dims):
            by_value = np.argsort(self.vectors[:, d], kind="stable")
            values = self.vectors[by_value, d]
            step = max(1, -(-(int(values[-1]) - int(values[0]) + 1) // levels))
            level = (values.astype(np.float64) - float(values[0])) // step
            cuts = np.flatnonzero(np.diff(level)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True):
                dim.append(d)
                low.append(values[a])
                high.append(values[b - 1])
                posting.append(by_value[a:b])
        self.dim, self.low, self.high, self.posting = np.array(dim), np.array(low), np.array(high), posting
        self.least, self.most = self.vectors.min(axis=0), self.vectors.max(axis=0)
        self.largest = max(abs(int(self.least.min())), abs(int(self.most.max())))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and scores of the k best, by score and then smaller id; its own id takes no part."""
        dims = self.vectors.shape[1]
        # No score, no bound and no sum of the two is larger.
        if 4 * dims * self.largest * max(1, int(np.abs(queries).max())) >= _DOUBLE_EXACT:
            return [self._search_large(i, q, k) for i, q in zip(query_ids.tolist(), queries, strict=True)]
        segments = np.zeros((len(self.posting), len(self.ids)))
        for s, at in enumerate(self.posting):
            segments[s, at] = 1
        exact, found = self.vectors.astype(np.float64), []
        for a in range(0, len(queries), _TOGETHER):
            found += self._advance(query_ids[a : a + _TOGETHER], queries[a : a + _TOGETHER].astype(np.float64), k, segments, exact)
        return found

    def _advance(self, query_ids: np.ndarray, queries: np.ndarray, k: int, segments: np.ndarray, exact: np.ndarray) -> list:
        n, count = len(self.ids), len(self.posting)
        base = np.minimum(queries * self.least, queries * self.most)  # least gain of each dimension
        ends = np.stack([queries[:, self.dim] * self.low, queries[:, self.dim] * self.high]) - base[:, self.dim]
        gain, impact = ends.min(axis=0), ends.max(axis=0)
        descending = -np.sort(-impact, axis=1)
        own = self.ids[None, :] == query_ids[:, None]
        possible = ~own
        enough = max(4 * k, n // 64)
        todo = np.flatnonzero(possible.sum(axis=1) > k)
        for share in _STEPS:
            if not len(todo):
                break
            done = int(np.ceil(share * count))
            # Segments of the same impact are processed together; an open one adds at most the next impact.
            last = descending[todo, done - 1][:, None]
            processed = impact[todo] >= last
            rest = np.where(processed, 0, impact[todo]).max(axis=1)[:, None]
            lower = np.where(processed, gain[todo], 0) @ segments
            upper = np.where(processed, impact[todo], rest) @ segments
            bar = np.partition(np.where(own[todo], -1, lower), n - k, axis=1)[:, n - k]
            possible[todo] = (upper >= bar[:, None]) & ~own[todo]
            todo = todo[possible[todo].sum(axis=1) > enough]
        scores = queries @ exact.T
        return [self._best(np.flatnonzero(may), score, k) for may, score in zip(possible, scores.astype(np.int64), strict=True)]

    def _best(self, possible: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = possible[np.lexsort((self.ids[possible], -scores[possible]))[:k]]
        return self.ids[best], scores[best]

    def _search_large(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores beyond the exact range of doubles, in whole numbers of any size."""
        others = np.flatnonzero(self.ids != query_id)
        scores = [sum(x * y for x, y in zip(row, query.tolist(), strict=True)) for row in self.vectors[others].tolist()]
        best = sorted(range(len(others)), key=lambda j: (-scores[j], int(self.ids[others[j]])))[:k]
        if any(not -_LONG <= scores[j] < _LONG for j in best):
            raise OverflowError(f"a score of query {query_id} does not fit a long")
        return self.ids[others[best]], np.array([scores[j] for j in best], np.int64)


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double; an error where that does not fit a long."""

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        too_large = F.raise_error(F.lit("a component does not fit a long")).cast("long")
        return F.when(F.abs(scaled) < float(_LONG), F.floor(scaled).cast("long")).otherwise(too_large)

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """Neither null nor empty, and no component null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False)), F.lit(False))


def _matrix(column: pa.ChunkedArray, dims: int | None = None) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = flat.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(flat), max(int(lengths.max()), dims or 0)), np.int64)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(flat)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For each query row its k best other vectors: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``is_query`` is a condition on ``id_col``. Equal scores rank by smaller id. Rows without id and
    unusable vectors (null, empty, or with a null or non-finite component) take no part; repeated
    rows count once; rows with the query's own id are no candidates. Vectors of different lengths are
    filled up with zeros. Fewer than k candidates give fewer rows. Scores are exact; one among the results that
    does not fit a long is an error. Other columns are not read.
    """
    rows = (
        vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
        .dropDuplicates(["vec_id", "v"])
    )
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).first()
    blocks, query_blocks = max(1, -(-counts["n"] // BLOCK)), max(1, -(-counts["q"] // QUERY_BLOCK))
    place = F.xxhash64("vec_id", F.lit(7))
    indexed = rows.select(
        "vec_id", "v", F.pmod(place, F.lit(blocks)).cast("int").alias("ib"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb")
    )
    queries = rows.where("q").select(
        "vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("ib"), F.pmod(place, F.lit(query_blocks)).cast("int").alias("qb")
    )

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        if block.num_rows and asked.num_rows:
            wanted = _matrix(asked["v"])
            index = ImpactIndex(block["vec_id"].to_numpy(), _matrix(block["v"], wanted.shape[1]))
            wanted = np.pad(wanted, ((0, 0), (0, index.vectors.shape[1] - wanted.shape[1])))
            every = index.search(asked["vec_id"].to_numpy(), wanted, k)
            for query_id, query, (ids, scores) in zip(asked["vec_id"].to_pylist(), wanted, every, strict=True):
                out["query_id"] += [query_id] * len(ids)
                out["query_key"] += [zlib.crc32(query.tobytes().rstrip(b"\0"))] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    found = indexed.groupBy("ib", "qb").cogroup(queries.groupBy("ib", "qb")).applyInArrow(
        search, "query_id long, query_key long, vec_id long, score long"
    )
    ranked = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
