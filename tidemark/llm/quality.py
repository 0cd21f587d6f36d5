"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (proximal) updates, scored as sparse dot products.

Words are runs of letters and digits, and runs of other visible characters. The features of a text
are its word n-grams of one to ``orders`` words and the shapes of its words, hashed into ``dims``
places, and weighted by the square root of their share of the text, so the length does not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from tidemark.llm import arrays
from tidemark.llm.frames import free_name


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled rows that the model is fitted on; the others are not used."""

    dims: int = 1 << 18
    orders: int = 2
    max_rows: int = 8192
    epochs: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.005
    l2: float = 0.02
    threshold: float = 0.7


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[0x21:0x7F] = True
_SYMBOL &= ~arrays.ALPHANUMERIC
_SYMBOL[0x41:0x5B] = False
_WORD = arrays.ALPHANUMERIC.copy()
_WORD[0x41:0x5B] = True
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[0x41:0x5B] = 1


def features(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of all texts, and the n + 1 offsets of the texts in them. A text without a
    word has none."""
    low = arrays.LOWER[data]
    w0, w1, _ = arrays.words(data, offsets, _WORD)
    s0, s1, _ = arrays.words(data, offsets, _SYMBOL)
    starts, ends = np.concatenate([w0, s0]), np.concatenate([w1, s1])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    word_offsets = np.searchsorted(starts, offsets)
    h = arrays.span_hashes(low, starts, ends)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals = upper[ends] - upper[starts]
    # 0: none, 1: the first alone, 2: some, 3: all; with the length up to 15.
    shape = np.where(capitals == 0, 0, np.where(capitals == ends - starts, 3, np.where(capitals == 1, 1, 2)))
    length = np.minimum(ends - starts, 15)
    shapes = arrays.mix((shape * 16 + length + 1).astype(np.uint64))
    parts = [(h, word_offsets), (shapes, word_offsets)]
    for n in range(2, settings.orders + 1):
        grams, own = arrays.ngram_hashes(h, word_offsets, n)
        parts += [(grams, own), (_repeats(grams, own, n), own)]
    owner = np.concatenate([np.repeat(np.arange(len(offsets) - 1), np.diff(o)) for _, o in parts])
    place = (np.concatenate([x for x, _ in parts]) % np.uint64(settings.dims)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return place[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))])


def _repeats(grams: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """For each n-gram, a feature for how often its text has it: once, twice, up to 4, 8, ... times."""
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))
    _, which, count = np.unique(arrays.chain(grams, owner), return_inverse=True, return_counts=True)
    level = np.ceil(np.log2(np.minimum(count, 64))).astype(np.uint64)
    return arrays.chain(np.full(len(grams), np.uint64(n)), level[which])


def sparse(place: np.ndarray, offsets: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct places of each text, the square roots of their shares, and the n + 1 offsets."""
    n = len(offsets) - 1
    key = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets)) * dims + place
    key, count = np.unique(key, return_counts=True)
    owner = key // dims
    share = count / np.maximum(np.diff(offsets), 1)[owner]
    return key % dims, np.sqrt(share), np.searchsorted(owner, np.arange(n + 1))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class FollowTheLeader:
    """Per-coordinate proximal updates; place ``dims`` is the intercept, which is not shrunk."""

    def __init__(self, settings: Settings):
        self.s = settings
        self.z, self.n = np.zeros(settings.dims + 1), np.zeros(settings.dims + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z, n = self.s, self.z[at], self.n[at]
        free = at == s.dims
        l1, l2 = np.where(free, 0.0, s.l1), np.where(free, 0.0, s.l2)
        w = -(z - np.sign(z) * l1) / ((s.beta + np.sqrt(n)) / s.alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        at, x = np.append(at, self.s.dims), np.append(x, 1.0)
        w = self.weights(at)
        g = (float(_sigmoid(w @ x)) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.s.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(labelled: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weights fitted on ``labelled`` (text, label 0 or 1, order), of ``settings.dims`` + 1 places.

    Rows without a label are ignored. The hashing runs where the texts are; one task then makes the
    updates, on at most ``settings.max_rows`` rows, the first by ``order``. Without rows, all weights
    are 0 and every score is 1/2.
    """
    rows = labelled.where("label is not null").orderBy("order", "label", F.xxhash64("text")).limit(settings.max_rows)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                data, offsets = arrays.utf8(part.column(0))
                at, x, own = sparse(*features(data, offsets, settings), settings.dims)
                pairs = [(at[a:b].astype("<i4").tobytes(), x[a:b].astype("<f4").tobytes()) for a, b in zip(own, own[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary()), part.column(1), part.column(2)],
                    names=["at", "x", "label", "order"],
                )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r["order"], r["label"], r["at"], r["x"]))
        model = FollowTheLeader(settings)
        for _ in range(settings.epochs):
            for r in rows:
                model.learn(np.frombuffer(r["at"], "<i4").astype(np.int64), np.frombuffer(r["x"], "<f4").astype(np.float64), r["label"])
        weights = model.weights(np.arange(settings.dims + 1)).astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary())], names=["weights"])

    vectors = rows.select("text", F.col("label").cast("double").alias("label"), F.col("order").cast("long").alias("order"))
    vectors = vectors.mapInArrow(hashed, "at binary, x binary, label double, `order` long")
    row = vectors.repartition(1).mapInArrow(fitted, "weights binary").first()
    return np.frombuffer(row["weights"], "<f4") if row else np.zeros(settings.dims + 1, np.float32)


def score(
    docs: DataFrame, weights: np.ndarray, settings: Settings = Settings(), text_col: str = "text", score_col: str = "quality_score"
) -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1), a name that they must not have. All columns are kept; a text without
    words, empty or null, gets the score of the intercept alone."""
    if free_name(docs, score_col) != score_col:
        raise ValueError(f"the documents have a column {score_col}; choose another score_col")
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32).tobytes())  # dims x 4 bytes
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(shared.value, np.float32).astype(np.float64)
        for batch in batches:
            data, offsets = arrays.utf8(batch.column(text_at))
            out = np.empty(batch.num_rows)
            for a, b in arrays.pieces(offsets):
                own = offsets[a : b + 1]
                at, x, ends = sparse(*features(data[own[0] : own[-1]], own - own[0], settings), settings.dims)
                sums = np.concatenate([[0.0], np.cumsum(w[at] * x)])
                out[a:b] = _sigmoid(sums[ends[1:]] - sums[ends[:-1]] + w[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, score_col])

    schema = StructType([*docs.schema.fields]).add(score_col, DoubleType())
    return docs.mapInArrow(run, schema)


def labels_by_id(labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """One ``label`` per id; ids that are null, unlabelled or labelled both ways have none."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    both = known.groupBy(id_col).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
    return both.where("label = most").select(id_col, "label")


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The labelled rows to fit on: those ids that are ``usable``, at most ``settings.max_rows`` of
    them, chosen by a hash of the id. Only the chosen ids are joined with the texts."""
    chosen = labels_by_id(labels, id_col=id_col).where(usable)
    chosen = chosen.withColumn("order", F.xxhash64(F.col(id_col))).orderBy("order", id_col).limit(settings.max_rows)
    return docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(F.col(text_col).alias("text"), "label", "order")
