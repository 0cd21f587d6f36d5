"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions. For each of the 255 decision nodes there is a tree of contexts,
the 0 to ``DEPTH`` bytes before. A context's Krichevsky-Trofimov estimate and the product of its
longer contexts are mixed half and half, over all depths, so each context predicts with its own
estimate in proportion to how well it explained the training bytes against its longer contexts. The
weights are those after all training texts; a context never seen leaves the word to the shorter one.
The sum over bits and bytes is the code length of a text.

Counting and scoring run as one exchange. Documents are dealt into blocks; a block sends the distinct
n-grams and words of its texts, with their training counts, to buckets of keys. A bucket holds
whole subtrees, sums what all blocks sent, mixes, and answers each block in the order it asked. So
nothing that grows with the corpus is broadcast or collected, and each n-gram is scored once per
block. There are at least as many buckets as blocks, so a bucket gets about as many keys as a block
sends, however large the corpus is; and as many partitions, so a task sorts about one block or bucket.
Shorter contexts than those that a bucket holds are at most 2**24 n-grams, of three bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays
from tidemark.llm.frames import stored

DEPTH = 5
TOP = 3  # buckets hold whole subtrees of contexts of this many bytes
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 1 << 18  # texts handled at a time; the working arrays have some 50 bytes for each of their bytes
PIECE_GRAMS = 1 << 16  # n-grams taken apart at a time; each has eight decision nodes
END = 0xFF  # stands for the end of a text, and for what is before its start; not in UTF-8
_SLOTS = 21
_LOG_PI = math.log(math.pi)

# Stirling's series with the argument moved up by eight, as numpy has no log-gamma.
def log_gamma(x: np.ndarray) -> np.ndarray:
    moved = np.zeros_like(x)
    for k in range(8):
        moved += np.log(x + k)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - moved


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability of n0 zeros and n1 ones in any one order, under the Krichevsky-Trofimov estimate."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - _LOG_PI


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts and each text's end: the bytes before, the nearest in the highest
    place, and the byte itself in the lowest; and the n + 1 offsets of the texts."""
    n = len(offsets) - 1
    spread = np.full(len(data) + DEPTH * (n + 1), END, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    spread[np.arange(len(data)) + DEPTH * (owner + 1)] = data
    starts = offsets[:-1] + DEPTH * np.arange(1, n + 1)
    lengths = np.diff(offsets) + 1
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)
    gram = spread[at].astype(np.uint64)
    for d in range(1, DEPTH + 1):
        gram |= spread[at - d].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - d))
    return gram, ends


class Counter:
    """Distinct keys of a block with counts. A table of slots finds most keys again without sorting."""

    def __init__(self):
        self.slot = np.full(1 << _SLOTS, -1, np.int32)
        self.keys, self.counts, self.used = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int64), 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (arrays.mix(keys) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def add(self, keys: np.ndarray, weight: np.ndarray) -> None:
        at = self.slot[self._slots(keys)]
        known = (at >= 0) & (self.keys[at] == keys)
        self.counts[: self.used] += np.bincount(at[known], weight[known], self.used).astype(np.int64)
        new, which = np.unique(keys[~known], return_inverse=True)
        if not len(new):
            return
        need = self.used + len(new)
        if need > len(self.keys):
            room = np.zeros(need + need // 2 - self.used, np.uint64)
            self.keys = np.concatenate([self.keys[: self.used], room])
            self.counts = np.concatenate([self.counts[: self.used], room.view(np.int64)])
        self.keys[self.used : need] = new
        self.counts[self.used : need] = np.bincount(which, weight[~known], len(new)).astype(np.int64)
        slots = self._slots(new)
        free = self.slot[slots] < 0
        self.slot[slots[free]] = np.arange(self.used, need)[free]
        self.used = need

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys and their counts."""
        keys, which = np.unique(self.keys[: self.used], return_inverse=True)
        return keys, np.bincount(which, self.counts[: self.used], len(keys)).astype(np.int64)


class Finder:
    """Places of keys in a sorted array that holds them all."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.slot = keys, np.zeros(1 << _SLOTS, np.int32)
        self.slot[(arrays.mix(keys) >> np.uint64(64 - _SLOTS)).astype(np.int64)] = np.arange(len(keys))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot[(arrays.mix(keys) >> np.uint64(64 - _SLOTS)).astype(np.int64)].astype(np.int64)
        wrong = np.flatnonzero(self.keys[at] != keys)
        at[wrong] = np.searchsorted(self.keys, keys[wrong])
        return at


GRAM, WORD = 0, 1


def _bucket(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    part = keys >> np.uint64(8 * (DEPTH + 1 - TOP)) if kind == GRAM else keys
    return (arrays.mix(part) % np.uint64(buckets)).astype(np.int64)


def _texts(column: pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Neighbouring texts of about ``PIECE_BYTES``: their range, lower-cased bytes and offsets."""
    data, offsets = arrays.utf8(column)
    for a, b in arrays.pieces(offsets, PIECE_BYTES):
        part = offsets[a : b + 1]
        yield a, b, arrays.LOWER[data[part[0] : part[-1]]], part - part[0]


def _keys(low: np.ndarray, offsets: np.ndarray):
    """(kind, keys, offsets of the texts in them) of some texts."""
    yield GRAM, *byte_grams(low, offsets)
    starts, ends, own = arrays.words(low, offsets, arrays.NOT_BLANK)
    yield WORD, arrays.span_hashes(low, starts, ends), own


def _planes(keys: np.ndarray) -> bytes:
    """Sorted keys byte by byte, the highest bytes of all first: these repeat and are compressed well."""
    return np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(value: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def _dealt(rows: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """The rows of a key in one of so many partitions. Adaptive execution does not put these together again: what a
    task sorts is held in the JVM, beside its Python worker."""
    return rows.repartition(partitions, *keys)


def _ask(dealt: DataFrame, buckets: int) -> DataFrame:
    """Rows (``bucket``, ``kind``, ``block``, ``keys``, ``counts``): what blocks send to buckets. Kind 2 holds
    the training tokens and texts of a block."""

    def run(block: pa.Table) -> pa.Table:
        number = block["block"][0].as_py()
        learn = block["learn"].to_numpy(zero_copy_only=False).astype(np.int64)
        counters = (Counter(), Counter())
        tokens = 0
        for a, b, low, offsets in _texts(block["text"]):
            for kind, keys, own in _keys(low, offsets):
                counters[kind].add(keys, np.repeat(learn[a:b], np.diff(own)))
                tokens += int((np.diff(own) * learn[a:b]).sum()) if kind == WORD else 0
        rows = [(0, 2, number, b"", np.array([tokens + learn.sum(), learn.sum()], np.int64).tobytes())]
        for kind in (GRAM, WORD):
            keys, counts = counters[kind].distinct()
            bucket = _bucket(kind, keys, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in range(buckets):
                if cuts[k] < cuts[k + 1]:
                    own = order[cuts[k] : cuts[k + 1]]
                    rows.append((k, kind, number, _planes(keys[own]), counts[own].astype("<u4").tobytes()))
        columns = list(zip(*rows, strict=True))
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("bucket", "kind", "block", "keys", "counts"), columns, types, strict=True)})

    return _dealt(dealt, buckets, "block").groupBy("block").applyInArrow(run, "bucket int, kind int, block int, keys binary, counts binary")


def _asked(rows: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray]:
    """The blocks, what each asked for, and the distinct keys of all with their training counts."""
    keys = [_from_planes(v.as_py()) for v in rows["keys"]]
    counts = np.concatenate([np.frombuffer(v.as_py(), "<u4") for v in rows["counts"]]).astype(np.int64)
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    return rows["block"].to_pylist(), keys, distinct, np.bincount(which, counts, len(distinct)).astype(np.int64)


def _path(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decision nodes of each byte (1 to 255) and the bits taken there."""
    steps = np.arange(7, -1, -1)
    s = symbol.astype(np.int64)[:, None]
    return (s | 256) >> (steps + 1), (s >> steps) & 1


def _leaves(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decision nodes at full depth (context bytes, then node) with their zeros and ones. The n-grams are sorted,
    so those of a context stand together."""
    edges = np.flatnonzero(np.diff(grams >> np.uint64(8))) + 1
    offsets = np.concatenate([[0], edges, [len(grams)]])
    parts = [_leaves_of(grams[offsets[a] : offsets[b]], counts[offsets[a] : offsets[b]]) for a, b in arrays.pieces(offsets, PIECE_GRAMS)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _leaves_of(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    node, bit = _path(grams & np.uint64(255))
    key = ((grams & ~np.uint64(255))[:, None] | node.astype(np.uint64)).ravel()
    distinct, which = np.unique(key, return_inverse=True)
    count, ones = np.repeat(counts, 8).astype(np.float64), bit.ravel()
    n1 = np.bincount(which, count * ones, len(distinct))
    return distinct, np.bincount(which, count, len(distinct)) - n1, n1


def _parent(key: np.ndarray, depth: int) -> np.ndarray:
    """Nodes with the context cut to ``depth`` bytes."""
    keep = ((1 << 8 * depth) - 1) << 8 * (DEPTH + 1 - depth) if depth else 0
    return key & np.uint64(keep | 255)


class Level:
    """The decision nodes of one depth: the own estimate of a one, and the weight of the own estimate."""

    def __init__(self, key, n0, n1, log_longer=None):
        own = log_kt(n0, n1)
        if log_longer is None:
            self.weight, self.log = np.ones(len(key)), own
        else:
            self.log = np.logaddexp(own, log_longer) - math.log(2)
            self.weight = np.exp(own - math.log(2) - self.log)
        self.key, self.n0, self.n1 = key, n0, n1
        self.one = (n1 + 0.5) / (n0 + n1 + 1)

    def sums(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        key, which = np.unique(_parent(self.key, depth), return_inverse=True)
        return key, *(np.bincount(which, x, len(key)) for x in (self.n0, self.n1, self.log))

    def shorter(self, depth: int) -> Level:
        return Level(*self.sums(depth))


def _levels(grams: np.ndarray, counts: np.ndarray) -> dict[int, Level]:
    """The depths that a bucket holds."""
    learned = counts > 0
    out = {DEPTH: Level(*_leaves(grams[learned], counts[learned]))}
    for d in range(DEPTH - 1, TOP - 1, -1):
        out[d] = out[d + 1].shorter(d)
    return out


def _log10_probability(grams: np.ndarray, levels: dict[int, Level]) -> np.ndarray:
    """Mixed over all depths, from the longest context to none."""
    out = np.zeros(len(grams))
    for a in range(0, len(grams), PIECE_GRAMS):
        out[a : a + PIECE_GRAMS] = _log10_probability_of(grams[a : a + PIECE_GRAMS], levels)
    return out


def _log10_probability_of(grams: np.ndarray, levels: dict[int, Level]) -> np.ndarray:
    node, bit = _path(grams & np.uint64(255))
    full = ((grams & ~np.uint64(255))[:, None] | node.astype(np.uint64)).ravel()
    one, seen = np.full(len(full), 0.5), np.zeros(len(full), bool)
    for d in range(DEPTH, -1, -1):
        level = levels[d]
        if not len(level.key):
            continue
        key = _parent(full, d)
        at = np.minimum(np.searchsorted(level.key, key), len(level.key) - 1)
        here = level.key[at] == key
        own, weight = level.one[at], level.weight[at]
        mixed = weight * own + (1 - weight) * np.where(seen, one, own)
        one, seen = np.where(here, mixed, one), seen | here
    bit = bit.ravel()
    return np.log10(np.where(bit == 1, one, 1 - one)).reshape(-1, 8).sum(axis=1)


def _subtree_roots(asked: DataFrame, buckets: int) -> DataFrame:
    """Per node of ``TOP`` - 1 context bytes: zeros, ones, and the log probability of its longer contexts."""

    def run(rows: pa.Table) -> pa.Table:
        _, _, keys, counts = _asked(rows)
        key, n0, n1, log = _levels(keys, counts)[TOP].sums(TOP - 1)
        return pa.table({"node": pa.array(key.view(np.int64)), "n0": pa.array(n0, pa.float64()), "n1": pa.array(n1, pa.float64()), "log": pa.array(log, pa.float64())})

    grams = _dealt(asked.where(f"kind = {GRAM}").select("bucket", "block", "keys", "counts"), buckets, "bucket")
    roots = grams.groupBy("bucket").applyInArrow(run, "node long, n0 double, n1 double, log double")
    return roots.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "log")])


def _answers(asked: DataFrame, top: bytes, buckets: int) -> DataFrame:
    """Rows (``block``, ``kind``, ``bucket``, ``values``): the log10 probabilities of the n-grams, or the
    training counts of the words, in the order in which the block asked; and the buckets' word counts."""
    shared = asked.sparkSession.sparkContext.broadcast(top)

    def run(rows: pa.Table) -> pa.Table:
        kind, bucket = rows["kind"][0].as_py(), rows["bucket"][0].as_py()
        blocks, wanted, keys, counts = _asked(rows)
        if kind == GRAM:
            levels = _levels(keys, counts)
            roots = np.frombuffer(shared.value, "<f8").reshape(4, -1)
            levels[TOP - 1] = Level(np.ascontiguousarray(roots[0]).view(np.uint64), *roots[1:])
            for d in range(TOP - 2, -1, -1):
                levels[d] = levels[d + 1].shorter(d)
            value, known = _log10_probability(keys, levels), 0
        else:
            value, known = counts.astype(np.float64), int((counts > 0).sum())
        values = [value[np.searchsorted(keys, w)].astype("<f4" if kind == GRAM else "<f8").tobytes() for w in wanted]
        n = len(blocks)
        return pa.table({
            "block": pa.array(blocks, pa.int32()), "kind": pa.array([kind] * n, pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()),
            "values": pa.array(values, pa.binary()), "known": pa.array([known] + [0] * (n - 1), pa.int64()),
        })

    return _dealt(asked.where(f"kind < {WORD + 1}"), buckets, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(
        run, "block int, kind int, bucket int, values binary, known long"
    )


def dealing(size: int, partitions: int) -> tuple[int, int]:
    """How many blocks and buckets there are for texts of ``size`` bytes: their number grows with the texts,
    so that the memory of a task does not."""
    blocks = max(1, -(-size // BLOCK_BYTES))
    return blocks, max(blocks, partitions)


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``learned`` (whether the model learned from it), ``n_tokens`` (words and
    one end), ``n_known`` (those seen in training), ``train_tokens``, ``base_score`` (log10 probability
    under smoothed word counts), ``score`` (log10 probability of the text's bytes and its end).

    Texts are lower-cased (A-Z). Null and empty texts have the end alone. Ids may be null or repeat;
    rows are never merged. Without training texts every bit has probability 1/2. ``learn`` is a
    condition on ``docs``; other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = dealing(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64(id_col, "text"), F.lit(blocks)).cast("int"))
    asked = stored(_ask(dealt, buckets), "tree-asked")
    totals = np.zeros(2, np.int64)
    for row in asked.where("kind = 2").select("counts").collect():  # two numbers a block
        totals += np.frombuffer(row["counts"], np.int64)
    roots = _subtree_roots(asked, buckets).orderBy("node").toArrow()  # at most 2**24 nodes of fixed width
    top = np.concatenate([roots["node"].to_numpy().astype(np.int64).view("<f8"), *(roots[c].to_numpy() for c in ("n0", "n1", "log"))])
    answers = stored(_answers(asked, top.astype("<f8").tobytes(), buckets), "tree-answers")
    train_tokens, ends = int(totals[0]), int(totals[1])
    vocabulary = (answers.agg(F.sum("known")).first()[0] or 0) + (ends > 0)
    floor = math.log10(train_tokens + vocabulary + 1)
    kind_of_id = docs.schema[id_col].dataType.simpleString()

    def run(block: pa.Table, values: pa.Table) -> pa.Table:
        got = {(k, b): v for k, b, v in zip(values["kind"].to_pylist(), values["bucket"].to_pylist(), values["values"], strict=True)}
        n = block.num_rows
        counters = (Counter(), Counter())
        for _, _, low, offsets in _texts(block["text"]):
            for kind, keys, _ in _keys(low, offsets):
                counters[kind].add(keys, np.zeros(len(keys), np.int64))
        find, value = [], []
        for kind in (GRAM, WORD):
            keys, _ = counters[kind].distinct()
            bucket, answer = _bucket(kind, keys, buckets), np.zeros(len(keys))
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in range(buckets):
                if cuts[k] < cuts[k + 1]:
                    answer[order[cuts[k] : cuts[k + 1]]] = np.frombuffer(got[kind, k].as_buffer(), "<f4" if kind == GRAM else "<f8")
            find.append(Finder(keys) if len(keys) else None)
            value.append(answer)
        del counters, got, values
        tokens, known, base, total = np.ones(n, np.int64), np.full(n, int(ends > 0)), np.full(n, math.log10(ends + 1) - floor), np.zeros(n)
        for a, b, low, offsets in _texts(block["text"]):
            for kind, keys, own in _keys(low, offsets):
                at = find[kind](keys) if len(keys) else np.zeros(0, np.int64)
                v = value[kind][at] if len(keys) else np.zeros(0)
                add = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[own])  # noqa: E731, B023
                if kind == GRAM:
                    total[a:b] = add(v)
                else:
                    tokens[a:b] += np.diff(own)
                    known[a:b] += add(v > 0).round().astype(np.int64)
                    base[a:b] += add(np.log10(v + 1) - floor)
        return pa.table({
            id_col: block[id_col], "learned": block["learn"], "n_tokens": pa.array(tokens), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(n, train_tokens)), "base_score": pa.array(base), "score": pa.array(total),
        })

    schema = f"`{id_col}` {kind_of_id}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts_of, answers_of = (_dealt(side, buckets, "block").groupBy("block") for side in (dealt, answers))
    return texts_of.cogroup(answers_of).applyInArrow(run, schema)
