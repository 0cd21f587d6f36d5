import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import token_counts, top_k

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v int")


def search(df, k=5):
    return sorted(tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 50 == 0, k).collect())


def brute(rows, k=5):
    usable = {(i, tuple(v)) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in usable]
    out = []
    for i, q in whole:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in whole if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_matches_brute_force_with_ties_and_bad_rows(spark):
    rng = random.Random(5)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(6)], 0, 1) for i in range(400)]
    rows += [(i, [0.5] * 6, 0, 1) for i in range(400, 430)]  # equal vectors
    rows += [(500, None, 0, 1), (550, [], 0, 1), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0, 1), (650, [math.nan] * 6, 0, 1), (700, [math.inf] * 6, 0, 1)]
    rows += [(None, [1.0] * 6, 0, 1), rows[3], rows[50]]
    assert search(vectors(spark, rows)) == brute(rows)


def test_top_k_of_few_and_of_no_vectors(spark):
    rows = [(0, [1.0, 0.0], 0, 1), (1, [0.5, 0.5], 0, 1)]
    assert search(vectors(spark, rows)) == brute(rows)
    assert search(vectors(spark, [])) == []


def test_scores_are_exact_beyond_the_range_of_doubles(spark):
    rows = [(0, [2.0**19 + 1 / 256, 1 / 256], 0, 1), (1, [2.0**19 + 1 / 256, 1 / 256], 0, 1), (2, [2.0**19 + 1 / 256, 0.0], 0, 1), (50, [1.0, 1.0], 0, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, v int")
    big = 2**27 + 1
    found = [(r["query_id"], r["vec_id"], r["score"]) for r in top_k.top_k(frame, F.col("vec_id") % 50 == 0, 3).collect()]
    assert sorted(found) == sorted(
        [(0, 1, big * big + 1), (0, 2, big * big), (0, 50, 256 * big + 256)]
        + [(50, 0, 256 * big + 256), (50, 1, 256 * big + 256), (50, 2, 256 * big)]
    )


@pytest.mark.parametrize("value", [1e10, 1e17])
def test_scores_and_components_that_fit_no_long_are_refused(spark, value):
    frame = spark.createDataFrame([(0, [value, value]), (1, [value, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        top_k.top_k(frame, F.col("vec_id") % 50 == 0).collect()


def test_a_proof_ends_the_search_before_all_segments(monkeypatch):
    rng = np.random.default_rng(7)
    vectors = np.where(rng.random((4000, 16)) < 0.9, 0, rng.integers(0, 300, (4000, 16)))
    vectors[:20] = rng.integers(200, 300, (20, 16))
    index = top_k.ImpactIndex(np.arange(4000), vectors)
    steps = []
    partition = np.partition
    monkeypatch.setattr(top_k.np, "partition", lambda x, *a, **b: steps.append(len(x)) or partition(x, *a, **b))
    queries = rng.integers(1, 300, (30, 16))
    found = index.search(np.full(30, -1), queries, 5)
    exact = queries @ vectors.T
    for (ids, scores), row in zip(found, exact, strict=True):
        order = np.lexsort((np.arange(4000), -row))[:5]
        assert ids.tolist() == order.tolist() and scores.tolist() == row[order].tolist()
    assert sum(steps) < 30 * len(top_k._STEPS)


def test_blocks_and_queries_split_without_changing_the_result(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)], 0, 1) for i in range(300)]
    whole = search(vectors(spark, rows))
    monkeypatch.setattr(top_k, "BLOCK", 64)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 2)
    assert search(vectors(spark, rows)) == whole == brute(rows)


PIECES = ["a", "b", " ", "  ", "\n", "'", "re", "'re", "'s", "1", "²", "!", "é", "日本", "<|endoftext|>", "the", "don't", "\t", "\x1c", "\x85", ".", "'ll"]


def test_every_prefix_has_the_count_of_the_library(library):
    rng, counter = random.Random(7), token_counts.PrefixCounter(PATH)
    for _ in range(150):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 20)))
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == expected, text
        assert counter.totals([text]) == expected[-1:]


def test_long_pieces_count_as_in_the_library_and_as_short_ones(library, monkeypatch):
    rng, counter = random.Random(11), token_counts.PrefixCounter(PATH)
    long = ["".join(rng.choices("etaoinshr", k=200_000)), "a" * 3000, " " * 1000 + "x", "é" * 700 + "1" * 900]
    assert counter.totals(long) == [len(library.encode(t, add_special_tokens=False).ids) for t in long]
    pieces = [t.encode()[:500] for t in long]
    found = [c.tolist() for c in counter.piece_counts([*pieces, b"short"])]
    monkeypatch.setattr(token_counts, "LONG_PIECE", 10**9)
    assert found == [c.tolist() for c in token_counts.PrefixCounter(PATH).piece_counts([*pieces, b"short"])]


def test_token_counts_of_a_table(spark, docs, library):
    texts = ["Hello there, world", None, "", "same", "same", "x" * 50_000, "word " * 20_000, "<|endoftext|>"]
    found = token_counts.token_counts(docs(texts, ids=[0, 1, None, 3, 3, 5, 6, 7]), PATH)
    expected = [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for t in texts]
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in found.collect()) == sorted(expected)
    assert token_counts.token_counts(docs([]), PATH).count() == 0


def test_prefix_table_answers_budget_questions(docs):
    row = token_counts.prefix_table(docs(["one two three four"]), PATH).first()
    assert row["prefix_tokens"][0] == 0 and len(row["prefix_tokens"]) == 19 and row["prefix_tokens"][-1] == 4
    assert token_counts.prefix_table(docs([None]), PATH).first()["prefix_tokens"] == [0]
