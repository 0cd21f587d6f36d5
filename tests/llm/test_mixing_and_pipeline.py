import random
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemark.llm import arrays, mixing, queries

SF = "/root/testdata/sf0.001"


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, stopped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        open_ = [s for s in order if s not in stopped]
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if most * sizes[s] < weight[s] * level}
        if not above:
            return {s: most * sizes[s] if s in stopped else weight[s] * level for s in order}
        stopped |= above


def test_targets_and_taken_words(docs):
    rng = random.Random(8)
    sources = ["b", "a", "é", "Z", "c", None]
    texts, own = [], []
    for _ in range(600):
        own.append(rng.choices(sources, [30, 4, 3, 2, 1, 1])[0])
        texts.append(rng.choice([None, ""]) if rng.random() < 0.02 else " ".join(["w"] * rng.choice([1, 3, 9, 9, 9, 40, 300])))
    found = mixing.mix(docs(texts, sources=own)).collect()
    sizes, taken, given = {}, {}, {}
    for r in found:
        assert r["size"] == len((texts[r["doc_id"]] or "").split()) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        given[r["source"]] = r["target"]
    wanted = expected_targets(sizes)
    for s in sizes:
        assert given[s] == pytest.approx(wanted[s]) and abs(taken[s] - wanted[s]) <= max(5, 0.01 * wanted[s])
    again = mixing.mix(docs(texts, sources=own).repartition(5)).collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in found}


def test_mixing_without_words_and_without_rows(docs):
    assert mixing.mix(docs([])).count() == 0
    assert [r["taken"] for r in mixing.mix(docs([None, "", " "], sources=["a", None, "b"])).collect()] == [0, 0, 0]
    one = mixing.mix(docs(["a b c"] * 30, ids=[1] * 30)).collect()
    assert sum(r["taken"] for r in one) == pytest.approx(1.5 * 90, abs=2)


def test_queries_with_sql_match_it(spark):
    duck = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    for name, sql in queries.ORACLES.items():
        result = queries.QUERIES[name](spark, SF)
        expected = duck.execute(sql)
        columns = [c[0] for c in expected.description]
        order = [result.columns.index(c) for c in columns]
        assert sorted(tuple(r[i] for i in order) for r in result.collect()) == sorted(expected.fetchall()), name


def test_every_query_is_registered():
    names = entry_points.queries()
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


def test_pipeline_stages_work_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left, before = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == docs.columns, name
        left = spark.createDataFrame(out.collect(), docs.schema)
        assert left.count() <= before
        before = left.count()
    mixed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert mixed.count() == before
    assert {tuple(r) for r in mixed.collect()} == {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}


def test_pipeline_of_nothing(spark):
    left = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, SF)
        assert left.count() == 0


def test_pipeline_hands_on_small_batches(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(name)
    stage = lambda spark, docs, sf_dir: seen.append(spark.conf.get(name)) or docs
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("nothing", stage), ("last", lambda spark, docs, sf_dir: docs)])
    assert corpus_pipeline.run(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert seen == [corpus_pipeline.BATCH_BYTES] != [before] and spark.conf.get(name) == before
    sizes = np.arange(0, 9_000_000, 3000)
    assert max(sizes[b] - sizes[a] for a, b in arrays.pieces(sizes)) < 1_000_000
