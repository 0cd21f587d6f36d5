import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import contamination, jaccard_join, suffix_dedup
from tidemark.llm.frames import batch_bytes

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- repeated byte strings ----------------------------------------------------------------------


def removed(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [100, 400])
def test_suffix_dedup_matches_brute_force(docs, length):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(900)) for _ in range(3)]
    texts = []
    for _ in range(24):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 3])):
            t[rng.randrange(len(t))] = "Z"
        start = rng.randrange(200)
        texts.append("".join(t)[start : start + rng.randint(100, 900)] + rng.choice(["", "x" * rng.randint(0, 700)]))
    texts += [None, "", "a" * 1500, "a" * length, "b" * (length - 1), texts[0], texts[0], "ab" * 450]
    found = suffix_dedup.repeated_spans(docs(texts), length).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in found} == dict(
        enumerate(removed(texts, length))
    )


def test_suffix_dedup_without_documents_and_with_repeated_ids(docs):
    assert suffix_dedup.repeated_spans(docs([])).count() == 0
    found = suffix_dedup.repeated_spans(docs(["q" * 10, "r" * 10, "long " * 100], ids=[1, 1, None])).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in found) == [(10, 0), (10, 0), (500, 500)]


def test_the_suffix_steps_take_bounded_batches(docs, monkeypatch):
    spark, name = docs([]).sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    before, limits, stored = spark.conf.get(name), set(), suffix_dedup.stored

    def watched(df, purpose):
        limits.add(spark.conf.get(name))
        return stored(df, purpose)

    monkeypatch.setattr(suffix_dedup, "stored", watched)
    assert suffix_dedup.repeated_spans(docs(["a" * 500, "b" * 10])).count() == 2
    assert limits == {suffix_dedup.BATCH_BYTES} and spark.conf.get(name) == before
    # The limit is one that the engine keeps.
    sizes = docs(["x" * 1_000_000] * 12).coalesce(1).select("text").mapInArrow(lambda bs: (b.slice(0, 1) for b in bs), "text string")
    with batch_bytes(spark, suffix_dedup.BATCH_BYTES):
        assert sizes.count() >= 3
    assert sizes.count() == 1


class Caught:
    """Takes the place of a frame, to call what would run in its tasks."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run


def test_short_texts_are_worked_on_together(monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdef ") for _ in range(3000))
    texts = [base[a : a + rng.randint(400, 700)] for a in (rng.randrange(2300) for _ in range(60))] + ["a" * 450, "b" * 900]
    calls, sample = [], suffix_dedup.sample
    monkeypatch.setattr(suffix_dedup, "sample", lambda *args: calls.append(1) or sample(*args))

    def rows(step, batch):
        frame = Caught()
        step(frame)
        calls.clear()
        return pa.Table.from_batches(frame.run(iter([batch])))

    def steps():
        sampled = rows(lambda f: suffix_dedup._sampled(f, 400, "text"), pa.RecordBatch.from_pydict({"text": texts}))
        places = {}
        for row in sampled.to_pylist():
            places.setdefault(row["key"], []).append(row["pos"])
        data = [t.encode() for t in texts if suffix_dedup._text_key(np.frombuffer(t.encode(), np.uint8)) in places]
        keys = [suffix_dedup._text_key(np.frombuffer(d, np.uint8)) for d in data]
        long = pa.list_(pa.int64())
        batch = pa.RecordBatch.from_pydict({
            "key": keys, "text": data, "copied": [i % 9 == 0 for i in range(len(data))],
            "sure": pa.array([[3] if i % 3 == 0 else [] for i in range(len(data))], long),
            "sure_end": pa.array([[403] if i % 3 == 0 else [] for i in range(len(data))], long),
            **{f"b{level}": pa.array([places[k] for k in keys], long) for level in range(3)},
        })
        asked = rows(lambda f: suffix_dedup._asked(f, 400), batch)
        return len(calls), sampled.to_pylist(), [r for r in asked.to_pylist() if r["key"] is not None]

    together = steps()
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 1)
    alone = steps()
    assert together[0] == 1 and alone[0] >= 55 and len(together[2]) > 200
    assert together[1:] == alone[1:]


# --- near duplicates ----------------------------------------------------------------------------


def components(texts):
    sets = []
    for t in texts:
        w = BLANK_WORD.findall(low(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def near_copies(seed=11):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for _ in range(8):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 30, 120]))]
        if rng.random() < 0.7:
            base += passage
        for _ in range(rng.choice([1, 4, 9])):
            t = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts.append(" ".join(t).upper() if rng.random() < 0.3 else "\t".join(t))
    return [*texts, None, "", "   ", "one", "ONE", "two words", texts[0], " ".join(passage), "same " * 3000, "same " * 2000]


def test_components_match_brute_force(docs):
    texts = near_copies()
    found = jaccard_join.join(docs(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == dict(enumerate(components(texts)))


def crowd(copies, seed=2):
    """Texts of a common line and words of their own: one cell, hardly any links; and a few that are linked."""
    rng = random.Random(seed)
    line = [f"line{k}" for k in range(40)]
    texts = [" ".join(line + [f"own{k}-{j}" for j in range(rng.choice([5, 8, 11]))]) for k in range(copies)]
    return texts + [t + " end" for t in texts[::17]]


@pytest.mark.parametrize("members,columns", [(512, 1 << 13), (7, 5)])
def test_crowded_cells_are_joined_in_blocks(docs, monkeypatch, members, columns):
    monkeypatch.setattr(jaccard_join, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(jaccard_join, "_COLUMNS", columns)
    texts = crowd(60) + near_copies(5)
    found = jaccard_join.join(docs(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == dict(enumerate(components(texts)))


def test_rows_of_a_crowded_cell_grow_with_its_members(docs, monkeypatch):
    """Four times the rows that share a line: about four times the rows of the join, not sixteen times."""
    seen = []
    block_links, distances = jaccard_join._block_links, jaccard_join._distances

    def counted(left, sets):
        seen[-1] += left.count()
        return block_links(left, sets)

    def measured(pairs, sets):
        seen[-1] += pairs.count()
        return distances(pairs, sets)

    monkeypatch.setattr(jaccard_join, "_block_links", counted)
    monkeypatch.setattr(jaccard_join, "_distances", measured)
    for copies in (200, 800):
        seen.append(0)
        jaccard_join.join(docs(crowd(copies))).count()
    assert seen[0] > 0 and seen[1] < 6 * seen[0]


def test_block_links_connect_what_is_linked():
    rng = random.Random(4)
    sets = [np.unique(np.array(rng.sample(range(60), 30), np.uint64)) for _ in range(40)]
    exact = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert jaccard_join._intersections(sets).tolist() == exact
    # What no other set has is left out, so a set of such shingles only has no intersections.
    assert not jaccard_join._intersections([np.array([k], np.uint64) for k in range(3)]).any()


def test_chains_of_links_are_followed(docs):
    words = [f"v{i}" for i in range(260)]
    texts = [" ".join(words[4 * k : 4 * k + 100]) for k in range(40)]
    found = jaccard_join.join(docs(texts)).collect()
    assert components(texts)[-1][1] == 0 and {r["component_id"] for r in found} == {0}


def test_one_document_of_each_group_stays(docs):
    texts = near_copies(12)
    expected = {i for i, (n, c) in enumerate(components(texts)) if n == 0 or c == i}
    kept = jaccard_join.keep_one(docs(texts))
    assert kept.columns == docs([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_join_with_null_and_repeated_ids_and_without_rows(docs):
    assert jaccard_join.join(docs([])).count() == 0 == jaccard_join.keep_one(docs([])).count()
    frame = docs(["a b c d e f", "a b c d e f", "a b c d e f", "z y x w v u"], ids=[4, 4, None, None])
    assert sorted(((r["doc_id"], r["component_id"]) for r in jaccard_join.join(frame).collect()), key=str) == sorted(
        [(4, 4), (4, 4), (None, 4), (None, None)], key=str
    )
    assert jaccard_join.keep_one(frame).count() == 2


# --- contamination ------------------------------------------------------------------------------


def contaminated(texts, items):
    windows = []
    for item, text in items:
        w = ITEM_WORD.findall(low(text))
        if w:
            windows += [(item, tuple(w[k : k + 13])) for k in range(max(1, len(w) - 12))]
    out = []
    for t in texts:
        w = ITEM_WORD.findall(low(t))
        hit, found = set(), set()
        for item, x in windows:
            for p in range(len(w) - len(x) + 1):
                if tuple(w[p : p + len(x)]) == x:
                    hit |= set(range(p, p + len(x)))
                    found |= {str(item)} - {"None"}
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_contamination_matches_brute_force(spark, docs):
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(60)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(rng.choice([1, 3, 4, 7, 12, 13, 14, 40])))) for i in range(14)]
    items += [(3, " ".join(draw(20))), (20, None), (21, ""), (22, "--"), (None, " ".join(draw(15))), (23, items[5][1])]
    texts = [None, "", "...", items[7][1]]
    for _ in range(40):
        t = draw(rng.choice([5, 30, 400]))
        for _ in range(rng.choice([0, 1, 2])):
            w = ITEM_WORD.findall(low(rng.choice(items)[1]))
            a = rng.randrange(len(w)) if w else 0
            at = rng.randrange(len(t))
            t[at:at] = w[a : a + rng.choice([8, 13, 20, 40])]
        texts.append(rng.choice([", ", " ", "-"]).join(t).upper())
    texts.append(texts[-1])
    test = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.find_contamination(docs(texts), test).withColumn("bad", contamination.is_contaminated()).collect()
    expected = contaminated(texts, items)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["bad"]) for r in found} == dict(enumerate(expected))
    kept = contamination.drop_contaminated(docs(texts), test)
    assert kept.columns == docs([]).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, x in enumerate(expected) if not x[3]]


def test_an_item_without_id_contaminates_but_is_not_listed(spark, docs):
    words = [f"w{k}" for k in range(15)]
    test = spark.createDataFrame([(None, " ".join(words)), (5, " ".join(words[:13]))], "item_id long, text string")
    found = contamination.find_contamination(docs([" ".join(words), "other"]), test).collect()
    assert {(r["doc_id"], r["n_hit"], tuple(r["items"])) for r in found} == {(0, 15, ("5",)), (1, 0, ())}
    unnamed = test.where("item_id is null")
    assert contamination.find_contamination(docs([" ".join(words)]), unnamed).first()["items"] == []
    assert contamination.drop_contaminated(docs([" ".join(words), "other"]), unnamed).count() == 1


def test_columns_of_documents_may_have_any_name(spark, docs):
    words = " ".join(f"w{k}" for k in range(20))
    frame = docs([words, words, "other text"])
    for name in ("text_key", "set_key", "copies", "least_id", "c", "n", "label", "maybe", "n_words", "quality_score"):
        frame = frame.withColumn(name, F.lit("kept"))
    test = spark.createDataFrame([(1, words)], "item_id long, text string")
    clean = contamination.drop_contaminated(frame, test)
    assert clean.columns == frame.columns and [r["set_key"] for r in clean.collect()] == ["kept"]
    distinct = jaccard_join.keep_one(frame)
    assert distinct.columns == frame.columns and {r["copies"] for r in distinct.collect()} == {"kept"} and distinct.count() == 2


def test_contamination_of_and_by_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.find_contamination(docs(["a b"]), none).first()["n_hit"] == 0
    assert contamination.find_contamination(docs([]), none).count() == 0
