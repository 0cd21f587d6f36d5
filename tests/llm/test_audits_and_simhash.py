"""Filter interactions, source divergence and SimHash near-duplicates against brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

from tidemark.llm import divergence, filter_audit, simhash_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- filter interactions ------------------------------------------------------------------------


def brute_audit(documents, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    rows = []
    for doc_id, text, lang in documents:
        t = text or ""
        w = WORD.findall(t)
        copy = doc_id is not None and any(i is not None and i < doc_id and (s or "") == t for i, s, _ in documents)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": copy,
        }
        rows.append((lang or "", {k for k, v in fails.items() if v}, doc_id in good, doc_id in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            every = left
            for step, letter in enumerate(order, 1):
                removed = [r for r in left if letter in r[1]]
                redundant = [r for r in every if letter in r[1] and r not in removed and set(order[: step - 1]) & r[1]]
                left = [r for r in left if letter not in r[1]]
                unique = [r for r in every if r[1] == {letter}]
                shapley[part, letter] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), len(redundant), len(unique), sum(r[2] for r in removed), sum(r[3] for r in removed),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def written(folder, documents, files):
    """The documents as a folder of several files; their order in time is the order of the files."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("mask", pa.string()), ("part", pa.int32())])
    for k in range(files):
        own = documents[k::files]
        columns = [[r[0] for r in own], [r[1] for r in own], [r[2] for r in own], ["x"] * len(own), [1] * len(own)]
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        path = folder / "documents.parquet"
        path.mkdir(exist_ok=True)
        pq.write_table(table, path / f"part-{k}.parquet")
    return str(folder / "documents.parquet")


def audited(spark, path, labels, batches):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(spark, path, frame, batches).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([20, 99, 100, 130]))) for _ in range(25)]
    texts += [t + " 100%" for t in texts[:6]] + [t.upper() for t in texts[4:9]] + ["", None, " \t\n", "ÄÖ É" * 60, "A", "a|b"]
    texts += [" ".join(["same"] * 150), " ".join(vocabulary) * 30]
    rows = [(k, t, rng.choice(["en", "de", None])) for k, t in enumerate(texts)]
    # Copies with smaller and larger ids, in other parts; rows that repeat an id; rows without one.
    rows += [(100 + 7 * k, texts[k % len(texts)], rng.choice(["en", "de"])) for k in range(40)]
    rows += [(-k, texts[k], "fr") for k in range(1, 12)] + rows[:5] + [(0, texts[0], "xx"), (None, texts[1], "en"), (None, texts[1], "en")]
    rng.shuffle(rows)
    return rows


LABELS = [(k, k % 2, k % 3 % 2) for k in range(0, 90, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (-3, 1, None), (-4, None, 1), (3, None, None)]


@pytest.mark.parametrize("files,batches", [(6, 6), (6, 2), (1, 1)])
def test_audit_equals_brute_force_in_any_number_of_batches(spark, tmp_path, documents, files, batches):
    path = written(tmp_path, documents, files)
    assert audited(spark, path, LABELS, batches) == brute_audit(documents, LABELS)


def test_a_smaller_id_retracts_what_was_counted(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(120))
    rows = [(9, text, "en"), (5, text, "de"), (1, text, "en")]  # one file each, in this order
    path = written(tmp_path, rows, 3)
    counters = filter_audit.count_masks(spark, path, spark.createDataFrame([], "doc_id long, quality int, toxic int"), 3)
    found = {(r["part"], r["mask"]): r["n"] for r in counters.collect() if r["n"]}
    assert found == {("en", 0): 1, ("en", 16): 1, ("de", 16): 1}


def test_audit_goes_on_with_new_files(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [(9, "a b", "en"), (5, "c", "en")]
    path = written(tmp_path, rows, 1)
    first = filter_audit.count_masks(spark, path, labels, folder=str(tmp_path / "run"))
    assert {(r["mask"], r["n"]) for r in first.collect()} == {(1, 2)}
    schema = pq.read_schema(f"{path}/part-0.parquet")
    pq.write_table(pa.table([[1], ["a b"], ["en"], ["x"], pa.array([1], pa.int32())], schema=schema), f"{path}/part-1.parquet")
    second = filter_audit.count_masks(spark, path, labels, folder=str(tmp_path / "run"))
    assert {(r["mask"], r["n"], r["good"]) for r in second.collect()} == {(1, 2, 1), (17, 1, 0)}


def test_audit_of_a_table_without_rows(spark, tmp_path):
    assert audited(spark, written(tmp_path, [], 1), [], 1) == {}


# --- source divergence --------------------------------------------------------------------------


def brute_divergence(documents, least_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in documents:
        lang, source = lang or "", source or ""
        words = TERM.findall(lowered(text))
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        own = sorted(s for x, s in groups if x == lang)

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        of = {s: p(counts[lang, s]) for s in own}
        q = p(sum((counts[lang, s] for s in own), Counter()))
        for s in own:
            pairs = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, of[s][t] - q[t]) for t in kept if counts[lang, s][t] > 0 and of[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)}
    return out


@pytest.mark.parametrize("stripe,block", [(1024, 32), (4, 3)])
def test_divergence_equals_brute_force(spark, monkeypatch, stripe, block):
    monkeypatch.setattr(divergence, "STRIPE", stripe)
    monkeypatch.setattr(divergence, "BLOCK", block)
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ["x", "y", "ß", "É", "Z"]]
    rows = []
    for k in range(300):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", "z", None, *(f"t{i}" for i in range(6))])
        own = words[: 8 + 3 * (hash((lang, source)) % 7)]
        rows.append((" ".join(rng.choices(own, k=rng.choice([0, 3, 20]))) + rng.choice([" 12", " a-b", "_C_", ""]), lang, source))
    rows += [(None, "en", "s1"), (None, "en", "empty"), ("", "lone", None), ("rare terms", "few", "a"), ("rare", "few", "b"), ("x " * 3000, "en", "hot")]
    rows += rows[:7]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, docs long, term string")
    result = divergence.audit(frame.repartition(3), 4, 5)
    assert result.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    found = [tuple(r) for r in result.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_divergence(rows, 4, 5)


def test_divergence_of_no_documents(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_shares_are_exact_beyond_64_bits(spark):
    frame = spark.createDataFrame([(3 * 10**15 + 1, 10**16 + 7, 10**6)], "c long, n long, v long")
    value = frame.select(divergence.share(frame.c, frame.n, frame.v)).first()[0]
    assert value == 1 + 10**9 * (3 * 10**15 + 6) // (10**16 + 7 + 5 * 10**6)


def test_only_quadrants_set_on_both_sides_are_traversed():
    leaves = np.zeros((5, 9), bool)
    leaves[[0, 3, 4], [1, 1, 8]] = True
    found = {tuple(map(int, x)) for x in divergence.joint_leaves(divergence.tree_levels(leaves))}
    assert found == {(0, 0, 1), (0, 3, 1), (3, 3, 1), (4, 4, 8)}
    assert len(divergence.joint_leaves(divergence.tree_levels(np.zeros((3, 3), bool)))) == 0


# --- SimHash ------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = WORD.findall(lowered(text))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, reach):
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(parent, 2):
        if (a ^ b).bit_count() <= reach:
            parent[root(a)] = root(b)
    least = {}
    for i, f in zip(ids, prints, strict=True):
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return [least.get(root(f)) for f in prints]


def near_rows(rows):
    return Counter((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in rows)


def test_simhash_equals_brute_force(spark, docs):
    rng = random.Random(11)
    words = [f"Wort{k}é" for k in range(300)]
    texts = [None, "", " \n", "one", "one two", "ONE two three", "one  two\tthree", "a" * 100_000, " ".join(words) * 400]
    for _ in range(6):
        base = rng.choices(words, k=400)
        for _ in range(20):
            copy = list(base)
            copy[rng.randrange(400)] = "changed"
            texts.append(" ".join(copy))
    texts += texts[:30]
    ids = [k * 3 for k in range(len(texts))]
    ids[9], ids[10], ids[-1] = None, 33, None
    prints = [brute_fingerprint(t) for t in texts]
    expected = Counter(zip(ids, prints, brute_components(ids, prints, 3), strict=True))
    frame = docs(texts, ids)
    assert near_rows(simhash_dedup.near_duplicates(frame).collect()) == expected
    # Every place crowded: dealt by block as well, with the same result.
    assert near_rows(simhash_dedup.near_duplicates(frame, crowd=1).collect()) == expected


@pytest.mark.parametrize("reach", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("crowd", [1, 10**6])
def test_no_link_is_missed(spark, reach, crowd):
    rng = random.Random(reach)
    prints = {rng.getrandbits(64) for _ in range(5)}
    for f in list(prints):
        prints |= {f ^ sum(1 << b for b in rng.sample(range(64), k)) for k in range(1, 7) for _ in range(6)}
    prints |= {0, 2**64 - 1, 1 << 63, (1 << 63) + 1, 0xFFFFFFFF, 0xFFFFFFFF << 32}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in prints]
    found = [(r["p"], r["c"]) for r in simhash_dedup.links(spark.createDataFrame(signed, "fp long"), reach, crowd).collect()]
    expected = {frozenset((a, b)) for (a,), (b,) in itertools.combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= reach}
    assert len(found) == len(expected) and {frozenset(x) for x in found} == expected


def test_candidates_of_a_spread_group_stay_few(spark):
    """Fingerprints that agree in one segment and are random elsewhere meet in few pairs, not in all."""
    rng = random.Random(3)
    prints = [(rng.getrandbits(31),) for _ in range(3000)]
    classes = spark.createDataFrame(prints, "fp long").distinct()
    segments = simhash_dedup._cuts(64, 2)
    table = simhash_dedup._table(classes, segments)
    probes = simhash_dedup._probes(table, 32)
    sides = [simhash_dedup._in_blocks(x.where("seg = 1"), 32, 3) for x in (table, probes)]
    candidates = sides[0].select("key", "block").join(sides[1].select("key", "block"), ["key", "block"]).count()
    assert candidates < 3000 * 3000 / 2 / 10


def test_simhash_of_no_documents(spark, docs):
    assert simhash_dedup.near_duplicates(docs([])).collect() == []
