"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    contamination, context_tree, divergence, filter_audit, jaccard_join, main_text, mixing, quality, secrets,
    simhash_dedup, suffix_dedup, token_counts, top_k,
)
from tidemark.llm.frames import table
from tidemark.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def op1_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op4_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    scored = context_tree.score(table(spark, sf_dir, "documents"), remainder("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = contamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contamination.is_contaminated().alias("contaminated"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text.extract(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    settings = quality.Settings()
    rows = quality.training_rows(docs, labels, remainder("doc_id", 4) != 2, settings)
    scored = quality.score(docs, quality.train(rows, settings), settings)
    return scored.select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= settings.threshold).cast("int").alias("predicted"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Query] = {
    "op1_top_k_search": op1_top_k_search,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_context_tree_scores": op4_context_tree_scores,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_source_mixing": op7_source_mixing,
    "op8_secret_scans": op8_secret_scans,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_divergence": op12_source_divergence,
    "op13_simhash_dedup": op13_simhash_dedup,
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

# DuckDB SQL for what SQL can say; the other queries are tested against brute force.
ORACLES: dict[str, str] = {
    "op1_top_k_search": """
with e as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select q.vec_id as query_id, c.vec_id as vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score,
             row_number() over (partition by q.vec_id order by list_dot_product(q.v, c.v) desc, c.vec_id) as rank
      from e q join e c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
where rank <= 5""",
    "op5_benchmark_decontamination": f"""
with d as (
    select doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
i as (
    select item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
win as (
    select distinct item_id, n, array_to_string(w[k:k + n - 1], ' ') as s
    from (select *, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as k from i where len(w) > 0)),
pos as (
    select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as s
    from (select d.doc_id, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) as k from d, (select distinct n from win) l)),
hit as (select distinct doc_id, n, k, item_id from pos join win using (n, s)),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, k + unnest(range(0, n)) as p from hit) group by 1),
-- an item without id has windows, but cannot be listed
ids as (select doc_id, list_sort(list(distinct cast(item_id as varchar)) filter (where item_id is not null)) as ids from hit group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, cast(coalesce(len(ids), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (doc_id) left join ids using (doc_id)""",
    "op6_jaccard_join": f"""
with recursive d as (select doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
    select distinct doc_id, array_to_string(w[k:k + 4], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as k from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
shared as (select s from s group by 1 having count(*) > 1),
few as (select s.* from s join shared using (s)),
met as (select a.doc_id as x, b.doc_id as y, count(*) as k from few a join few b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
link as (
    select x, y from met join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * k >= 75 * (nx.n + ny.n - k)),
edge as (select x, y from link union all select y, x from link),
reach(doc_id, other) as (
    select doc_id, doc_id from documents union select r.doc_id, e.y from reach r join edge e on r.other = e.x)
select doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(other) as component_id
from reach left join n using (doc_id) group by doc_id""",
    "op11_filter_audit": """
with recursive d as (
    select doc_id, coalesce(text, '') as t, coalesce(lang, '') as part from documents),
w as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w from d),
firsts as (select t, min(doc_id) as least from d group by t),
flags as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels where doc_id is not null group by doc_id),
m as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           case when len(w) < 100 then 1 else 0 end
           + case when 100 * len(list_distinct(w)) < 80 * len(w) then 2 else 0 end
           + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 4 else 0 end
           + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
           + case when w.doc_id > least then 16 else 0 end as mask
    from w join firsts using (t) left join flags on flags.doc_id = w.doc_id),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by 1, 2),
o(filter_order, step, bit, before) as (
    select '', 0, 0, 0
    union all
    select filter_order || letter, step + 1, b, before + o.bit
    from o, (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(letter, b)
    where step < 5 and not contains(filter_order, letter)),
-- every order is a path; its five steps are its prefixes
p as (
    select full_order.filter_order, o.step, o.bit, o.before
    from o join (select filter_order from o where step = 5) full_order on o.step > 0 and starts_with(full_order.filter_order, o.filter_order)),
r as (
    select part, filter_order, step, bit,
           sum(case when mask & (before | bit) = 0 then n else 0 end) as kept,
           sum(case when mask & bit <> 0 and mask & before = 0 then n else 0 end) as removed,
           sum(case when mask & bit <> 0 and mask & before <> 0 then n else 0 end) as redundant,
           sum(case when mask = bit then n else 0 end) as unique_fails,
           sum(case when mask & bit <> 0 and mask & before = 0 then good else 0 end) as good_lost,
           sum(case when mask & bit <> 0 and mask & before = 0 then toxic else 0 end) as toxic_lost
    from c, p group by 1, 2, 3, 4)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
       cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from r""",
    "op12_source_divergence": f"""
with d as (
    select coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all({_LOWERED}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
g as (select distinct lang, source from d),
kept as (select lang, term from (select lang, unnest(list_distinct(w)) as term from d) group by 1, 2 having count(*) >= 30),
seen as (select lang, source, term, count(*) as c from (select lang, source, unnest(w) as term from d) join kept using (lang, term) group by 1, 2, 3),
v as (select lang, count(*) as v from kept group by 1),
cells as (select g.lang, g.source, k.term, coalesce(c, 0) as c from g join kept k using (lang) left join seen using (lang, source, term)),
groups as (select lang, source, sum(c) as n from cells group by 1, 2),
langs as (select lang, term, sum(c) as c from cells group by 1, 2),
lang_n as (select lang, sum(c) as n from langs group by 1),
p as (
    select lang, source, term, c, cast(1 + (1000000000::hugeint * (c + 5)) // (n + 5 * v)::hugeint as bigint) as p
    from cells join groups using (lang, source) join v using (lang)),
q as (
    select lang, term, cast(1 + (1000000000::hugeint * (c + 5)) // (n + 5 * v)::hugeint as bigint) as q
    from langs join lang_n using (lang) join v using (lang)),
f as (
    select a.lang, a.source, b.source as item, cast(sum(abs(a.p - b.p)) as bigint) as value
    from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (
    select lang, source, 'term' as part, term as item, p - q as value from p join q using (lang, term) where c > 0 and p > q),
ranked as (
    select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
    from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50""",
}
