"""The registered ``opN_`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, fingerprints, jaccard_join, multi_index, packing, quality, substring_dedup, suffix_dedup, toxicity, url_filters
from .common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    graded = quality.grade(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return graded.withColumn("kept", F.col("p_upper") >= quality.KEEP)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove(table(spark, sf_dir, "documents")).drop("t")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_suffix_dedup, op2_fingerprints, op3_byte_bpe, op4_jaccard_join, op5_packing, op6_toxicity, op7_url_filters, op8_multi_index, op9_quality, op10_substring_dedup)}

#: Words as the operators see them, for DuckDB.
_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op4_jaccard_join": f"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER}, {_WORDS}) ws from documents),
s as (select distinct doc_id, case when len(ws) >= 5 then array_to_string(ws[i:i + 4], ' ') else array_to_string(ws, ' ') end k
      from w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) t(i) where len(ws) > 0),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.k = b.k and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 80 * (nx.n + ny.n - c)),
e as (select x, y from l union all select y, x from l),
r(doc_id, reach) as (select doc_id, doc_id from w union select r.doc_id, e.y from r join e on r.reach = e.x)
select w.doc_id, coalesce(any_value(n.n), 0) n_shingles, min(reach) component_id
from w join r on r.doc_id = w.doc_id left join n on n.doc_id = w.doc_id group by w.doc_id
""",
    "op8_multi_index": """
with recursive v as (select vec_id, case when len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
                                    then embedding::double[] end e from embeddings),
l as (select a.vec_id x, b.vec_id y from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
r(vec_id, reach) as (select vec_id, vec_id from v union select r.vec_id, l.y from r join l on r.reach = l.x),
c as (select vec_id, min(reach) component_id from r group by 1),
n as (select x vec_id, count(*) n from l group by 1)
select c.vec_id, coalesce(n.n, 0) n_links, component_id, c.vec_id = component_id kept from c left join n on n.vec_id = c.vec_id
""",
    "op10_substring_dedup": f"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 19], ' ') k from w, unnest(range(1, len(ws) - 18)) t(i) where len(ws) >= 20),
dup as (select doc_id, i from (select doc_id, i, row_number() over (partition by k order by doc_id, i) rn from win) where rn > 1),
cov as (select doc_id, list(distinct p) ps from dup, unnest(range(i, i + 20)) u(p) group by 1),
j as (select w.doc_id, ws, coalesce(ps, []) ps from w left join cov on cov.doc_id = w.doc_id)
select doc_id, len(ws) n_words, len(ps) n_removed,
       sha256(array_to_string(case when len(ps) = 0 then ws else list_filter(ws, lambda x, i: not list_contains(ps, i)) end, ' ')) kept_sha256 from j
""",
    "op7_url_filters": """
with u as (select page_id, coalesce(case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end, '') rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from u),
r as (select *, case
  when ends_with('.' || host, '.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
  when ends_with('.' || host, '.example.com') and starts_with(path, '/en/') then 'example.com/en/'
  when ends_with('.' || host, '.net') and starts_with(path, '/es/') then 'net/es/'
  when ends_with('.' || host, '.net') and starts_with(path, '/fr/') then 'net/fr/'
  when ends_with('.' || host, '.com') and starts_with(path, '/') then 'com/' end rule from p)
select page_id, host, path, rule, case
  when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
  when contains('.' || host || path, 'spam') or contains('.' || host || path, 'casino') or contains('.' || host || path, '.porn') or contains('.' || host || path, 'phish') then 'block'
  else 'allow' end verdict from r
""",
}
