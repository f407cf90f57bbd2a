"""One query per operator over the given tables, and SQL where it can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from provtally.llm import (
    byte_bpe,
    conversation_repair,
    exact_dedup,
    jaccard_join,
    language_id,
    mixing,
    packing,
    quality_rules,
    sharding,
    substring_dedup,
    suffix_dedup,
    url_filter,
    whitening,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), RANKS)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.document_languages(_table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents")).drop("stays", "text_hash")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents")).drop("spans")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents")).drop("spans")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.page_verdicts(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.document_duplicates(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).drop("rejected_by")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damaged_audits(_table(spark, sf_dir, "conversations"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(_table(spark, sf_dir, "documents"), VOCABULARY))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_sharding,
        op3_language_id,
        op4_jaccard_join,
        op5_suffix_dedup,
        op6_substring_dedup,
        op7_url_filter,
        op8_exact_dedup,
        op9_mixing,
        op10_quality_rules,
        op11_conversation_repair,
        op12_packing,
        op13_whitening,
    )
}

# Words as the operators cut them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Words in a window that starts in a document of smaller id go.
_REPEATS = f"""
with w as (select doc_id, {_WORDS} as words from documents),
s as (select doc_id, words, unnest(range(1, len(words) - 48)) as i from w where len(words) >= 50),
g as (select doc_id, i, sha256(array_to_string(list_slice(words, i, i + 49), ' ')) as h from s),
f as (select h, min(doc_id) as first from g group by h),
gone as (select distinct g.doc_id, j.j from g join f using (h), (select unnest(range(0, 50)) as j0) o,
         lateral (select g.i + o.j0 as j) j where g.doc_id > f.first),
c as (select doc_id, count(*) as n_removed, list(j) as js from gone group by doc_id),
p as (select w.doc_id, unnest(w.words) as word, unnest(range(1, len(w.words) + 1)) as i from w),
k as (select p.doc_id, string_agg(p.word, ' ' order by p.i) as kept from p left join gone on gone.doc_id = p.doc_id and gone.j = p.i
      where gone.j is null group by p.doc_id)
select w.doc_id, len(w.words) as n_words, coalesce(c.n_removed, 0) as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from w left join c using (doc_id) left join k using (doc_id)
"""

_COPIES = """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by text_sha256)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, d.text_sha256 from d join g using (text_sha256)
"""

# In order of limit per weight the first source that is not full tells the level that shares out all sizes.
_MIX = f"""
with d as (select doc_id, source, len({_WORDS}) as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select source, source_size, ((row_number() over (order by source is null, source) - 1) % 3 + 1)::double as weight from s),
o as (select *, 3.0::double * source_size as cap, row_number() over (order by 3.0::double * source_size / weight, source) as k from w),
p as (select *, coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0) as fixed,
      sum(weight) over (order by k rows between current row and unbounded following) as free,
      sum(source_size) over () as total from o),
l as (select arg_min(((total - fixed) / free)::double, k) as level from p where (total - fixed) / free * weight <= cap),
t as (select o.source, o.source_size, least(o.cap, l.level * o.weight)::double as target from o, l),
r as (select d.doc_id, d.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate
      from d join t on d.source is not distinct from t.source),
c as (select *, floor(rate)::bigint + case when ('0x' || substr(md5('0:' || doc_id::varchar), 1, 12))::bigint
      / 281474976710656.0::double < rate - floor(rate) then 1 else 0 end as copies from r)
select doc_id, size::bigint as size, source_size, target, size::bigint * copies as taken from c
"""

_QUALITY = rf"""
with d as (select doc_id, coalesce(text, '') as text, {_WORDS} as words from documents),
s as (select doc_id, unnest(range(1, len(words) - 3)) as i, words from d where len(words) >= 5),
g as (select doc_id, i, array_to_string(list_slice(words, i, i + 4), ' ') as h from s),
m as (select doc_id, h from g group by doc_id, h having count(*) > 1),
v as (select distinct g.doc_id, g.i + o.j as i from g join m on m.doc_id = g.doc_id and m.h = g.h, (select unnest(range(0, 5)) as j) o),
n as (select doc_id, count(*) as n_repeat_words from v group by doc_id),
l as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
e as (select doc_id, count(*) as n_lines, count(*) filter (where regexp_matches(line, '[^\x20\x09-\x0D]'))
      - count(distinct case when regexp_matches(line, '[^\x20\x09-\x0D]') then line end) as n_dup_lines from l group by doc_id),
q as (select d.doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
      e.n_dup_lines, e.n_lines, coalesce(n.n_repeat_words, 0) as n_repeat_words
      from d join e using (doc_id) left join n using (doc_id))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
(n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or n_symbols * 100 > n_words * 30
     or n_dup_lines * 100 > n_lines * 50 or word_chars < n_words * 2 or word_chars > n_words * 20) as kept
from q
"""

ORACLES = {
    "op5_suffix_dedup": _REPEATS,
    "op6_substring_dedup": _REPEATS,
    "op8_exact_dedup": _COPIES,
    "op9_mixing": _MIX,
    "op10_quality_rules": _QUALITY,
}
