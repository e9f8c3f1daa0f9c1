"""Registered queries of the training-data operators, each over whole tables.

``REGISTRY`` has the callables, ``STATEMENTS`` the DuckDB statements of those
that SQL can express.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citegrid.llm import (credentials, fingerprints, hard_negatives, langid, mixing, ngram_join, packing, phrases, repeats,
                          token_files, topk_search, toxicity, warc)
from citegrid.session import scratch_path

#: Vocabulary of the token files; the file is a parameter of the operator.
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(_table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op2_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER))
    return token_files.digest(token_files.read(spark, folder)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = ngram_join.Rule(k=3, num=90, den=100)
    joined = ngram_join.join(_table(spark, sf_dir, "documents"), rule)
    return ngram_join.component_ids(joined).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(spark, warc.write(_table(spark, sf_dir, "pages"), scratch_path(spark, "archives")))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), least=30, longest=4, report=2000)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove(_table(spark, sf_dir, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_topk_search, op2_bin_packing, op3_source_mixing, op4_token_files, op5_language_id,
                            op6_fingerprints, op7_secret_scan, op8_ngram_jaccard, op9_toxicity, op10_warc, op11_phrase_collocations,
                            op12_substring_dedup, op13_hard_negatives)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

STATEMENTS: dict[str, str] = {
    "op1_topk_search": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
one as (select vec_id, min(q) as q from v group by vec_id),
c as (select vec_id, unnest(q) as x, generate_subscripts(q, 1) as i, len(q) as n from one),
s as (
  select a.vec_id as query_id, b.vec_id, sum(a.x * b.x)::bigint as score
  from c a join c b on a.i = b.i and a.n = b.n and a.vec_id <> b.vec_id
  where a.vec_id % 50 = 0 group by all),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as k from s)
select query_id, k::int as rank, vec_id, score from r where k <= 5""",
    "op3_source_mixing": f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, text, '')), 1, 15))::bigint as h from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select *, source_size * 3 as cap, sum(source_size) over () as total,
    [5.0, 2.0, 1.0][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::double as w from s),
o as (
  select *, cap / w <= (total - coalesce(sum(cap) over (order by cap / w, source is null, source
      rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by cap / w, source is null, source rows between current row and unbounded following) as held from w),
l as (
  select *, (total - coalesce(sum(case when held then cap end) over (), 0))
    / sum(case when not held then w end) over () as level from o),
t as (select source, source_size, case when held then cap::double else level * w end as target from l),
b as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from t),
h as (select source, h, sum(size)::bigint as words from d group by source, h),
c as (
  select h.source, h.h, h.words, b.whole, b.target - b.whole * b.source_size as rest,
    sum(h.words) over (partition by h.source order by h.h) as upto
  from h join b on h.source is not distinct from b.source),
p as (
  select source, h, case when upto <= rest then 1
    when upto - words > rest then 0 else (upto - rest <= rest - (upto - words))::int end as more,
    upto - words as before, rest, upto from c),
e as (select source, min(h) as boundary from p where upto > rest group by source)
select d.doc_id, d.size, b.source_size, b.target, (d.size * (b.whole + case
    when e.boundary is null then 0 when d.h < e.boundary then 1 when d.h > e.boundary then 0 else p.more end))::bigint as taken
from d join b on d.source is not distinct from b.source
left join e on d.source is not distinct from e.source
left join p on d.source is not distinct from p.source and d.h = p.h""",
    "op8_ngram_jaccard": f"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s
  from words),
sized as (select doc_id, len(s) as n, s from sets),
flat as (select doc_id, n, unnest(s) as g from sized),
pairs as (
  select x.doc_id as a, y.doc_id as b from flat x join flat y on x.g = y.g and x.doc_id < y.doc_id
    and least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 90
  group by x.doc_id, y.doc_id, x.n, y.n having count(*) * 190 >= (x.n + y.n) * 90),
links as (select a, b from pairs union all select b, a from pairs),
reach(doc_id, other) as (
  select doc_id, doc_id from sized union select r.doc_id, l.b from reach r join links l on l.a = r.other)
select z.doc_id, z.n::bigint as n_shingles, m.component_id
from sized z join (select doc_id, min(other) as component_id from reach group by doc_id) m using (doc_id)""",
    "op10_warc": """
with p as (select page_id, coalesce(html, '') as html from pages),
s as (select page_id, html, sha1(html) as hex, max(page_id) over (partition by html) as top from p),
v as (select *, list_transform(range(0, 32), lambda i:
    (('0x' || substr(hex, (i // 4 * 5 + 1)::int, 5))::int >> ((3 - i % 4) * 5)::int) & 31) as five from s)
select page_id, octet_length(encode(html))::bigint as payload_bytes,
  array_to_string(list_transform(five, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x + 1)::int, 1)), '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to from v""",
    "op11_phrase_collocations": f"""
with d as (
  select row_number() over () as r, coalesce(lang, 'und') as lang, regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]') as p from documents),
p as (select r, lang, unnest(p) as x from d),
w as (select lang, regexp_extract_all(x, '[^\\x20\\x09]+') as w from p),
totals as (select lang, sum(len(w))::bigint as n from w group by lang),
g as (
  select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
  from w, (select unnest([1, 2, 3, 4]) as m) where len(w) >= m),
f as (select lang, m, phrase, count(*)::bigint as a from g group by all),
c as (select *, string_split(phrase, ' ') as x from f where m > 1 and a >= 30),
covered as (
  select distinct s.lang, s.phrase
  from (select lang, a as longer, array_to_string(x[i:i + t - 1], ' ') as phrase
    from (select *, unnest(range(1, m - t + 2)) as i from c, (select unnest([2, 3]) as t) where m > t)) s
  join c on c.lang = s.lang and c.phrase = s.phrase where 100 * s.longer::hugeint >= 80 * c.a::hugeint),
cuts as (
  select lang, phrase, a, k, array_to_string(x[1:k], ' ') as left_part, array_to_string(x[k + 1:], ' ') as right_part
  from (select *, unnest(range(1, m)) as k from c)),
scored as (
  select u.lang, u.phrase, u.a, u.k, l.a as l, r.a as r, (2000000 * u.a::hugeint // (l.a + r.a))::bigint as score
  from cuts u join f l on l.lang = u.lang and l.phrase = u.left_part join f r on r.lang = u.lang and r.phrase = u.right_part),
lowest as (select *, row_number() over (partition by lang, phrase order by score, k) as o from scored),
ranked as (
  select s.*, row_number() over (partition by s.lang order by score desc, a desc, s.phrase) as rank
  from lowest s left join covered v on v.lang = s.lang and v.phrase = s.phrase where s.o = 1 and v.phrase is null)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000""",
    "op12_substring_dedup": f"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
s as (
  select r, i, md5(array_to_string(w[i:i + 34], ' ')) as h
  from (select r, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
again as (select r, i from (select r, i, count(*) over (partition by h) as c from s) where c > 1),
p as (select r, unnest(w) as x, generate_subscripts(w, 1) as i from d),
g as (
  select p.r, p.i, p.x, coalesce(max(case when a.i is not null then 1 end)
    over (partition by p.r order by p.i rows between 34 preceding and current row), 0) as gone
  from p left join again a on p.r = a.r and p.i = a.i),
k as (select r, sum(gone)::bigint as n_removed, string_agg(x, ' ' order by i) filter (where gone = 0) as kept from g group by r)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(k.n_removed, 0)::bigint as n_removed,
  sha256(coalesce(k.kept, '')) as kept_sha256
from d left join k on d.r = k.r""",
    "op13_hard_negatives": """
with v as (
  select row_number() over () as r, vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c as (select r, vec_id, label, unnest(q) as x, generate_subscripts(q, 1) as i, len(q) as n from v),
s as (
  select a.r as a, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same, sum(a.x * b.x)::bigint as score
  from c a join c b on a.i = b.i and a.n = b.n and a.r <> b.r where a.vec_id % 100 = 0 group by all),
p as (
  select a, anchor_id, r as pr, vec_id as positive_id, score as positive_score
  from (select *, row_number() over (partition by a order by score desc, vec_id) as k from s where same) where k <= 5),
w as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.a, p.pr order by s.score desc, s.vec_id) as rank
  from p join s on p.a = s.a and not s.same and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from w where rank <= 10""",
}
