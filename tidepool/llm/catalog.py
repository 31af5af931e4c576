"""The operators' queries (op<N>_<name>, pipeline) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidepool.llm import (bpe, exact_dedup, licenses, merkle, mix, piece_bpe, quality, secrets, simhash, token_output,
                          toxicity, trie, warc)
from tidepool.llm.common import crc32_sql
from tidepool.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(read_table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.training_order(read_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "n_left", "kept")


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(read_table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verification(read_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, QueryFn] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_mix": op3_mix,
    "op4_licenses": op4_licenses,
    "op5_secrets": op5_secrets,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_warc": op8_warc,
    "op9_token_output": op9_token_output,
    "op10_quality_rules": op10_quality_rules,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_merkle": op12_merkle,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

_EXACT_SQL = """
with g as (select text, max(doc_id) as keep_id, count(*) as group_size
           from (select doc_id, coalesce(text, '') as text from documents) group by text)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(coalesce(d.text, '')) as text_sha256
from documents d join g on coalesce(d.text, '') = g.text
"""

_MIX_SQL = f"""
with sized as (
  select doc_id, source, coalesce(cast(doc_id as varchar), '') as id,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size
  from documents),
per as (
  select source, cast(sum(size) as bigint) as source_size, count(*) filter (size > 0) as n from sized group by source),
weighed as (
  select *, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint)] as weight from per),
levels as (
  select *, cast(sum(source_size) over () - coalesce(sum(source_size * {mix.CAP}) over (
              order by source_size / weight, source nulls last
              rows between unbounded preceding and 1 preceding), 0) as double)
            / sum(weight) over (order by source_size / weight, source nulls last
                                rows between current row and unbounded following) as level from weighed),
aimed as (
  select *, least(cast(source_size * {mix.CAP} as double), max(level) over () * weight) as target from levels),
kept as (
  select source, source_size, n, target,
         case when source_size = 0 then 0 when target >= source_size * {mix.CAP} then {mix.CAP}
              else cast(floor(target / source_size) as bigint) end as copies from aimed),
remaining as (select *, target - copies * source_size as rest from kept),
ranked as (
  select s.doc_id, s.id, s.size, r.*, s.size > {mix.GRAIN} * r.rest as large,
         (cast('0x' || substr(md5('{mix.SEED}:' || s.id), 1, 13) as bigint) + 0.5) / 4503599627370496.0::double as u
  from sized s join remaining r on s.source is not distinct from r.source),
odds as (
  select *, case when rest > 0 and size > 0 then u / (1 - u) / (
              (rest / source_size) / (1 - rest / source_size) * sqrt(cast(size as double) * n / source_size)) end as q
  from ranked),
ordered as (
  select *, q / (1 + q) as v from odds),
summed as (
  select *, sum(size) over (partition by source, large order by v, id) as through,
         sum(size) over (partition by source, large) as words from ordered where v is not null),
big as (
  select source, sum(size) as got from summed
  where large and 2 * through - size <= 2 * (rest / source_size * words) group by source),
small as (
  select s.doc_id from summed s left join big b on s.source is not distinct from b.source
  where not s.large and 2 * s.through - s.size <= 2 * greatest(s.rest - coalesce(b.got, 0), 0)),
chosen as (
  select doc_id from small
  union all
  select doc_id from summed where large and 2 * through - size <= 2 * (rest / source_size * words))
select r.doc_id, r.size, r.source_size, r.target,
       cast(r.copies + (c.doc_id is not null)::int as bigint) as copies,
       cast(r.size * (r.copies + (c.doc_id is not null)::int) as bigint) as taken
from ranked r left join chosen c on r.doc_id = c.doc_id
"""

_WARC_SQL = f"""
with p as (select page_id, coalesce(html, '') as h from pages),
g as (select h, max(page_id) as m from p where strlen(h) >= {warc.MIN_REVISIT} group by h having count(*) > 1)
select page_id, cast(strlen(p.h) as bigint) as payload_bytes, sha1(p.h) as payload_digest,
       case when m <> page_id then 'revisit' else 'response' end as record_type,
       case when m <> page_id then m end as refers_to
from p left join g on p.h = g.h
"""

def _leaf_sql(*values: str) -> str:
    parts = [f"case when {v} is null then '-' else strlen(({v})::varchar) || ':' || ({v})::varchar end" for v in values]
    return f"sha256({' || '.join(parts)})"


_MERKLE_SQL = f"""
with recursive d as (
  select row_number() over () as r, doc_id, lang, {_leaf_sql(*merkle.FIELDS)} as leaf,
         case when {crc32_sql("doc_id::varchar")} % 3 = 0 then
           {_leaf_sql(*merkle.FIELDS[:-1], "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         end as tampered
  from documents),
placed as (
  select *, coalesce('=' || lang, '-') as tree, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place,
         count(*) over (partition by lang) as n from d),
nodes as (
  select tree, 0 as level, place, n, leaf as digest from placed
  union all
  select tree, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by place))
  from nodes where n > 1 group by tree, level, place // 8, n),
langs as (
  select tree, digest as subroot, row_number() over (order by tree <> '-', tree) - 1 as place, count(*) over () as n
  from nodes where n = 1),
tops as (
  select 0 as level, place, n, subroot as digest from langs
  union all
  select level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' order by place))
  from tops where n > 1 group by level, place // 8, n),
root as (select digest as root from tops where n = 1),
steps as (
  select p.r, 0 as part, s.level, coalesce(string_agg(s.digest, '' order by s.place) filter (s.place < p.place >> 3 * s.level), '') as l,
         coalesce(string_agg(s.digest, '' order by s.place) filter (s.place > p.place >> 3 * s.level), '') as g
  from placed p join nodes s on s.tree = p.tree and s.n > 1 and s.place // 8 = p.place >> 3 * (s.level + 1) group by p.r, s.level
  union all
  select p.r, 1, s.level, coalesce(string_agg(s.digest, '' order by s.place) filter (s.place < t.place >> 3 * s.level), ''),
         coalesce(string_agg(s.digest, '' order by s.place) filter (s.place > t.place >> 3 * s.level), '')
  from placed p join langs t on t.tree = p.tree join tops s on s.n > 1 and s.place // 8 = t.place >> 3 * (s.level + 1)
  group by p.r, s.level),
numbered as (select *, row_number() over (partition by r order by part, level) as step from steps),
folds as (
  select r, 0::bigint as step, coalesce(tampered, leaf) as h from d
  union all
  select f.r, n.step, sha256(n.l || f.h || n.g) from folds f join numbered n on n.r = f.r and n.step = f.step + 1),
folded as (select r, arg_max(h, step) as folded_root from folds group by r),
proof as (select r, sha256(string_agg(l || g, '' order by step)) as proof_sha256 from numbered group by r)
select p.doc_id, p.leaf, t.subroot, root.root, coalesce(q.proof_sha256, sha256('')) as proof_sha256, f.folded_root,
       f.folded_root = root.root as verified
from placed p join langs t on t.tree = p.tree join folded f on f.r = p.r left join proof q on q.r = p.r, root
"""

_TRIE_SQL = f"""
with t as (
  select conv_id, strlen(coalesce(text, '')) as size, turn,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as token
  from conversations where conv_id is not null),
own as (select *, row_number() over (partition by conv_id order by turn nulls first, token) as idx from t),
convs as (select conv_id, {crc32_sql("conv_id::varchar")} % {trie.MOST} as h from (select distinct conv_id from t)),
rebuilt as (
  select c.conv_id, o.idx, o.token, o.size from convs c join own o on o.conv_id = c.conv_id - c.conv_id % {trie.FAMILY} and o.idx <= c.h
  union all
  select c.conv_id, o.idx, o.token, o.size from convs c join own o on o.conv_id = c.conv_id and o.idx > c.h),
prefixes as (
  select conv_id, size, row_number() over w as depth, string_agg(token, '') over w as prefix from rebuilt
  window w as (partition by conv_id order by idx rows between unbounded preceding and current row)
  union all
  select conv_id, 0, 0, '' from convs),
node as (
  select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as saved
  from prefixes group by prefix, depth),
child as (select left(prefix, cast(64 * (depth - 1) as bigint)) as prefix, count(*) as n from node where depth > 0 group by 1),
ended as (
  select prefix, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends
  from (select conv_id, arg_max(prefix, depth) as prefix from prefixes group by conv_id) group by prefix),
sub as (
  select a.prefix, sum(b.saved) as saved, count(*) filter (c.prefix is null) as leaves
  from node a join node b on starts_with(b.prefix, a.prefix) left join child c on c.prefix = b.prefix group by a.prefix)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children, s.leaves as n_leaves,
       cast(s.saved as bigint) as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from node n join sub s on s.prefix = n.prefix left join child c on c.prefix = n.prefix left join ended e on e.prefix = n.prefix
left join node p on n.depth > 0 and p.depth = n.depth - 1 and p.prefix = left(n.prefix, cast(64 * (n.depth - 1) as bigint))
"""

ORACLE: dict[str, str] = {"op1_exact_dedup": _EXACT_SQL, "op3_mix": _MIX_SQL,
                          "op4_licenses": licenses.oracle_sql(), "op8_warc": _WARC_SQL,
                          "op12_merkle": _MERKLE_SQL, "op13_prefix_trie": _TRIE_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
