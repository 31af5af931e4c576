"""Catalog: text standardising, masking, lexicon sentiment, inverted index and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import columns as C
from tidepool.functions.text import DEFAULT_NEGATIVE_WORDS, DEFAULT_POSITIVE_WORDS, standardise_text
from tidepool.operators import analytics as A
from tidepool.operators import search as S
from tidepool.plans.common import once
from tidepool.plans.registry import query
from tidepool.sources import views
from tidepool.sources.tables import read_table

_POS = ", ".join(f"'{w}'" for w in DEFAULT_POSITIVE_WORDS)
_NEG = ", ".join(f"'{w}'" for w in DEFAULT_NEGATIVE_WORDS)

# DuckDB form of the lexicon classifier over doc_tokens (tokens) -> nlp_* columns.
_SQL_SCORED = f"""
scored as (
  select d.doc_id, d.lang, d.source, d.sentiment_label, pos, neg,
    case when pos > neg then 'positive' when neg > pos then 'negative' else 'neutral' end as nlp_label,
    round(case when pos > neg then least(pos / (pos + neg + 1e-9), 1.0)
               when neg > pos then -least(neg / (pos + neg + 1e-9), 1.0) else 0.05 end, 4) as nlp_score,
    round(least(abs(pos - neg) / (pos + neg + 1e-9), 1.0), 4) as nlp_confidence
  from (select doc_id, len(list_filter(tokens, lambda t: list_contains([{_POS}], t))) as pos,
               len(list_filter(tokens, lambda t: list_contains([{_NEG}], t))) as neg
        from doc_tokens) c join docs d on c.doc_id = d.doc_id)"""


def _scored(spark, sf):
    return S.score_documents(views.docs(spark, sf, dealt=True), DEFAULT_POSITIVE_WORDS, DEFAULT_NEGATIVE_WORDS)


@query("tokenize", "select doc_id, tokens from doc_tokens")
def q_tokenize(spark, sf):
    return views.doc_tokens(spark, sf)


@query("standardise_text", """
select doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) as text_std from documents""")
def q_standardise_text(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", standardise_text(F.col("text")).alias("text_std"))


@query("scan_projection", "select doc_id, lang, source, n_chars from documents")
def q_scan_projection(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")


@query("mask_email", """
select user_id, email, case when regexp_matches(email, '^[^@][^@]*@[^@]+$')
  then regexp_replace(email, '^([^@])[^@]*@([^@]+)$', '\\1***@\\2') end as email_masked from users""")
def q_mask_email(spark, sf):
    u = views.users(spark, sf)
    return u.select("user_id", "email", C.mask_email(F.col("email")).alias("email_masked"))


@query("mask_audit", """
select count(*) filter (where email_masked is null or not contains(email_masked, '***')) as unmasked,
  count(*) as checked
from (select regexp_replace(email, '^([^@])[^@]*@([^@]+)$', '\\1***@\\2') as email_masked from users)""")
def q_mask_audit(spark, sf):
    u = views.users(spark, sf).select(C.mask_email(F.col("email")).alias("m"))
    return u.agg(F.count_if(F.col("m").isNull() | ~F.col("m").contains("***")).alias("unmasked"),
                 F.count(F.lit(1)).alias("checked"))


_PHONE_SQL = ("printf('%03d-%03d-%04d', c_custkey % 1000, (c_custkey * 7) % 1000, (c_custkey * 13) % 10000)")


@query("mask_phone", f"""
select c_custkey as user_id, {_PHONE_SQL} as phone,
  regexp_replace(left({_PHONE_SQL}, length({_PHONE_SQL}) - 2), '[0-9]', '*', 'g') || right({_PHONE_SQL}, 2)
    as phone_masked
from customer""")
def q_mask_phone(spark, sf):
    c = read_table(spark, sf, "customer")
    k = F.col("c_custkey")
    phone = F.format_string("%03d-%03d-%04d", k % 1000, (k * 7) % 1000, (k * 13) % 10000)
    return c.select(k.alias("user_id"), phone.alias("phone"), C.mask_phone(phone).alias("phone_masked"))


@query("nlp_sentiment", f"with {_SQL_SCORED} select doc_id, nlp_label, nlp_score, nlp_confidence from scored")
def q_nlp_sentiment(spark, sf):
    return _scored(spark, sf).select("doc_id", "nlp_label", "nlp_score", "nlp_confidence")


@query("nlp_batch", f"""
with {_SQL_SCORED}
select doc_id, lang, source, sentiment_label, nlp_label, nlp_score, nlp_confidence from scored""")
def q_nlp_batch(spark, sf):
    return _scored(spark, sf).select("doc_id", "lang", "source", "sentiment_label", "nlp_label", "nlp_score",
                                     "nlp_confidence")


@query("nlp_agreement", f"""
with {_SQL_SCORED}
select count(*) as docs, count(*) filter (where sentiment_label = nlp_label) as agreeing,
  (cast((2 * count(*) filter (where sentiment_label = nlp_label) * 10000 + count(*)) // (2 * count(*)) as double) / 10000) as agreement_rate from scored""")
def q_nlp_agreement(spark, sf):
    return S.agreement(_scored(spark, sf))


@query("nlp_confusion", f"""
with {_SQL_SCORED}
select sentiment_label, nlp_label, count(*) as docs from scored group by sentiment_label, nlp_label""")
def q_nlp_confusion(spark, sf):
    return S.confusion(_scored(spark, sf))


@query("label_domain_check", f"""
with {_SQL_SCORED}
select count(*) as violations from scored where nlp_label not in ('positive', 'negative', 'neutral')""")
def q_label_domain_check(spark, sf):
    return S.label_domain_violations(_scored(spark, sf), ["positive", "negative", "neutral"])


@query("panel_confidence_hist", f"""
with {_SQL_SCORED},
b as (select nlp_label, case when min(nlp_confidence) = max(nlp_confidence) then min(nlp_confidence) - 0.5
                             else min(nlp_confidence) end as lo,
             case when min(nlp_confidence) = max(nlp_confidence) then max(nlp_confidence) + 0.5
                  else max(nlp_confidence) end as hi
      from scored group by nlp_label),
h as (select s.nlp_label, cast(least(floor((s.nlp_confidence - b.lo) / ((b.hi - b.lo) / 30.0)), 29) as bigint) as bin,
        b.lo, b.hi
      from scored s join b on s.nlp_label = b.nlp_label)
select nlp_label, bin, round(lo + bin * (hi - lo) / 30, 6) as bin_lo, round(lo + (bin + 1) * (hi - lo) / 30, 6) as bin_hi,
  count(*) as count
from h group by nlp_label, bin, lo, hi""")
def q_panel_confidence_hist(spark, sf):
    return A.confidence_histogram(_scored(spark, sf))


def _index(spark, sf):
    """The stored index: postings and document frequencies, built once from one tokenising pass."""
    post = once(spark, sf, "postings", lambda s, d: S.postings(views.doc_tokens(s, d)), ("documents",))
    return post, once(spark, sf, "term-df", lambda s, d: S.document_frequency(post), ("documents",))


_SQL_POSTINGS = "postings as (select distinct doc_id, unnest(list_distinct(tokens)) as term from doc_tokens)"


@query("postings", f"with {_SQL_POSTINGS} select term, doc_id from postings")
def q_postings(spark, sf):
    return S.postings(views.doc_tokens(spark, sf))


@query("index_stats", f"""
with {_SQL_POSTINGS}
select 'doc_count' as stat, (select count(*) from doc_tokens) as value
union all select 'unique_terms', (select count(distinct term) from postings)
union all select 'postings', (select count(*) from postings)""")
def q_index_stats(spark, sf):
    post, _ = _index(spark, sf)
    return S.index_stats(post, read_table(spark, sf, "documents"))


@query("top_terms", f"""
with {_SQL_POSTINGS}
select term, count(*) as df from postings group by term order by df desc, term limit 20""")
def q_top_terms(spark, sf):
    _, df = _index(spark, sf)
    return S.top_terms(df)


SEARCH_SQL = f"""
with {_SQL_POSTINGS},
n as (select count(*) as n from doc_tokens),
idf as (select term, ln((select n from n) / (count(*) + 1)) + 1 as idf from postings group by term),
qt as (select query_id, term, count(*) as qtf from (select query_id, unnest(tokens) as term from search_queries)
       group by query_id, term),
hits as (select qt.query_id, p.doc_id, sum(qt.qtf * idf.idf) as score
         from qt join idf on qt.term = idf.term join postings p on p.term = qt.term group by qt.query_id, p.doc_id),
r as (select *, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rank from hits)
select r.query_id, r.rank, r.doc_id, round(r.score, 4) as relevance_score, d.lang, d.source, d.sentiment_label
from r join docs d on r.doc_id = d.doc_id where r.rank <= 10"""


@query("search_topk", SEARCH_SQL)
def q_search_topk(spark, sf):
    n_docs = read_table(spark, sf, "documents").count()  # N: answered from the Parquet footers
    post, df = _index(spark, sf)
    hits = S.search(views.search_queries(spark, sf), post, n_docs, k=10, df=df)
    docs = views.docs(spark, sf).select("doc_id", "lang", "source", "sentiment_label")
    # at most k rows per query on the left: the join fetches the document fields for the hits only
    return hits.join(docs, "doc_id").select("query_id", "rank", "doc_id", "relevance_score", "lang", "source",
                                            "sentiment_label")
