"""Catalog: CSV with inferred types, repeatable loads, catalog tables, SQL text over views, an index that grows."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidepool.operators import analytics as A
from tidepool.operators import sql as Q
from tidepool.operators.index import Index
from tidepool.plans.catalog_analytics import _tables
from tidepool.plans.catalog_text import SEARCH_SQL
from tidepool.plans.common import s_posts
from tidepool.plans.oracle_views import exact_avg4
from tidepool.plans.registry import query
from tidepool.session import scratch_path
from tidepool.sources import csv_scan, loads, star, views
from tidepool.sources import warehouse as W

# ---- headered CSV, types inferred ---------------------------------------------------------------------

TOLERANCE = 0.05
_CSV_COLUMNS = ["post_id", "user_id", "platform", "likes", "sentiment_score", "is_viral", "posted_at", "note"]


def _export(spark, sf):
    """Posts as headered CSV. Every 97th has a word for its likes; the note is there in every third alone."""
    eid = F.col("event_id")
    p = views.posts(spark, sf).select(
        "post_id", "user_id", "platform",
        F.when(eid % 97 == 0, "n/a").otherwise(F.col("likes").cast("string")).alias("likes"), "sentiment_score", "is_viral",
        F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("posted_at"),
        F.when(eid % 3 == 0, F.concat(F.lit('said "so", '), F.col("topic"))).alias("note"))
    path = scratch_path(spark, "posts-csv")
    p.write.option("header", True).option("emptyValue", "").option("escape", '"').csv(path)
    return path


@query("scan_csv_inferred", """
select post_id, user_id, platform, likes, sentiment_score, is_viral, posted_at,
  case when event_id % 3 = 0 then 'said "so", ' || topic end as note
from posts where event_id % 97 <> 0""")
def q_scan_csv_inferred(spark, sf):
    """Types of all columns from all rows: whole numbers, reals, booleans, timestamps, text; empty cells null."""
    return csv_scan.read_csv(spark, _export(spark, sf), TOLERANCE).rows


@query("scan_csv_quarantine", """
select 'likes' as bad_columns, post_id, 'bigint' as inferred from posts where event_id % 97 = 0""")
def q_scan_csv_quarantine(spark, sf):
    """Rows whose cell is not of its column's type, set aside with their text."""
    scan = csv_scan.read_csv(spark, _export(spark, sf), TOLERANCE)
    kind = scan.schema["likes"].dataType.simpleString()
    return scan.quarantine.select("bad_columns", F.split("record", ",")[0].alias("post_id"), F.lit(kind).alias("inferred"))


# ---- loads ----------------------------------------------------------------------------------------------

_LOADED = ["post_id", "user_id", "likes", "post_date"]


@query("load_replace", """
with d as (select min(post_date) as first from fact_posts)
select cast(post_date as varchar) as post_date, count(*) as posts,
  cast(sum(likes + case when post_date = d.first then 1 else 0 end) as bigint) as likes
from fact_posts, d group by post_date""")
def q_load_replace(spark, sf):
    """A full load; one that fails midway and leaves it as it was; a reload of one date, run twice. Dates are stored as text."""
    fact = W.fact_posts(s_posts(spark, sf)).select(*_LOADED[:-1], F.col("post_date").cast("string").alias("post_date"))
    root = scratch_path(spark, "fact-load")
    loads.replace_table(fact, root, ["post_date"])
    broken = fact.withColumn("likes", F.when(F.col("likes") >= 0, F.raise_error(F.lit("source broke off")).cast("long")))
    try:
        loads.replace_table(broken, root, ["post_date"])
    except PySparkException:
        pass  # meant to fail: readers stay on the load before
    first = fact.agg(F.min("post_date")).first()[0]
    again = fact.where(F.col("post_date") == F.lit(first)).withColumn("likes", F.col("likes") + 1)
    for _ in range(2):
        loads.replace_partitions(again, root, ["post_date"])
    stored = loads.read_table(spark, root)
    return stored.groupBy(F.col("post_date").cast("string").alias("post_date")).agg(
        F.count(F.lit(1)).alias("posts"), F.sum("likes").cast("long").alias("likes"))


# ---- star schema as catalog tables ----------------------------------------------------------------------

def star_tables(spark, sf):
    posts = s_posts(spark, sf)
    return star.create_tables(spark, {**_tables(spark, sf), "dim_date": W.dim_date(posts), "dim_topics": W.dim_topics(posts)})


def _star_row(table: str, source: str, columns: str, key: str | None, orphans: str = "0") -> str:
    bad = "0" if key is None else f"count(*) - count(distinct {key})"
    return f"""select '{table}' as "table", '{columns}' as columns, count(*) as rows, {bad} as key_violations,
  cast(({orphans}) as bigint) as orphans from {source}"""


_DIM_DATES = """(select unnest(generate_series(min(post_date), max(post_date), interval 1 day))::date as date_id from s_posts)"""
_SQL_STAR = "\nunion all ".join([
    _star_row("fact_posts", "fact_posts", ",".join(W.FACT_POST_COLUMNS), "post_id",
              "select count(*) from fact_posts f where not exists (select 1 from dim_users u where u.user_id = f.user_id)"),
    _star_row("dim_users", "dim_users", ",".join(W.DIM_USER_COLUMNS), "user_id"),
    _star_row("stg_api_logs", "stg_api_logs", ",".join(W.STG_API_COLUMNS), "log_id"),
    _star_row("fact_hashtag_trends", "s_hashtag_trends",
              "trend_date,hashtag,topic,post_count,total_likes,total_shares,avg_sentiment,viral_count,engagement_index", None),
    _star_row("dim_date", _DIM_DATES, "date_id,year,month,day,weekday,is_weekend", "date_id"),
    _star_row("dim_topics", "(select distinct topic as topic_id from posts where topic is not null)", "topic_id,topic_name,category",
              "topic_id")])


@query("star_schema_tables", _SQL_STAR)
def q_star_schema_tables(spark, sf):
    return star.describe(spark, star_tables(spark, sf))


@query("star_join", """
select u.follower_tier, count(*) as posts, cast(sum(f.likes) as bigint) as likes
from fact_posts f join dim_users u on f.user_id = u.user_id group by u.follower_tier""")
def q_star_join(spark, sf):
    """Fact ⋈ dimension over the bucketed catalog tables."""
    joined = star.posts_with_users(spark, star_tables(spark, sf))
    return joined.groupBy("follower_tier").agg(F.count(F.lit(1)).alias("posts"), F.sum("likes").cast("long").alias("likes"))


# ---- SQL text over registered views -----------------------------------------------------------------------

STATEMENTS = {
    "leading_topics": Q.Statement(
        "select topic, sentiment_label, post_count, avg_sentiment from vw_topic_sentiment_rank where topic_rank <= :top",
        {"top": 3}),
    "failing_sources": Q.Statement(
        "select source, error_rate_pct from vw_platform_health where error_rate_pct >= :least order by error_rate_pct desc",
        {"least": 0.0}),
    "lost_view": Q.Statement("select * from vw_not_there"),
}

_SQL_RANKED = f"""
ranked as (select topic, sentiment_label, count(*) as post_count, {exact_avg4('sentiment_score')} as avg_sentiment,
             rank() over (partition by sentiment_label order by count(*) desc) as topic_rank
           from fact_posts group by topic, sentiment_label)"""


def _run_statements(spark, sf):
    A.run_named_views(spark, _tables(spark, sf))
    return Q.run_statements(spark, STATEMENTS)


@query("sql_named_views", f"""
with {_SQL_RANKED.strip()}
select topic, sentiment_label, post_count, avg_sentiment from ranked where topic_rank <= 3""")
def q_sql_named_views(spark, sf):
    """A statement over the registered views, its limit a parameter."""
    frames, _ = _run_statements(spark, sf)
    return frames["leading_topics"]


@query("sql_view_status", f"""
with {_SQL_RANKED.strip()}
select 'leading_topics' as statement, true as ok, cast(null as varchar) as error, (select count(*) from ranked where topic_rank <= 3) as rows
union all select 'failing_sources', true, null, (select count(distinct source) from stg_api_logs)
union all select 'lost_view', false, 'TABLE_OR_VIEW_NOT_FOUND', null""")
def q_sql_view_status(spark, sf):
    """Every statement's outcome; the one over a missing view is recorded, the others run."""
    return Q.with_counts(*_run_statements(spark, sf))


# ---- an index that takes new documents --------------------------------------------------------------------

@query("search_incremental", SEARCH_SQL)
def q_search_incremental(spark, sf):
    """Half of the documents indexed, then all of them handed over (the known half is left out), then searched over both segments."""
    tokens = views.doc_tokens(spark, sf)
    index = Index(spark, scratch_path(spark, "index"))
    index.add(tokens.where(F.col("doc_id") % 2 == 0))
    index.add(tokens)
    hits = index.search(views.search_queries(spark, sf), k=10)
    docs = views.docs(spark, sf).select("doc_id", "lang", "source", "sentiment_label")
    return hits.join(docs, "doc_id").select("query_id", "rank", "doc_id", "relevance_score", "lang", "source", "sentiment_label")
