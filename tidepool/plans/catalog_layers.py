"""Catalog: silver and gold layers."""

from __future__ import annotations


from tidepool.operators import gold
from tidepool.plans.common import hashtag_trends, s_api_logs, s_hashtag_trends, s_posts, s_users
from tidepool.plans.oracle_views import exact_avg4
from tidepool.plans.registry import query
from tidepool.sources import views


@query("silver_users", "select * from s_users")
def q_silver_users(spark, sf):
    return s_users(spark, sf)


@query("silver_posts", "select * from s_posts")
def q_silver_posts(spark, sf):
    return s_posts(spark, sf)


@query("silver_hashtag_trends", "select * from s_hashtag_trends")
def q_silver_hashtag_trends(spark, sf):
    return s_hashtag_trends(spark, sf)


@query("silver_api_logs", "select * from s_api_logs")
def q_silver_api_logs(spark, sf):
    return s_api_logs(spark, sf)


@query("hashtag_trends", "select * from hashtag_trends")
def q_hashtag_trends(spark, sf):
    return views.hashtag_trends(spark, sf)


@query("gold_topic_sentiment", """
select topic, sentiment_label, count(post_id) as post_count, (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
  cast(sum(likes) as bigint) as total_likes, cast(sum(shares) as bigint) as total_shares,
  round(sum(engagement_score), 4) as total_engagement, cast(sum(cast(is_viral as int)) as bigint) as viral_posts
from s_posts where topic is not null and sentiment_label is not null
group by topic, sentiment_label""")
def q_gold_topic_sentiment(spark, sf):
    return gold.topic_sentiment(s_posts(spark, sf))


@query("gold_daily_trend", f"""
with d as (
  select post_date, topic, count(post_id) as posts_count, (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
    round(sum(engagement_score), 4) as total_engagement
  from s_posts where post_date is not null and topic is not null group by post_date, topic)
select *, {exact_avg4("avg_sentiment", "over (partition by topic order by post_date rows between 6 preceding and current row)")}
  as sentiment_7d_avg
from d""")
def q_gold_daily_trend(spark, sf):
    return gold.daily_trend(s_posts(spark, sf))


@query("gold_platform_perf", """
select platform, count(post_id) as total_posts, (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
  cast(sum(likes) as bigint) as total_likes, cast(sum(shares) as bigint) as total_shares,
  cast(sum(cast(is_viral as int)) as bigint) as viral_posts, (cast(sign(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * 10000 + count(engagement_score)  * 1) // (2 * count(engagement_score)  * 1)) as double) / 10000) as avg_engagement
from s_posts where platform is not null group by platform""")
def q_gold_platform_perf(spark, sf):
    return gold.platform_perf(s_posts(spark, sf))


@query("gold_top_influencers", """
select u.user_id, u.username, u.followers, u.follower_tier, p.platform, u.verified, u.location,
  count(p.post_id) as total_posts, round(sum(p.engagement_score), 4) as total_engagement,
  (cast(sign(cast(sum(cast(p.sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(p.sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(p.sentiment_score)  * 10000) // (2 * count(p.sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment, cast(sum(cast(p.is_viral as int)) as bigint) as viral_count
from s_posts p join s_users u on p.user_id = u.user_id
where p.platform is not null and u.username is not null and u.followers is not null
  and u.follower_tier is not null and u.verified is not null and u.location is not null
group by u.user_id, u.username, u.followers, u.follower_tier, p.platform, u.verified, u.location
order by sum(p.engagement_score) desc, u.user_id, p.platform
limit 200""")
def q_gold_top_influencers(spark, sf):
    return gold.top_influencers(s_posts(spark, sf), s_users(spark, sf))


@query("gold_hourly_pattern", """
select post_hour, platform, count(post_id) as post_count, (cast(sign(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * 10000 + count(engagement_score)  * 1) // (2 * count(engagement_score)  * 1)) as double) / 10000) as avg_engagement,
  (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment
from s_posts where post_hour is not null and platform is not null group by post_hour, platform""")
def q_gold_hourly_pattern(spark, sf):
    return gold.hourly_pattern(s_posts(spark, sf))


# ---- data quality --------------------------------------------------------------------------------------

from tidepool.operators import quality as Q  # noqa: E402

# Column lists of the checked datasets (name -> [(column, kind)]), kind: n=integer, f=float, o=other.
_DQ_COLS = {
    "users": [("user_id", "n"), ("username", "o"), ("platform", "o"), ("location", "o"), ("followers", "n"),
              ("following", "n"), ("verified", "o"), ("account_age_days", "n"), ("language", "o"), ("email", "o")],
    "posts": [("post_id", "o"), ("event_id", "n"), ("user_id", "n"), ("platform", "o"), ("topic", "o"),
              ("hashtags", "o"), ("likes", "n"), ("shares", "n"), ("comments", "n"), ("sentiment_label", "o"),
              ("sentiment_score", "f"), ("posted_at", "o"), ("is_viral", "o")],
    "hashtag_trends": [("trend_date", "o"), ("hashtag", "o"), ("topic", "o"), ("post_count", "n"),
                       ("total_likes", "n"), ("total_shares", "n"), ("avg_sentiment", "f"), ("viral_count", "n")],
    "api_logs": [("log_id", "n"), ("log_ts", "o"), ("source", "o"), ("endpoint", "o"), ("status_code", "n"),
                 ("response_time_ms", "f"), ("records_fetched", "n"), ("rate_limited", "o")],
}
_DQ_SRC = {"users": "users", "posts": "posts_with_replays", "hashtag_trends": "hashtag_trends", "api_logs": "api_logs"}
_PK = {"users": "user_id", "posts": "post_id", "api_logs": "log_id"}


def dq_datasets(spark, sf):
    return {"users": views.users(spark, sf), "posts": views.posts_with_replays(spark, sf),
            "hashtag_trends": hashtag_trends(spark, sf), "api_logs": views.api_logs(spark, sf)}


def _sql_nulls():
    parts = []
    for ds, cols in _DQ_COLS.items():
        for c, kind in cols:
            cond = f"{c} is null" + (f" or isnan({c})" if kind == "f" else "")
            parts.append(f"select '{ds}' as dataset, '{c}' as column_name, count(*) filter (where {cond}) as null_count "
                         f"from {_DQ_SRC[ds]}")
    return "select * from (" + "\nunion all ".join(parts) + ") where null_count > 0"


def _sql_dups():
    parts = []
    for ds, cols in _DQ_COLS.items():
        g = ", ".join(c for c, _ in cols)
        parts.append(f"select '{ds}' as dataset, cast(coalesce(sum(n - 1), 0) as bigint) as duplicate_rows "
                     f"from (select count(*) as n from {_DQ_SRC[ds]} group by {g})")
    return "\nunion all ".join(parts)


def _sql_quartiles():
    parts = []
    for ds, cols in _DQ_COLS.items():
        for c, kind in cols:
            if kind == "o":
                continue
            v = f"cast({c} as double)"
            parts.append(f"select '{ds}' as dataset, '{c}' as column_name, quantile_cont({v}, 0.25) as q1, "
                         f"quantile_cont({v}, 0.75) as q3, count({v}) as n from {_DQ_SRC[ds]} "
                         f"where {c} is not null and not isnan({v})")
    return "\nunion all ".join(parts)


def _sql_long():
    parts = []
    for ds, cols in _DQ_COLS.items():
        for c, kind in cols:
            if kind != "o":
                parts.append(f"select '{ds}' as dataset, '{c}' as column_name, cast({c} as double) as value "
                             f"from {_DQ_SRC[ds]} where {c} is not null and not isnan(cast({c} as double))")
    return "\nunion all ".join(parts)


def _sql_outliers():
    return f"""
with q as ({_sql_quartiles()}), l as ({_sql_long()})
select l.dataset, l.column_name,
  cast(count(*) filter (where l.value < q.q1 - 3.0 * (q.q3 - q.q1) or l.value > q.q3 + 3.0 * (q.q3 - q.q1)) as bigint)
    as outliers
from l join q on l.dataset = q.dataset and l.column_name = q.column_name
group by l.dataset, l.column_name
having count(*) filter (where l.value < q.q1 - 3.0 * (q.q3 - q.q1) or l.value > q.q3 + 3.0 * (q.q3 - q.q1)) > 0"""


_SQL_RANGE = """select 'posts' as dataset, 'sentiment_score' as column_name,
  count(*) filter (where sentiment_score < -1 or sentiment_score > 1) as violations from posts_with_replays"""


@query("dq_nulls", _sql_nulls())
def q_dq_nulls(spark, sf):
    return Q.null_counts(dq_datasets(spark, sf))


@query("dq_duplicates", _sql_dups())
def q_dq_duplicates(spark, sf):
    return Q.duplicate_rows(dq_datasets(spark, sf))


@query("dq_quartiles", _sql_quartiles())
def q_dq_quartiles(spark, sf):
    return Q.quartiles(dq_datasets(spark, sf))


@query("dq_outliers", _sql_outliers())
def q_dq_outliers(spark, sf):
    return Q.outliers(dq_datasets(spark, sf))


@query("dq_range", _SQL_RANGE)
def q_dq_range(spark, sf):
    return Q.range_violations(dq_datasets(spark, sf))


@query("dq_summary", f"""
with n as ({_sql_nulls()}), d as ({_sql_dups()}), o as ({_sql_outliers()}), r as ({_SQL_RANGE}),
iss as (select dataset, 'nulls' as chk from n union all select dataset, 'duplicates' from d where duplicate_rows > 0
        union all select dataset, 'outliers' from o union all select dataset, 'range' from r where violations > 0),
ds as (select * from (values ('users'), ('posts'), ('hashtag_trends'), ('api_logs')) t(dataset))
select ds.dataset, cast(count(distinct iss.chk) as bigint) as issue_types
from ds left join iss on ds.dataset = iss.dataset group by ds.dataset""")
def q_dq_summary(spark, sf):
    return Q.issue_summary(dq_datasets(spark, sf))


@query("dq_pk", "\nunion all ".join(
    f"select '{ds}' as dataset, '{k}' as key_column, cast(count(*) as bigint) as duplicate_keys, "
    f"cast(coalesce(sum(n - 1), 0) as bigint) as extra_rows "
    f"from (select {k}, count(*) as n from {_DQ_SRC[ds]} group by {k} having count(*) > 1)"
    for ds, k in _PK.items()))
def q_dq_pk(spark, sf):
    return Q.primary_key_violations(dq_datasets(spark, sf), _PK)


@query("dq_orphans", """
select p.post_id, p.user_id from posts p where not exists (select 1 from users_missing_some u where u.user_id = p.user_id)""")
def q_dq_orphans(spark, sf):
    return Q.orphans(views.posts(spark, sf), views.users_missing_some(spark, sf), "user_id", "post_id")


@query("dq_report_lines", f"""
with n as ({_sql_nulls()}), d as ({_sql_dups()}), o as ({_sql_outliers()}), r as ({_SQL_RANGE}),
iss as (select dataset, 'nulls' as chk, column_name, null_count as n from n
        union all select dataset, 'duplicates', null, duplicate_rows from d where duplicate_rows > 0
        union all select dataset, 'outliers', column_name, outliers from o
        union all select dataset, 'sentiment_range_violation', column_name, violations from r where violations > 0),
ds as (select * from (values ('users'), ('posts'), ('hashtag_trends'), ('api_logs')) t(dataset)),
body as (select dataset, '  WARN  ' || chk || coalesce('.' || column_name, '') || ': ' || cast(n as varchar) as line
         from iss
         union all select dataset, '  OK    No issues found.' from ds
         where dataset not in (select dataset from iss))
select dataset, 0 as line_no, '[' || upper(dataset) || ']' as line from ds
union all
select dataset, cast(row_number() over (partition by dataset order by line) as integer), line from body""")
def q_dq_report_lines(spark, sf):
    return Q.report_lines(dq_datasets(spark, sf))
