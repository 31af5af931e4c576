"""Catalog: warehouse tables, named views, KPIs, reports, panels, global windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import analytics as A
from tidepool.operators import ranking
from tidepool.plans.common import s_api_logs, s_hashtag_trends, s_posts, s_users
from tidepool.plans.oracle_views import exact_avg4
from tidepool.plans.registry import query
from tidepool.sources import views
from tidepool.sources import warehouse as W


def _fact(spark, sf):
    return W.fact_posts(s_posts(spark, sf))


def _dim_users(spark, sf):
    return W.dim_users(s_users(spark, sf))


def _tables(spark, sf):
    return {"fact_posts": _fact(spark, sf), "dim_users": _dim_users(spark, sf),
            "stg_api_logs": W.stg_api_logs(s_api_logs(spark, sf)),
            "fact_hashtag_trends": W.fact_hashtag_trends(s_hashtag_trends(spark, sf))}


@query("wh_fact_posts", "select * from fact_posts")
def q_wh_fact_posts(spark, sf):
    return _fact(spark, sf)


@query("wh_dim_users", "select * from dim_users")
def q_wh_dim_users(spark, sf):
    return _dim_users(spark, sf)


@query("dim_date", """
select strftime(d, '%Y-%m-%d') as date_id, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
  cast(day(d) as integer) as day, dayname(d) as weekday, cast(isodow(d) >= 6 as integer) as is_weekend
from (select unnest(generate_series(min(post_date), max(post_date), interval 1 day))::date as d from s_posts)""")
def q_dim_date(spark, sf):
    return W.dim_date(s_posts(spark, sf))


@query("dim_topics", """
select row_number() over (order by topic_name) as topic_id, topic_name, cast(null as varchar) as category
from (select distinct topic as topic_name from posts where topic is not null)""")
def q_dim_topics(spark, sf):
    return W.dim_topics(views.posts(spark, sf))


@query("vw_topic_sentiment_rank", """
select topic, sentiment_label, count(*) as post_count, (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
  cast(sum(likes) as bigint) as total_likes, cast(sum(is_viral) as bigint) as viral_posts,
  cast(rank() over (partition by sentiment_label order by count(*) desc) as bigint) as topic_rank
from fact_posts group by topic, sentiment_label""")
def q_vw_topic_sentiment_rank(spark, sf):
    return A.run_view("vw_topic_sentiment_rank", _tables(spark, sf))


@query("vw_influencer_impact", """
with base as (
  select p.user_id, u.username, u.followers, u.follower_tier, count(p.post_id) as total_posts,
    sum(p.engagement_score) as total_engagement, (cast(sign(cast(sum(cast(p.sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(p.sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(p.sentiment_score)  * 10000) // (2 * count(p.sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
    cast(sum(p.is_viral) as bigint) as viral_count
  from fact_posts p join dim_users u on p.user_id = u.user_id
  group by p.user_id, u.username, u.followers, u.follower_tier)
select *, cast(ntile(4) over (order by total_engagement desc, user_id) as bigint) as engagement_quartile,
  cast(rank() over (order by viral_count desc) as bigint) as viral_rank
from base order by total_engagement desc, user_id limit 100""")
def q_vw_influencer_impact(spark, sf):
    t = _tables(spark, sf)
    return A.influencer_impact(t["fact_posts"], t["dim_users"])


@query("vw_daily_sentiment_trend", """
select post_date, topic, count(*) as daily_posts, (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
  cast(sum(likes) as bigint) as total_likes, cast(sum(is_viral) as bigint) as viral_count,
  round(sum(sum(engagement_score)) over (partition by topic order by post_date
        rows between 6 preceding and current row) / cast(7 as double), 2) as engagement_7d_avg
from fact_posts group by post_date, topic""")
def q_vw_daily_sentiment_trend(spark, sf):
    return A.run_view("vw_daily_sentiment_trend", _tables(spark, sf))


@query("vw_platform_health", """
select source, count(*) as total_calls, cast(sum(is_error) as bigint) as error_count,
  (cast((200 * cast(sum(is_error) as hugeint) * 100 + (count(*))) // (2 * (count(*))) as double) / 100) as error_rate_pct,
  cast(sum(is_rate_limited) as bigint) as rate_limit_hits, (cast(sign(cast(sum(cast(response_time_ms as decimal(18, 2)))  * 100 as hugeint)) * ((2 * abs(cast(sum(cast(response_time_ms as decimal(18, 2)))  * 100 as hugeint)) * 10 + count(response_time_ms)  * 100) // (2 * count(response_time_ms)  * 100)) as double) / 10) as avg_latency_ms,
  (cast(sign(cast(sum(cast(records_fetched as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(records_fetched as decimal(18, 0)))  * 1 as hugeint)) * 10 + count(records_fetched)  * 1) // (2 * count(records_fetched)  * 1)) as double) / 10) as avg_records_per_call
from stg_api_logs group by source""")
def q_vw_platform_health(spark, sf):
    return A.run_view("vw_platform_health", _tables(spark, sf))


@query("vw_viral_content_analysis", """
select platform, topic, sentiment_label, count(case when is_viral = 1 then 1 end) as viral_posts,
  count(*) as total_posts,
  (cast((200 * cast(count(case when is_viral = 1 then 1 end) as hugeint) * 100 + (count(*))) // (2 * (count(*))) as double) / 100) as viral_rate_pct,
  (cast(sign(cast(sum(cast(case when is_viral = 1 then engagement_score end as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(case when is_viral = 1 then engagement_score end as decimal(18, 0)))  * 1 as hugeint)) * 100 + count(case when is_viral = 1 then engagement_score end)  * 1) // (2 * count(case when is_viral = 1 then engagement_score end)  * 1)) as double) / 100) as avg_viral_engagement
from fact_posts group by platform, topic, sentiment_label""")
def q_vw_viral_content_analysis(spark, sf):
    return A.run_view("vw_viral_content_analysis", _tables(spark, sf))


@query("kpis", """
select count(*) as total_posts, count(distinct user_id) as unique_users, cast(sum(likes) as bigint) as total_likes,
  cast(sum(shares) as bigint) as total_shares, cast(sum(is_viral) as bigint) as viral_posts,
  (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as overall_sentiment, (cast(sign(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * 100 + count(engagement_score)  * 1) // (2 * count(engagement_score)  * 1)) as double) / 100) as avg_engagement,
  cast(sum(case when sentiment_label = 'positive' then 1 else 0 end) as bigint) as positive_posts,
  cast(sum(case when sentiment_label = 'negative' then 1 else 0 end) as bigint) as negative_posts,
  cast(sum(case when sentiment_label = 'neutral' then 1 else 0 end) as bigint) as neutral_posts
from fact_posts""")
def q_kpis(spark, sf):
    return A.kpis(_fact(spark, sf))


_VELOCITY = f"""
select hashtag, topic, cast(sum(post_count) as bigint) as total_posts, cast(sum(total_likes) as bigint) as total_likes,
  cast(sum(total_shares) as bigint) as total_shares, {exact_avg4("avg_sentiment")} as avg_sentiment,
  cast(sum(viral_count) as bigint) as total_viral,
  cast(rank() over (order by sum(post_count) desc) as bigint) as trend_rank
from fact_hashtag_trends group by hashtag, topic
order by total_posts desc, hashtag, topic limit 30"""


@query("hashtag_velocity", _VELOCITY)
def q_hashtag_velocity(spark, sf):
    return A.hashtag_velocity(W.fact_hashtag_trends(s_hashtag_trends(spark, sf)))


@query("user_segment", f"""
with user_stats as (
  select user_id, count(*) as post_count, (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
    sum(engagement_score) as total_engagement, sum(is_viral) as viral_posts
  from fact_posts group by user_id)
select u.follower_tier, count(distinct u.user_id) as user_count, (cast(sign(cast(sum(cast(s.post_count as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(s.post_count as decimal(18, 0)))  * 1 as hugeint)) * 10 + count(s.post_count)  * 1) // (2 * count(s.post_count)  * 1)) as double) / 10) as avg_posts,
  (cast(sign(cast(sum(cast(s.total_engagement as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(s.total_engagement as decimal(18, 0)))  * 1 as hugeint)) * 100 + count(s.total_engagement)  * 1) // (2 * count(s.total_engagement)  * 1)) as double) / 100) as avg_engagement, {exact_avg4("s.avg_sentiment")} as avg_sentiment,
  cast(sum(s.viral_posts) as bigint) as total_viral
from dim_users u join user_stats s on u.user_id = s.user_id group by u.follower_tier""")
def q_user_segment(spark, sf):
    return A.user_segment(_fact(spark, sf), _dim_users(spark, sf))


@query("primetime", """
select post_hour, platform, count(*) as posts, (cast(sign(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * 100 + count(engagement_score)  * 1) // (2 * count(engagement_score)  * 1)) as double) / 100) as avg_engagement,
  (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
  (cast((200 * cast(sum(is_viral) as hugeint) * 100 + (count(*))) // (2 * (count(*))) as double) / 100) as viral_rate_pct
from fact_posts group by post_hour, platform""")
def q_primetime(spark, sf):
    return A.primetime(_fact(spark, sf))


@query("panel_daily_trend", """
with d as (select post_date, (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment, count(*) as posts
           from fact_posts group by post_date)
select *, round(avg(avg_sentiment) over (order by post_date rows between 6 preceding and current row), 8)
  as rolling_7 from d""")
def q_panel_daily_trend(spark, sf):
    return A.panel_daily_trend(_fact(spark, sf))


@query("panel_label_share", """
with c as (select sentiment_label, count(*) as posts from fact_posts group by sentiment_label)
select *, (cast((200 * cast(posts as hugeint) * 10 + (sum(posts) over ())) // (2 * (sum(posts) over ())) as double) / 10) as share_pct from c""")
def q_panel_label_share(spark, sf):
    return A.panel_label_share(_fact(spark, sf))


@query("panel_topic_pivot", """
select topic, count(*) filter (where sentiment_label = 'negative') as negative,
  count(*) filter (where sentiment_label = 'neutral') as neutral,
  count(*) filter (where sentiment_label = 'positive') as positive
from fact_posts group by topic""")
def q_panel_topic_pivot(spark, sf):
    return A.panel_topic_pivot(_fact(spark, sf))


@query("panel_platform", """
select platform, (cast(sign(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * ((2 * abs(cast(sum(cast(engagement_score as decimal(18, 0)))  * 1 as hugeint)) * 100 + count(engagement_score)  * 1) // (2 * count(engagement_score)  * 1)) as double) / 100) as avg_eng, count(*) as posts from fact_posts group by platform""")
def q_panel_platform(spark, sf):
    return A.panel_platform(_fact(spark, sf))


@query("panel_top_hashtags", f"""
with v as ({_VELOCITY})
select *, case when avg_sentiment < 0 then 'negative' when avg_sentiment > 0 then 'positive' else 'neutral' end
  as sentiment_class
from v order by total_posts desc, hashtag, topic limit 10""")
def q_panel_top_hashtags(spark, sf):
    return A.panel_top_hashtags(A.hashtag_velocity(W.fact_hashtag_trends(s_hashtag_trends(spark, sf))))


@query("panel_hourly", """
select post_hour, count(*) as posts, post_hour between 18 and 22 as is_prime_time from fact_posts group by post_hour""")
def q_panel_hourly(spark, sf):
    return A.panel_hourly(_fact(spark, sf))


@query("panel_api_health", """
with a as (select endpoint, (cast((200 * cast(sum(is_error) as hugeint) * 10 + (count(*))) // (2 * (count(*))) as double) / 10) as error_pct,
             (cast(sign(cast(sum(cast(response_time_ms as decimal(18, 2)))  * 100 as hugeint)) * ((2 * abs(cast(sum(cast(response_time_ms as decimal(18, 2)))  * 100 as hugeint)) * 1 + count(response_time_ms)  * 100) // (2 * count(response_time_ms)  * 100)) as double) / 1) as avg_ms from stg_api_logs group by endpoint)
select *, case when error_pct > 20 then 'critical' when error_pct > 10 then 'warning' else 'ok' end as severity from a""")
def q_panel_api_health(spark, sf):
    return A.panel_api_health(W.stg_api_logs(s_api_logs(spark, sf)))


@query("post_stats", """
select count(*) as total_posts, cast(sum(cast(is_viral as int)) as bigint) as viral_posts,
  (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as sentiment_mean, round(stddev_pop(sentiment_score), 4) as sentiment_std,
  cast(sum(case when sentiment_label = 'positive' then 1 else 0 end) as bigint) as positive_posts,
  cast(sum(case when sentiment_label = 'negative' then 1 else 0 end) as bigint) as negative_posts
from posts""")
def q_post_stats(spark, sf):
    return A.post_stats(views.posts(spark, sf))


@query("global_rank", """
select post_id, likes, cast(rank() over (order by likes desc) as bigint) as likes_rank from posts""")
def q_global_rank(spark, sf):
    p = views.posts(spark, sf).select("post_id", "likes")
    r = ranking.global_rank(p, "likes", descending=True, tiebreak=["post_id"], out="likes_rank")
    return r.select("post_id", "likes", F.col("likes_rank").cast("bigint").alias("likes_rank"))


@query("global_ntile", """
select post_id, likes, cast(ntile(7) over (order by likes desc, post_id) as bigint) as likes_ntile from posts""")
def q_global_ntile(spark, sf):
    p = views.posts(spark, sf).select("post_id", "likes")
    return ranking.global_ntile(p, 7, [F.col("likes").desc(), F.col("post_id")], out="likes_ntile")
