"""DuckDB text of the canonical views, used only by the correctness oracle.

``with_views(sql)`` prefixes a query with the CTEs it references (dependencies included).
"""

from __future__ import annotations

import re

_PLATFORM = ("case {u} % 4 when 0 then 'Twitter' when 1 then 'Reddit' when 2 then 'Instagram' "
             "else 'LinkedIn' end")
_TOK = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"

VIEWS: dict[str, str] = {
    "posts": f"""
select printf('POST%08d', event_id) as post_id, event_id, user_id,
  {_PLATFORM.format(u='user_id')} as platform,
  'topic_' || cast(k % 10 as varchar) as topic,
  '#t' || cast(k % 10 as varchar) || '_' || cast(k % 5 as varchar) || '|#t' || cast(k % 10 as varchar)
    || '_' || cast((k + 2) % 5 as varchar) as hashtags,
  likes,
  cast(floor(likes * (5 + event_id % 36) / cast(100 as double)) as bigint) as shares,
  cast(floor(likes * (2 + event_id % 29) / cast(100 as double)) as bigint) as comments,
  label as sentiment_label,
  case label when 'positive' then cast(0.65 as double) when 'negative' then cast(-0.65 as double)
    else cast(0.05 as double) end + ((event_id * 7919) % 6001 - 3000) / cast(10000 as double) as sentiment_score,
  ts as posted_at,
  likes + cast(floor(likes * (5 + event_id % 36) / cast(100 as double)) as bigint) > 5000 as is_viral
from (select event_id, user_id, ts, cast(json_extract_string(props, '$.k') as int) as k,
        cast(floor(value * 20) as bigint) as likes,
        case when event_type in ('purchase', 'signup') then 'positive' when event_type = 'error' then 'negative'
          else 'neutral' end as label
      from events) x""",
    "users": f"""
select c_custkey as user_id, c_name as username, {_PLATFORM.format(u='c_custkey')} as platform,
  case when c_custkey % 50 = 0 then null else n_name end as location,
  cast(floor(c_acctbal * c_acctbal / cast(500 as double)) as bigint) as followers,
  50 + (c_custkey * 37) % 4951 as following,
  c_custkey % 20 = 0 as verified, 30 + c_custkey % 3620 as account_age_days,
  ['en', 'es', 'fr', 'de', 'pt'][c_custkey % 5 + 1] as language,
  lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) || '@' || lower(c_mktsegment) || '.com' as email
from customer join nation on c_nationkey = n_nationkey""",
    "api_logs": """
select event_id as log_id, ts as log_ts, case when user_id % 2 = 0 then 'Twitter' else 'Reddit' end as source,
  '/api/' || event_type as endpoint,
  cast(case event_id % 7 when 4 then 429 when 5 then 404 when 6 then 500 else 200 end as bigint) as status_code,
  value as response_time_ms, cast(json_extract_string(props, '$.k') as bigint) as records_fetched,
  event_id % 11 = 3 as rate_limited
from events""",
    "hashtag_trends": """
select cast(posted_at as date) as trend_date, t.tag as hashtag, topic, count(*) as post_count,
  cast(sum(likes) as bigint) as total_likes, cast(sum(shares) as bigint) as total_shares,
  (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment,
  cast(sum(case when is_viral then 1 else 0 end) as bigint) as viral_count
from posts, unnest(string_split(hashtags, '|')) t(tag)
group by cast(posted_at as date), t.tag, topic""",
    "trend_events": """
select event_id, '#trend' || cast(cast(json_extract_string(props, '$.k') as int) % 12 as varchar) as hashtag,
  50 + (event_id * 31) % 4951 as velocity, ts as event_time
from events where event_type = 'view'""",
    "docs": """
select d.doc_id, d.text, d.lang, d.source,
  case l.quality when 1 then 'positive' when 0 then 'negative' else 'neutral' end as sentiment_label
from documents d left join labels l on d.doc_id = l.doc_id""",
    "doc_tokens": f"select doc_id, {_TOK} as tokens from documents",
    "search_queries": f"select item_id as query_id, {_TOK} as tokens from benchmark",
    "posts_with_replays": "select * from posts union all select * from posts where event_id % 97 = 0",
    "users_missing_some": "select * from users where user_id % 37 <> 0",
    # silver tables
    "s_users": """
select * exclude (location, followers), coalesce(location, 'Unknown') as location, followers,
  followers >= 10000 as is_influencer,
  case when followers is null or followers <= 0 then 'nan' when followers <= 1000 then 'Nano'
       when followers <= 10000 then 'Micro' when followers <= 100000 then 'Macro' else 'Mega' end as follower_tier
from users""",
    "s_posts": """
select * exclude (sentiment_score),
  case when sentiment_score is null or isnan(sentiment_score) then sentiment_score
       else least(greatest(sentiment_score, cast(-1 as double)), cast(1 as double)) end as sentiment_score,
  cast(posted_at as date) as post_date, cast(hour(posted_at) as integer) as post_hour,
  dayname(posted_at) as post_weekday, cast(month(posted_at) as integer) as post_month,
  cast(year(posted_at) as integer) as post_year,
  round(likes * cast(1 as double) + shares * cast(3 as double) + comments * cast(2 as double), 2) as engagement_score,
  hour(posted_at) between 18 and 22 as is_prime_time
from posts""",
    "s_hashtag_trends": """
select *, round((total_likes + total_shares * 3) / cast(case when post_count = 0 then 1 else post_count end as double), 2)
  as engagement_index
from hashtag_trends""",
    "s_api_logs": """
select *, status_code >= 400 as is_error, status_code = 429 as is_rate_limited,
  cast(hour(log_ts) as integer) as hour
from api_logs""",
    # warehouse shapes (booleans as integers, as stored)
    "fact_posts": """
select post_id, user_id, platform, topic, sentiment_label, sentiment_score, likes, shares, comments,
  engagement_score, cast(is_viral as integer) as is_viral, cast(is_prime_time as integer) as is_prime_time,
  post_date, post_hour, post_month, post_year
from s_posts""",
    "dim_users": """
select user_id, username, location, followers, following, follower_tier,
  cast(is_influencer as integer) as is_influencer, cast(verified as integer) as verified, account_age_days, language
from s_users""",
    "stg_api_logs": """
select log_id, log_ts, source, endpoint, status_code, response_time_ms, records_fetched,
  cast(is_error as integer) as is_error, cast(is_rate_limited as integer) as is_rate_limited, hour
from s_api_logs""",
    "fact_hashtag_trends": "select * from s_hashtag_trends",
}

_ORDER = list(VIEWS)


def _deps(sql: str) -> set[str]:
    return {v for v in VIEWS if re.search(rf"\b{v}\b", sql)}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the view CTEs it needs, in dependency order."""
    need: set[str] = set()
    todo = list(_deps(sql))
    while todo:
        v = todo.pop()
        if v in need:
            continue
        need.add(v)
        todo.extend(d for d in _deps(VIEWS[v]) if d != v)
    if not need:
        return sql
    ctes = ",\n".join(f"{v} as ({VIEWS[v]}\n)" for v in _ORDER if v in need)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def exact_avg4(x: str, over: str = "") -> str:
    """DuckDB: mean of 4-place decimals rounded to 4 places, ties away from zero, in integer arithmetic."""
    i = f"cast(sum(cast({x} as decimal(18, 4))) {over} * 10000 as bigint)"
    n = f"count({x}) {over}"
    return f"(cast(sign({i}) * ((2 * abs({i}) + {n}) // (2 * {n})) as double) / 10000)"


def exact_avg(x: str, s: int, t: int, over: str = "") -> str:
    """DuckDB: round(avg(x), t) for exact s-place decimal values, ties away from zero, integer arithmetic."""
    i = f"cast(sum(cast({x} as decimal(18, {s}))) {over} * {10 ** s} as hugeint)"
    n = f"count({x}) {over}"
    return (f"(cast(sign({i}) * ((2 * abs({i}) * {10 ** t} + {n} * {10 ** s}) // (2 * {n} * {10 ** s})) as double)"
            f" / {10 ** t})")


def exact_pct(num: str, den: str, t: int) -> str:
    """DuckDB: round(100 * num / den, t) for non-negative integer counts, ties away from zero."""
    return f"(cast((200 * cast({num} as hugeint) * {10 ** t} + ({den})) // (2 * ({den})) as double) / {10 ** t})"
