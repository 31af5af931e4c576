"""Catalog: topic routing / offsets / lag (batch), replayed stream windows, and Structured Streaming jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators import alerts as AL
from tidepool.operators import routing as R
from tidepool.plans import registry
from tidepool.plans.registry import query
from tidepool.session import scratch_path
from tidepool.sources import views
from tidepool.sources.tables import read_table
from tidepool.streaming import jobs as J

POST_PARTITIONS, TREND_PARTITIONS = 4, 2
READ_FROM, READ_LIMIT = 100, 200
# Reference threshold is -0.5; on the driver's data that raises nothing, so the checked keys use -0.1.
CHECK_THRESHOLD = -0.1
DELAY = dt.timedelta(minutes=10)


def _md5_mod_sql(key: str, n: int) -> str:
    r = "cast(0 as bigint)"
    for i in range(4):
        chunk = f"cast(('0x' || substring(md5(cast({key} as varchar)), {8 * i + 1}, 8)) as bigint)"
        r = f"(({r}) * 4294967296 + {chunk}) % {n}"
    return f"cast({r} as integer)"


_SQL_TOPIC = f"""
topic as (select post_id, event_id, posted_at, {_md5_mod_sql('post_id', POST_PARTITIONS)} as partition from posts),
logged as (select *, row_number() over (partition by partition order by posted_at, event_id) - 1 as "offset" from topic)"""


def posts_topic(spark, sf):
    """The social-posts topic: every post as a message keyed by post_id, md5-routed to 4 partitions."""
    p = views.posts(spark, sf).select("post_id", "event_id", "posted_at")
    return R.with_offsets(R.route(p, "post_id", POST_PARTITIONS), ["posted_at", "event_id"])


@query("route_partition", f"""
select post_id, {_md5_mod_sql('post_id', POST_PARTITIONS)} as partition,
  {_md5_mod_sql('post_id', 7)} as partition_of_7 from posts""")
def q_route_partition(spark, sf):
    p = views.posts(spark, sf).select("post_id")
    return R.route(R.route(p, "post_id", POST_PARTITIONS), "post_id", 7, out="partition_of_7")


@query("partition_offsets", f'with {_SQL_TOPIC} select post_id, partition, "offset" from logged')
def q_partition_offsets(spark, sf):
    return posts_topic(spark, sf).select("post_id", "partition", "offset")


@query("replay_range", f"""
with {_SQL_TOPIC}
select post_id, partition, "offset" from logged
where "offset" >= {READ_FROM} and "offset" < {READ_FROM + READ_LIMIT}""")
def q_replay_range(spark, sf):
    return R.read_range(posts_topic(spark, sf), READ_FROM, READ_LIMIT).select("post_id", "partition", "offset")


_SQL_HALVES = """
halves as (select *, epoch_us(ts) < (select (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 from events) as old from events)"""


@query("consumer_lag", f"""
with {_SQL_TOPIC}, {_SQL_HALVES},
ends as (select partition, count(*) as end_offset, count(*) filter (where h.old) as committed
         from topic t join halves h on t.event_id = h.event_id group by partition)
select partition, end_offset, committed, end_offset - committed as lag from ends""")
def q_consumer_lag(spark, sf):
    """Lag of a consumer group that has read the older half of the topic, from the offsets it committed."""
    older, _ = J.split_by_time(spark, sf)
    folder = scratch_path(spark, "landing")
    J.land(older, folder)
    posts = J.post_messages(J.landing_stream(spark, folder))
    group = J.run_batches(posts, "lag-group", J.commit_step(lambda b: R.route(b, "post_id", POST_PARTITIONS)))
    # end offsets are message counts per partition: routing is enough, no per-message offsets needed
    topic = R.route(views.posts(spark, sf).select("post_id"), "post_id", POST_PARTITIONS)
    return R.consumer_lag(R.end_offsets(topic), J.commits(spark, group))


@query("topic_stats", f"""
with {_SQL_TOPIC}, c as (select partition, count(*) as messages from topic group by partition)
select *, cast(sum(messages) over () as bigint) as total_messages from c""")
def q_topic_stats(spark, sf):
    p = views.posts(spark, sf).select("post_id")
    return R.topic_stats(R.route(p, "post_id", POST_PARTITIONS))


def _sql_alerts(partition: str) -> str:
    return f"""
with t as (select post_id, topic, posted_at as trigger_time, sum(cast(sentiment_score as decimal(18, 4))) over w * cast(0.05 as decimal(4, 2)) as m,
             count(*) over w as c
           from posts
           window w as ({partition} order by posted_at, event_id rows between 19 preceding and current row))
select 'NEGATIVE_SENTIMENT_SPIKE' as alert_type, post_id, topic, cast(round(m, 4) as double) as window_avg, trigger_time
from t where c = 20 and m < cast({CHECK_THRESHOLD} as decimal(18, 4))"""


@query("alerts_batch", _sql_alerts("partition by topic"))
def q_alerts_batch(spark, sf):
    return AL.negative_spikes(views.posts(spark, sf), by=("topic",), threshold=CHECK_THRESHOLD)


@query("alerts_batch_global", _sql_alerts(""))
def q_alerts_batch_global(spark, sf):
    return AL.negative_spikes(views.posts(spark, sf), by=(), threshold=CHECK_THRESHOLD)


@query("last100_mean", """
select round(coalesce(avg(sentiment_score), 0.0), 4) as window_sentiment, count(*) as window_size
from (select sentiment_score from posts order by posted_at desc, event_id desc limit 100)""")
def q_last100_mean(spark, sf):
    return AL.last_n_mean(views.posts(spark, sf))


# ---- Structured Streaming -----------------------------------------------------------------------------

def _posts_stream(spark, sf, end=None):
    return J.post_messages(J.event_stream(spark, sf, end=end))


@query("stream_topic_counts", """
select topic, sentiment_label, count(*) as count from posts group by topic, sentiment_label""")
def q_stream_topic_counts(spark, sf):
    r = J.run_snapshot(J.topic_counts(_posts_stream(spark, sf)), "topic-counts")
    return J.read_snapshot(spark, r)


@query("stream_platform_stats", """
select platform, count(*) as posts, cast(sum(likes) as bigint) as total_likes,
  cast(sum(case when likes > 5000 then 1 else 0 end) as bigint) as viral_posts,
  (cast(sign(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * ((2 * abs(cast(sum(cast(sentiment_score as decimal(18, 4)))  * 10000 as hugeint)) * 10000 + count(sentiment_score)  * 10000) // (2 * count(sentiment_score)  * 10000)) as double) / 10000) as avg_sentiment
from posts group by platform""")
def q_stream_platform_stats(spark, sf):
    r = J.run_snapshot(J.platform_stats(_posts_stream(spark, sf)), "platform-stats", finish=J.finish_platform_stats)
    return J.read_snapshot(spark, r)


@query("trend_leaderboard", """
select hashtag, cast(sum(velocity) as bigint) as velocity from trend_events group by hashtag
order by velocity desc, hashtag limit 10""")
def q_trend_leaderboard(spark, sf):
    trends = J.trend_messages(J.event_stream(spark, sf))
    r = J.run_snapshot(J.hashtag_velocity(trends), "trend-velocity", finish=J.leaderboard)
    return J.read_snapshot(spark, r)


@query("stream_tumbling", """
select window_start, window_end, topic, count(*) as posts
from (select time_bucket(interval 1 minute, posted_at) as window_start,
        time_bucket(interval 1 minute, posted_at) + interval 1 minute as window_end, topic from posts)
group by window_start, window_end, topic""")
def q_stream_tumbling(spark, sf):
    end = J.open_end(spark)
    counts = J.tumbling_counts(_posts_stream(spark, sf, end), delay=J.measured_delay(spark, sf))
    return J.read_result(spark, J.run_append(counts, "tumbling", end=end))


@query("stream_sliding", """
with w as (select p.topic, p.likes, s.ws as window_start, s.ws + interval 10 minutes as window_end
           from posts p, unnest(generate_series(time_bucket(interval 1 minute, p.posted_at) - interval 9 minutes,
                                                time_bucket(interval 1 minute, p.posted_at), interval 1 minute)) s(ws))
select window_start, window_end, topic, count(*) as posts, cast(sum(likes) as bigint) as likes
from w group by window_start, window_end, topic""")
def q_stream_sliding(spark, sf):
    end = J.open_end(spark)
    stats = J.sliding_stats(_posts_stream(spark, sf, end), delay=J.measured_delay(spark, sf))
    return J.read_result(spark, J.run_append(stats, "sliding", end=end))


def _alerts(spark, sf, **options):
    """Rows sealed by a watermark that the measured disorder holds back; the end of the input seals the rest."""
    end = J.open_end(spark)
    return J.read_spikes(spark, J.run_spikes(_posts_stream(spark, sf, end), "alerts", J.measured_delay(spark, sf), end=end,
                                             threshold=CHECK_THRESHOLD, **options))


@query("stream_alerts", _sql_alerts("partition by topic"))
def q_stream_alerts(spark, sf):
    return _alerts(spark, sf)


@query("stream_alerts_global", _sql_alerts(""))
def q_stream_alerts_global(spark, sf):
    return _alerts(spark, sf, by=())


_SQL_LAST100 = """
with r as (select topic, sentiment_score, count(*) over ({part}) as seen,
             row_number() over ({part} order by posted_at desc, event_id desc) as rn from posts),
t as (select {key} max(seen) as seen, cast(sum(cast(sentiment_score as decimal(18, 4))) * 10000 as bigint) as i,
        count(*) as n from r where rn <= 100 {group})
select {key} seen, cast(sign(i) * ((2 * abs(i) + n) // (2 * n)) as double) / 10000 as window_sentiment,
  n as window_size from t"""


@query("stream_last100", _SQL_LAST100.format(part="partition by topic", key="topic,", group="group by topic"))
def q_stream_last100(spark, sf):
    return J.read_last_n(spark, J.run_last_n(_posts_stream(spark, sf), "last100"))


@query("stream_last100_global", _SQL_LAST100.format(part="", key="", group=""))
def q_stream_last100_global(spark, sf):
    return J.read_last_n(spark, J.run_last_n(_posts_stream(spark, sf), "last100-global", by=()), by=())


@query("stream_dedup", """
select post_id, event_id, user_id, platform, topic, sentiment_label, sentiment_score, likes, shares, comments,
  likes > 5000 as is_viral, posted_at
from posts""")
def q_stream_dedup(spark, sf):
    posts = _posts_stream(spark, sf)
    replayed = posts.unionByName(posts.where(F.col("event_id") % 97 == 0))  # at-least-once redelivery
    out = J.read_result(spark, J.run_append(J.dedup_within_watermark(replayed, J.measured_delay(spark, sf)), "dedup"))
    return out.select("post_id", "event_id", "user_id", "platform", "topic", "sentiment_label", "sentiment_score",
                      "likes", "shares", "comments", "is_viral", "posted_at")


def _two_runs(spark, sf, first_newer: bool, build):
    """Land one half of the events, run the job, land the other half, run again on the same checkpoint."""
    older, newer = J.split_by_time(spark, sf)
    folder = scratch_path(spark, "landing")
    ck, out = scratch_path(spark, "two-runs-ckpt"), scratch_path(spark, "two-runs-out")
    runs = []
    for half in ((newer, older) if first_newer else (older, newer)):
        J.land(half, folder)
        runs.append(build(J.post_messages(J.landing_stream(spark, folder)), ck, out))
    return runs


@query("stream_restart", """
select topic, sentiment_label, count(*) as count from posts group by topic, sentiment_label""")
def q_stream_restart(spark, sf):
    runs = _two_runs(spark, sf, False,
                     lambda posts, ck, out: J.run_snapshot(J.topic_counts(posts), "restart", checkpoint=ck, path=out))
    return J.read_snapshot(spark, runs[-1])


@query("stream_late_drop", f"""
with {_SQL_HALVES},
mark as (select date_trunc('millisecond', max(ts)) - interval 10 minutes as mark from halves where not old)
select 1 as run, count(*) filter (where not old) as input_rows, 0 as late_rows from halves
union all
select 2, count(*) filter (where old), count(*) filter (where old and ts <= (select mark from mark)) from halves""")
def q_stream_late_drop(spark, sf):
    """The newer half first: rows of the older half that arrive behind the watermark, as Spark's own metric counts them."""
    seen = []

    def run(posts, ck, out):
        with J.ProgressLog(spark) as log:
            J.run_append(J.dedup_within_watermark(posts), "late", checkpoint=ck, path=out)
        seen.append((len(seen) + 1, *J.late_counts(log)))

    _two_runs(spark, sf, True, run)
    return spark.createDataFrame(seen, "run int, input_rows long, late_rows long")


BOUND_FILES = 8


@query("stream_bounded_read", """
select count(*) as rows, true as several_batches, 0 as batches_above_bound from events""")
def q_stream_bounded_read(spark, sf):
    """The events landed as files, read under a bound of bytes a micro-batch: rows read, batches over the bound."""
    folder, ck = scratch_path(spark, "landing"), scratch_path(spark, "bounded-ckpt")
    J.land(read_table(spark, sf, "events").repartition(BOUND_FILES), folder)
    files = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("path"),
                                              F.col("_metadata.file_size").alias("bytes")).distinct()
    bound = 3 * files.agg(F.max("bytes")).first()[0]
    r = J.run_snapshot(J.topic_counts(J.post_messages(J.landing_stream(spark, folder, bound))), "bounded", checkpoint=ck)
    sizes = J.batch_sizes(spark, ck, files)
    rows = J.read_snapshot(spark, r).agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("rows"))
    return rows.crossJoin(sizes.agg((F.count(F.lit(1)) > 1).alias("several_batches"),
                                    F.count_if(F.col("bytes") > bound).cast("int").alias("batches_above_bound")))


@query("stream_state_export", """
select topic, sentiment_label, count(*) as count from posts group by topic, sentiment_label""")
def q_stream_state_export(spark, sf):
    """The running counts as the state store holds them after the last batch, read as a table."""
    r = J.run_snapshot(J.topic_counts(_posts_stream(spark, sf)), "state-export")
    return J.exported_state(spark, r.checkpoint).select("topic", "sentiment_label", "count")


@query("stream_two_groups", """
select 'sentiment_processor' as consumer_group, count(*) as processed from posts
union all select 'trend_tracker', count(*) from trend_events""")
def q_stream_two_groups(spark, sf):
    """Messages that each of two groups has processed, counted in the groups' own results."""
    ev = J.event_stream(spark, sf)
    res = J.run_concurrently({"sentiment_processor": J.topic_counts(J.post_messages(ev)),
                              "trend_tracker": J.hashtag_velocity(J.trend_messages(ev))})
    count = {"sentiment_processor": "count", "trend_tracker": "messages"}
    rows = [J.read_snapshot(spark, r).agg(F.coalesce(F.sum(count[name]), F.lit(0)).alias("processed"))
            .select(F.lit(name).alias("consumer_group"), "processed") for name, r in res.items()]
    return rows[0].unionByName(rows[1])


_SQL_SECTIONS = f"""
with topic_breakdown as (
  select topic, sentiment_label, count(*) as n from posts group by topic, sentiment_label),
{_SQL_TOPIC.strip()}
select 'processed' as section, 'sentiment-processor' as item,
  '{{"consumer_group":"sentiment-processor","total_processed":' || (select count(*) from posts) || '}}' as payload
union all select 'processed', 'trend-tracker',
  '{{"consumer_group":"trend-tracker","total_processed":' || (select count(*) from trend_events) || '}}'
union all select 'topic_breakdown', topic || '|' || sentiment_label,
  '{{"topic":"' || topic || '","sentiment_label":"' || sentiment_label || '","count":' || n || '}}' from topic_breakdown
union all select 'posts_topic_stats', cast(partition as varchar),
  '{{"partition":' || partition || ',"messages":' || count(*) || ',"total_messages":' || sum(count(*)) over () || '}}'
  from topic group by partition
union all select 'consumer_lag_after', cast(partition as varchar),
  '{{"partition":' || partition || ',"end_offset":' || count(*) || ',"committed":' || count(*) || ',"lag":0}}'
  from topic group by partition
union all select 'trending_leaderboard', hashtag, '{{"hashtag":"' || hashtag || '","velocity":' || velocity || '}}'
  from (select hashtag, cast(sum(velocity) as bigint) as velocity from trend_events group by hashtag
        order by velocity desc, hashtag limit 10)"""


@query("stream_report_sections", _SQL_SECTIONS)
def q_stream_report_sections(spark, sf):
    """The report's sections that hold whole numbers, row by row."""
    from tidepool.streaming.report import stream_report

    exact = ["processed", "topic_breakdown", "posts_topic_stats", "consumer_lag_after", "trending_leaderboard"]
    return stream_report(spark, sf, alert_threshold=CHECK_THRESHOLD).where(F.col("section").isin(exact))


def _json_sql(**fields: str) -> str:
    """A JSON object's text; values are given as SQL text expressions."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields.items()) + " || '}'"


def _quoted(x: str) -> str:
    return f"'\"' || {x} || '\"'"


_4 = "cast(cast({} as decimal(18, 4)) as varchar)"
_TIME = "strftime(trigger_time, '%Y-%m-%d %H:%M:%S.%f')"
_SQL_REPORT = f"""
with sections as ({_SQL_SECTIONS}),
alerts as ({_sql_alerts("partition by topic")}),
platforms as ({registry.RAW["stream_platform_stats"]}),
last as ({_SQL_LAST100.format(part="partition by topic", key="topic,", group="group by topic")}),
trend_routes as (select {_md5_mod_sql('hashtag', TREND_PARTITIONS)} as partition, count(*) as n from trend_events group by 1)
select section, item, payload from sections
union all select 'platform_summary', platform, {_json_sql(platform=_quoted("platform"), posts="posts", total_likes="total_likes",
                                                           viral_posts="viral_posts", avg_sentiment=_4.format("avg_sentiment"))}
  from platforms
union all select 'window_sentiment', topic, {_json_sql(topic=_quoted("topic"), seen="seen", window_sentiment=_4.format("window_sentiment"),
                                                        window_size="window_size")} from last
union all select 'alerts_raised', cast(count(*) as varchar), {_json_sql(alerts_raised="count(*)")} from alerts
union all select 'sample_alerts', {_TIME} || '|' || post_id,
  {_json_sql(alert_type=_quoted("alert_type"), post_id=_quoted("post_id"), topic=_quoted("topic"), window_avg=_4.format("window_avg"),
             trigger_time=_quoted(_TIME))} from (select * from alerts order by trigger_time, post_id limit 5)
union all select 'trends_topic_stats', cast(partition as varchar),
  {_json_sql(partition="partition", messages="n", total_messages="cast(sum(n) over () as bigint)")} from trend_routes"""


@query("stream_report_json", _SQL_REPORT)
def q_stream_report_json(spark, sf):
    from tidepool.streaming.report import stream_report

    return stream_report(spark, sf, alert_threshold=CHECK_THRESHOLD)


@query("stream_alerts_event_time", f"""
with t as (select post_id, topic, posted_at as trigger_time,
             sum(cast(sentiment_score as decimal(18, 4))) over w * cast(0.05 as decimal(4, 2)) as m,
             count(*) over w as c
           from posts
           window w as (partition by topic order by posted_at, event_id rows between 19 preceding and current row))
select 'NEGATIVE_SENTIMENT_SPIKE' as alert_type, post_id, topic, cast(round(m, 4) as double) as window_avg, trigger_time
from t where c = 20 and m < cast({CHECK_THRESHOLD} as decimal(18, 4))
  and time_bucket(interval 1 minute, trigger_time) + interval 1 minute
      <= (select date_trunc('millisecond', max(ts)) - interval 10 minutes from events)""")
def q_stream_alerts_event_time(spark, sf):
    """Alerts of the minutes that a watermark of the newest time less 10 minutes has sealed; later ones stay open.

    The end marker's time makes up for the measured disorder in the delay, so the final watermark is the same for any files.
    """
    back, newest = J.disorder(read_table(spark, sf, "events"))
    end = J.open_end(spark)
    r = J.run_spikes(_posts_stream(spark, sf, end), "alerts-event-time", J.delay_of(back, DELAY),
                     end=end if newest else None, until=newest + back if newest else J.END_OF_TIME,
                     threshold=CHECK_THRESHOLD)
    return J.read_spikes(spark, r)
