"""Streaming report: one JSON document per row, section by section, assembled from the stream sinks by Spark.

A section is a keyed table (a running aggregate, top-10 leaderboard, first-5 alerts, one row per partition), so
nothing is gathered into one value. The report is written as JSON, a folder per section, to the shared folder
(the object-store checkpoint of the run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators import routing as R
from tidepool.session import scratch_path
from tidepool.sources import views
from tidepool.streaming import jobs as J

SAMPLE_ALERTS = 5
LEADERBOARD = 10
POST_PARTITIONS, TREND_PARTITIONS = 4, 2


def _section(name: str, df: DataFrame, key: list[str]) -> DataFrame:
    """One report row per row of a section: its key as text and the row as JSON, reals with four places."""
    shown = df.select(*[F.col(c).cast("decimal(18,4)").alias(c) if kind == "double"
                        else F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if kind.startswith("timestamp") else F.col(c)
                        for c, kind in df.dtypes])
    item = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    return shown.select(F.lit(name).alias("section"), item.alias("item"), F.to_json(F.struct(*shown.columns)).alias("payload"))


def _posts_step(partitions: int):
    """All of the post consumer's figures out of one reading of a micro-batch: counts, platform sums, newest rows, commits."""
    last, commit = J.last_n_step(), J.commit_step(lambda batch: R.route(batch, "post_id", partitions))

    def step(posts: DataFrame, batch_id: int, path: str) -> None:
        held = posts.persist()
        try:
            for name, part in (("topics", J.topic_counts(held)), ("platforms", J.platform_stats(held))):
                J.write_batch(part, f"{path}/{name}", batch_id)
            last(held, batch_id, f"{path}/last")
            commit(held, batch_id, f"{path}/commits")
        finally:
            held.unpersist()

    return step


def stream_report(spark: SparkSession, sf_dir: str, alert_threshold: float = -0.5) -> DataFrame:
    """section, item, payload of the whole run.

    Three streams: the post consumer, the trend tracker and the alerts. How many messages each consumer processed is observed on its
    way (``observe``), not counted again.
    """
    end = J.open_end(spark)
    ev = J.event_stream(spark, sf_dir)
    count = F.count(F.lit(1)).alias("n")
    with J.ProgressLog(spark) as log:
        r = J.run_batches(J.post_messages(ev).observe("sentiment-processor", count), "report-posts", _posts_step(POST_PARTITIONS))
        t = J.run_snapshot(J.hashtag_velocity(J.trend_messages(ev).observe("trend-tracker", count)), "report-trends")
        a = J.run_spikes(J.post_messages(J.event_stream(spark, sf_dir, end=end)), "report-alerts",
                         J.measured_delay(spark, sf_dir), end=end, threshold=alert_threshold)
    processed = [(name, sum(b["observed"].get(name, {}).get("n", 0) for b in log.batches))
                 for name in ("sentiment-processor", "trend-tracker")]

    topics = J.read_batches(spark, f"{r.path}/topics", "topic string, sentiment_label string, count long").groupBy(
        "topic", "sentiment_label").agg(F.sum("count").alias("count"))
    platforms = J.read_batches(
        spark, f"{r.path}/platforms", "platform string, posts long, total_likes long, viral_posts long, sentiment_sum decimal(28,4)").groupBy(
        "platform").agg(*[F.sum(c).cast(k).alias(c) for c, k in (("posts", "long"), ("total_likes", "long"), ("viral_posts", "long"),
                                                                 ("sentiment_sum", "decimal(28,4)"))])
    velocity = J.read_snapshot(spark, t)
    al = J.read_spikes(spark, a)
    p = views.posts(spark, sf_dir).select("post_id")
    trends = views.trend_events(spark, sf_dir)
    routed = R.route(p, "post_id", POST_PARTITIONS)
    last, commits = (J.RunResult(f"{r.path}/{name}", r.checkpoint) for name in ("last", "commits"))
    sections = [
        _section("processed", spark.createDataFrame(processed, "consumer_group string, total_processed long"), ["consumer_group"]),
        _section("topic_breakdown", topics, ["topic", "sentiment_label"]),
        _section("platform_summary", J.finish_platform_stats(platforms), ["platform"]),
        _section("window_sentiment", J.read_last_n(spark, last), ["topic"]),
        _section("alerts_raised", al.agg(F.count(F.lit(1)).alias("alerts_raised")), ["alerts_raised"]),
        _section("sample_alerts", al.orderBy("trigger_time", "post_id").limit(SAMPLE_ALERTS), ["trigger_time", "post_id"]),
        _section("trending_leaderboard", J.leaderboard(velocity, LEADERBOARD), ["hashtag"]),
        _section("posts_topic_stats", R.topic_stats(routed), ["partition"]),
        _section("trends_topic_stats", R.topic_stats(R.route(trends, "hashtag", TREND_PARTITIONS)), ["partition"]),
        _section("consumer_lag_after", R.consumer_lag(R.end_offsets(routed), J.commits(spark, commits)), ["partition"]),
    ]
    rep = sections[0]
    for s in sections[1:]:
        rep = rep.unionByName(s)
    path = scratch_path(spark, "stream-report")
    rep.write.mode("overwrite").partitionBy("section").json(path)
    return spark.read.schema("section string, item string, payload string").json(path).select(
        "section", "item", "payload")
