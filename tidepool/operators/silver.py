"""Silver layer: cleaned, de-duplicated, enriched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import columns as C
from tidepool.operators.dedup import drop_metadata, keep_first


def silver_users(users: DataFrame) -> DataFrame:
    u = drop_metadata(users).fillna({"location": "Unknown"})
    u = keep_first(u, ["user_id"], [c for c in u.columns if c != "user_id"])
    return (u.withColumn("is_influencer", C.is_influencer(F.col("followers")))
             .withColumn("follower_tier", C.follower_tier(F.col("followers"))))


def silver_posts(posts: DataFrame, dedup: bool = True) -> DataFrame:
    p = drop_metadata(posts)
    if dedup:
        p = keep_first(p, ["post_id"], ["posted_at", *[c for c in p.columns if c not in ("post_id", "posted_at")]])
    ts = F.col("posted_at")
    return p.select(
        *[c for c in p.columns if c != "sentiment_score"],
        C.clip_unit(F.col("sentiment_score")).alias("sentiment_score"),
        F.to_date(ts).alias("post_date"),
        F.hour(ts).alias("post_hour"),
        F.date_format(ts, "EEEE").alias("post_weekday"),
        F.month(ts).alias("post_month"),
        F.year(ts).alias("post_year"),
        C.engagement_score(F.col("likes"), F.col("shares"), F.col("comments")).alias("engagement_score"),
        C.is_prime_time(F.hour(ts)).alias("is_prime_time"),
    )


def silver_hashtag_trends(trends: DataFrame) -> DataFrame:
    h = drop_metadata(trends)
    return h.withColumn("engagement_index",
                        C.engagement_index(F.col("total_likes"), F.col("total_shares"), F.col("post_count")))


def silver_api_logs(logs: DataFrame) -> DataFrame:
    lg = drop_metadata(logs)
    return (lg.withColumn("is_error", F.col("status_code") >= 400)
              .withColumn("is_rate_limited", F.col("status_code") == 429)
              .withColumn("hour", F.hour("log_ts")))
