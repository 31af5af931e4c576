"""Gold layer: pre-aggregated tables.

Every aggregate is a partial + final hash aggregate (map-side combine), so a hot group key costs one
buffer per task before the shuffle. Rows with a null group key are dropped first, as the grouped
frames of the reference do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.columns import avg_round


def _non_null(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def _viral_sum(col: str = "is_viral"):
    return F.sum(F.col(col).cast("int")).cast("bigint")


def topic_sentiment(posts: DataFrame) -> DataFrame:
    keys = ["topic", "sentiment_label"]
    return (_non_null(posts, keys).groupBy(*keys)
            .agg(F.count("post_id").alias("post_count"),
                 avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
                 F.sum("likes").cast("bigint").alias("total_likes"),
                 F.sum("shares").cast("bigint").alias("total_shares"),
                 F.round(F.sum("engagement_score"), 4).alias("total_engagement"),
                 _viral_sum().alias("viral_posts")))


def daily_trend(posts: DataFrame, window_rows: int = 7) -> DataFrame:
    """date x topic aggregate, then a trailing ``window_rows``-row mean of the rounded daily mean per topic.

    The window runs over the aggregate (days x topics rows), never over posts.
    """
    keys = ["post_date", "topic"]
    daily = (_non_null(posts, keys).groupBy(*keys)
             .agg(F.count("post_id").alias("posts_count"),
                  avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
                  F.round(F.sum("engagement_score"), 4).alias("total_engagement")))
    w = Window.partitionBy("topic").orderBy("post_date").rowsBetween(-(window_rows - 1), 0)
    # The daily means are 4-place decimals; averaging them as decimals keeps ties exact.
    return daily.withColumn("sentiment_7d_avg",
                            F.round(F.avg(F.col("avg_sentiment").cast("decimal(18,4)")).over(w), 4).cast("double"))


def platform_perf(posts: DataFrame) -> DataFrame:
    return (_non_null(posts, ["platform"]).groupBy("platform")
            .agg(F.count("post_id").alias("total_posts"),
                 avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
                 F.sum("likes").cast("bigint").alias("total_likes"),
                 F.sum("shares").cast("bigint").alias("total_shares"),
                 _viral_sum().alias("viral_posts"),
                 avg_round("engagement_score", 0, 4).alias("avg_engagement")))


def top_influencers(posts: DataFrame, users: DataFrame, n: int = 200) -> DataFrame:
    """Top ``n`` (user, platform) groups by total engagement, with user attributes.

    Posts are aggregated per (user_id, platform) *before* the join (users are unique by user_id, so the
    result equals join-then-group); the join then moves one row per user instead of one per post. Posts
    without a matching user drop out (their attribute keys are null). Ties break on user_id, platform.
    """
    per_user = (_non_null(posts, ["user_id", "platform"]).groupBy("user_id", "platform")
                .agg(F.count("post_id").alias("total_posts"),
                     F.sum("engagement_score").alias("total_engagement"),
                     avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
                     _viral_sum().alias("viral_count")))
    attrs = users.select("user_id", "username", "followers", "follower_tier", "verified", "location")
    j = _non_null(per_user.join(attrs, "user_id", "inner"),
                  ["username", "followers", "follower_tier", "verified", "location"])
    top = j.orderBy(F.col("total_engagement").desc(), F.col("user_id"), F.col("platform")).limit(n)
    return top.select("user_id", "username", "followers", "follower_tier", "platform", "verified", "location",
                      "total_posts", F.round("total_engagement", 4).alias("total_engagement"),
                      "avg_sentiment", "viral_count")


def hourly_pattern(posts: DataFrame) -> DataFrame:
    keys = ["post_hour", "platform"]
    return (_non_null(posts, keys).groupBy(*keys)
            .agg(F.count("post_id").alias("post_count"),
                 avg_round("engagement_score", 0, 4).alias("avg_engagement"),
                 avg_round("sentiment_score", 4, 4).alias("avg_sentiment")))
