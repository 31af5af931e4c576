"""Warehouse analytics: named SQL views, KPIs, reports, dashboard panel datasets.

Results come ordered as the reports show them, ties by key. Global (unpartitioned) rank and ntile use
``tidepool.operators.ranking`` instead of a single-partition window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.functions.columns import avg_round, pct_round, severity_band, sign_class
from tidepool.operators.ranking import global_cumsum, global_rank, ntile_of
from tidepool.session import ensure_checkpoint_dir


def _n() -> Column:
    return F.count(F.lit(1))


def _total(col: str) -> Column:
    return F.sum(col).cast("bigint").alias(col if col.startswith("total") else f"total_{col}")


def topic_sentiment_rank(fact_posts: DataFrame) -> DataFrame:
    """Topics ranked by posts inside each label; largest first."""
    per = fact_posts.groupBy("topic", "sentiment_label").agg(
        _n().alias("post_count"), avg_round("sentiment_score", 4, 4).alias("avg_sentiment"), _total("likes"),
        F.sum("is_viral").cast("bigint").alias("viral_posts"))
    place = F.rank().over(Window.partitionBy("sentiment_label").orderBy(F.col("post_count").desc()))
    return per.withColumn("topic_rank", place.cast("bigint")).orderBy(F.col("post_count").desc(), "topic", "sentiment_label")


def daily_sentiment_trend(fact_posts: DataFrame, days: int = 7) -> DataFrame:
    """Daily totals per topic; the engagement of the last ``days`` rows over ``days``, by date and topic."""
    per = fact_posts.groupBy("post_date", "topic").agg(
        _n().alias("daily_posts"), avg_round("sentiment_score", 4, 4).alias("avg_sentiment"), _total("likes"),
        F.sum("is_viral").cast("bigint").alias("viral_count"), F.sum("engagement_score").alias("_day"))
    last = Window.partitionBy("topic").orderBy("post_date").rowsBetween(1 - days, 0)
    return (per.withColumn(f"engagement_{days}d_avg", F.round(F.sum("_day").over(last) / F.lit(float(days)), 2))
            .drop("_day").orderBy("post_date", "topic"))


def platform_health(stg_api_logs: DataFrame) -> DataFrame:
    """Calls, errors, rate limits and latency per source; worst error rate first."""
    per = stg_api_logs.groupBy("source").agg(
        _n().alias("total_calls"), F.sum("is_error").cast("bigint").alias("error_count"),
        pct_round(F.sum("is_error"), _n(), 2).alias("error_rate_pct"),
        F.sum("is_rate_limited").cast("bigint").alias("rate_limit_hits"),
        avg_round("response_time_ms", 2, 1).alias("avg_latency_ms"),
        avg_round("records_fetched", 0, 1).alias("avg_records_per_call"))
    return per.orderBy(F.col("error_rate_pct").desc(), "source")


def viral_content(fact_posts: DataFrame) -> DataFrame:
    """Share of viral posts and their mean engagement per platform, topic and label; highest share first."""
    viral = F.col("is_viral") == 1
    keys = ["platform", "topic", "sentiment_label"]
    per = fact_posts.groupBy(*keys).agg(
        F.count_if(viral).alias("viral_posts"), _n().alias("total_posts"),
        pct_round(F.count_if(viral), _n(), 2).alias("viral_rate_pct"),
        avg_round(F.when(viral, F.col("engagement_score")), 0, 2).alias("avg_viral_engagement"))
    return per.orderBy(F.col("viral_rate_pct").desc(), *keys)


def avg4_exact(col: str):
    """Mean of values that are already 4-place decimals, rounded to 4 places without float ties."""
    return avg_round(col, 4, 4)


# view -> (builder, the warehouse tables it takes)
NAMED_VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "vw_topic_sentiment_rank": (topic_sentiment_rank, ("fact_posts",)),
    "vw_influencer_impact": (lambda posts, users: influencer_impact(posts, users), ("fact_posts", "dim_users")),
    "vw_daily_sentiment_trend": (daily_sentiment_trend, ("fact_posts",)),
    "vw_platform_health": (platform_health, ("stg_api_logs",)),
    "vw_viral_content_analysis": (viral_content, ("fact_posts",)),
}


def run_view(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    build, used = NAMED_VIEWS[name]
    return build(*[tables[t] for t in used])


def run_named_views(spark: SparkSession, tables: Mapping[str, DataFrame], out_root: str | None = None,
                    register: bool = True):
    """Run every named view and register it as a temporary view; a failing one is reported, the others go on.

    Returns (results, status) where status is a DataFrame (view, ok, error).
    """
    results, status = {}, []
    for name in NAMED_VIEWS:
        try:
            df = run_view(name, tables)
            if out_root:
                df.write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/{name}")
            if register:
                df.createOrReplaceTempView(name)
            results[name] = df
            status.append((name, True, None))
        except Exception as e:  # noqa: BLE001 - per-view failure is data, not a crash
            status.append((name, False, f"{type(e).__name__}: {e}"))
    return results, spark.createDataFrame(status, "view string, ok boolean, error string")


def influencer_impact(fact_posts: DataFrame, dim_users: DataFrame, n: int = 100) -> DataFrame:
    """Per-user impact with global engagement quartile (NTILE 4) and viral rank, top ``n`` by engagement.

    Posts are aggregated per user before the join (map-side partial aggregation), so the join moves one
    row per user. The LIMIT keeps only the first ``n`` rows of the engagement order, so both global
    windows are evaluated for those rows only, without sorting the per-user table:
      * NTILE(4): the survivors' positions are 1..n, and the tile follows from position and the table's
        row count (a scalar subquery);
      * RANK by viral_count: 1 + number of users with a larger viral_count, read from a running count
        over the distinct viral_count values (a small table, range-partitioned, never one task).
    """
    per_user = fact_posts.groupBy("user_id").agg(
        F.count("post_id").alias("total_posts"),
        F.sum("engagement_score").alias("total_engagement"),
        avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
        F.sum("is_viral").cast("bigint").alias("viral_count"))
    base = per_user.join(dim_users.select("user_id", "username", "followers", "follower_tier"), "user_id")
    # Read three times below: pin it once in the shared checkpoint folder (one row per user).
    ensure_checkpoint_dir(base.sparkSession)
    base = base.checkpoint(eager=True)
    total = base.agg(F.count(F.lit(1))).scalar()
    order = [F.col("total_engagement").desc(), F.col("user_id")]
    top = base.orderBy(*order).limit(n)  # TakeOrderedAndProject: n rows per task, merged
    top = top.withColumn("_rn", F.row_number().over(Window.orderBy(*order)))  # at most n rows
    values = base.groupBy("viral_count").agg(F.count(F.lit(1)).alias("_n"))
    ahead = global_cumsum(values, [F.col("viral_count").desc_nulls_last()], "_n", "_cum")
    j = ahead.join(F.broadcast(top), "viral_count")  # the n survivors are the broadcast side
    return j.select("user_id", "username", "followers", "follower_tier", "total_posts", "total_engagement",
                    "avg_sentiment", "viral_count",
                    ntile_of(F.col("_rn"), total, 4).alias("engagement_quartile"),
                    (F.col("_cum") - F.col("_n") + 1).cast("bigint").alias("viral_rank")).orderBy(*order)


def kpis(fact_posts: DataFrame) -> DataFrame:
    """One-row KPI table (single global aggregate; partial aggregates per task, one tiny final merge)."""
    lab = F.col("sentiment_label")
    return fact_posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.countDistinct("user_id").alias("unique_users"),
        F.sum("likes").cast("bigint").alias("total_likes"),
        F.sum("shares").cast("bigint").alias("total_shares"),
        F.sum("is_viral").cast("bigint").alias("viral_posts"),
        avg_round("sentiment_score", 4, 4).alias("overall_sentiment"),
        avg_round("engagement_score", 0, 2).alias("avg_engagement"),
        F.sum(F.when(lab == "positive", 1).otherwise(0)).cast("bigint").alias("positive_posts"),
        F.sum(F.when(lab == "negative", 1).otherwise(0)).cast("bigint").alias("negative_posts"),
        F.sum(F.when(lab == "neutral", 1).otherwise(0)).cast("bigint").alias("neutral_posts"))


def hashtag_velocity(fact_trends: DataFrame, n: int = 30) -> DataFrame:
    """Hashtag x topic totals over days (avg_sentiment = unweighted mean of daily means), global trend rank."""
    g = fact_trends.groupBy("hashtag", "topic").agg(
        F.sum("post_count").cast("bigint").alias("total_posts"),
        F.sum("total_likes").cast("bigint").alias("total_likes"),
        F.sum("total_shares").cast("bigint").alias("total_shares"),
        avg4_exact("avg_sentiment").alias("avg_sentiment"),
        F.sum("viral_count").cast("bigint").alias("total_viral"))
    ranked = global_rank(g, "total_posts", descending=True, tiebreak=["hashtag", "topic"], out="trend_rank")
    top = ranked.orderBy(F.col("total_posts").desc(), "hashtag", "topic").limit(n)
    return top.withColumn("trend_rank", F.col("trend_rank").cast("bigint"))


def user_segment(fact_posts: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Per-user stats (aggregated before the join), inner-joined to users, averaged per follower tier."""
    stats = fact_posts.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("post_count"),
        avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
        F.sum("engagement_score").alias("total_engagement"),
        F.sum("is_viral").cast("bigint").alias("viral_posts"))
    j = dim_users.select("user_id", "follower_tier").join(stats, "user_id")
    return j.groupBy("follower_tier").agg(
        F.count(F.lit(1)).alias("user_count"),
        avg_round("post_count", 0, 1).alias("avg_posts"),
        avg_round("total_engagement", 0, 2).alias("avg_engagement"),
        avg4_exact("avg_sentiment").alias("avg_sentiment"),
        F.sum("viral_posts").cast("bigint").alias("total_viral")).orderBy(F.col("avg_engagement").desc(), "follower_tier")


def primetime(fact_posts: DataFrame) -> DataFrame:
    return fact_posts.groupBy("post_hour", "platform").agg(
        F.count(F.lit(1)).alias("posts"),
        avg_round("engagement_score", 0, 2).alias("avg_engagement"),
        avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
        pct_round(F.sum("is_viral"), F.count(F.lit(1)), 2).alias("viral_rate_pct")).orderBy("post_hour", "platform")


# ---- dashboard panel datasets -------------------------------------------------------------------------

def panel_daily_trend(fact_posts: DataFrame, window_rows: int = 7) -> DataFrame:
    """Daily mean sentiment and post count, with a trailing 7-row mean of the daily means.

    The window runs over the per-day aggregate (one row per calendar day), not over posts.
    """
    d = fact_posts.groupBy("post_date").agg(
        avg_round("sentiment_score", 4, 4).alias("avg_sentiment"), F.count(F.lit(1)).alias("posts"))
    w = Window.orderBy("post_date").rowsBetween(-(window_rows - 1), 0)
    return d.withColumn("rolling_7", F.round(F.avg("avg_sentiment").over(w), 8)).orderBy("post_date")


def panel_label_share(fact_posts: DataFrame) -> DataFrame:
    c = fact_posts.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("posts"))
    # three rows at most: the total over them is a tiny single-partition window
    return c.withColumn("share_pct", pct_round(F.col("posts"), F.sum("posts").over(Window.partitionBy()), 1))


def panel_topic_pivot(fact_posts: DataFrame, labels=("negative", "neutral", "positive")) -> DataFrame:
    """topic x label counts as columns, missing combinations 0 (explicit pivot values: no extra pass)."""
    p = fact_posts.groupBy("topic").pivot("sentiment_label", list(labels)).count().fillna(0)
    return p.select("topic", *[F.col(x).cast("bigint").alias(x) for x in labels])


def panel_platform(fact_posts: DataFrame) -> DataFrame:
    return fact_posts.groupBy("platform").agg(avg_round("engagement_score", 0, 2).alias("avg_eng"),
                                              F.count(F.lit(1)).alias("posts")).orderBy(F.col("avg_eng").desc(), "platform")


def panel_top_hashtags(velocity: DataFrame, n: int = 10) -> DataFrame:
    top = velocity.orderBy(F.col("total_posts").desc(), "hashtag", "topic").limit(n)
    return top.withColumn("sentiment_class", sign_class(F.col("avg_sentiment")))


def panel_hourly(fact_posts: DataFrame) -> DataFrame:
    h = fact_posts.groupBy("post_hour").agg(F.count(F.lit(1)).alias("posts"))
    return h.withColumn("is_prime_time", F.col("post_hour").between(18, 22)).orderBy("post_hour")


def panel_api_health(stg_api_logs: DataFrame) -> DataFrame:
    a = stg_api_logs.groupBy("endpoint").agg(
        pct_round(F.sum("is_error"), F.count(F.lit(1)), 1).alias("error_pct"),
        avg_round("response_time_ms", 2, 0).alias("avg_ms"))
    return a.withColumn("severity", severity_band(F.col("error_pct"))).orderBy(F.col("error_pct").desc(), "endpoint")


def confidence_histogram(scored: DataFrame, label: str = "nlp_label", value: str = "nlp_confidence",
                         bins: int = 30) -> DataFrame:
    """Per-label histogram with ``bins`` equal bins between the label's min and max (last bin closed).

    When min == max the range is widened to +-0.5, as common histogram routines do. One pass over the
    rows reduces them to (label, value, count) (confidences are 4-place values, so this table is bounded
    by labels x 10^4); bounds and bins are computed on that small table.
    """
    vc = scored.groupBy(label, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label)
    mn, mx = F.min(value).over(w), F.max(value).over(w)
    b = (vc.withColumn("lo", F.when(mn == mx, mn - 0.5).otherwise(mn))
           .withColumn("hi", F.when(mn == mx, mx + 0.5).otherwise(mx)))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    binned = b.withColumn("bin", F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1)).cast("bigint"))
    h = binned.groupBy(label, "bin", "lo", "hi").agg(F.sum("_n").alias("count"))
    return h.select(label, "bin",
                    F.round(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins, 6).alias("bin_lo"),
                    F.round(F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins, 6).alias("bin_hi"),
                    F.col("count").cast("bigint").alias("count"))


def post_stats(posts: DataFrame) -> DataFrame:
    lab = F.col("sentiment_label")
    return posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.sum(F.col("is_viral").cast("int")).cast("bigint").alias("viral_posts"),
        avg_round("sentiment_score", 4, 4).alias("sentiment_mean"),
        F.round(F.stddev_pop("sentiment_score"), 4).alias("sentiment_std"),
        F.sum(F.when(lab == "positive", 1).otherwise(0)).cast("bigint").alias("positive_posts"),
        F.sum(F.when(lab == "negative", 1).otherwise(0)).cast("bigint").alias("negative_posts"))
