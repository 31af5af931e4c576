"""Canonical views over the driver tables (the social-post data model, derived by Spark).

Each builder returns a lazy DataFrame; nothing is materialised here. The same definitions exist as
DuckDB SQL text in ``tidepool.plans.oracle`` for the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.columns import avg_round
from tidepool.functions.text import tokenize
from tidepool.sources.tables import read_table

# Fixed values of the data model.
PLATFORMS = ["Twitter", "Reddit", "Instagram", "LinkedIn"]
LANGUAGES = ["en", "es", "fr", "de", "pt"]
LABELS = ["positive", "negative", "neutral"]
LABEL_BASE_SCORE = {"positive": 0.65, "negative": -0.65, "neutral": 0.05}
POSITIVE_EVENTS = ["purchase", "signup"]
NEGATIVE_EVENTS = ["error"]


def platform_of(uid: Column) -> Column:
    """user id -> platform by ``uid % 4`` (the lookup of the data model)."""
    m = F.pmod(uid, F.lit(4))
    return (F.when(m == 0, PLATFORMS[0]).when(m == 1, PLATFORMS[1])
            .when(m == 2, PLATFORMS[2]).otherwise(PLATFORMS[3]))


def label_base_score(label: Column) -> Column:
    return (F.when(label == "positive", F.lit(LABEL_BASE_SCORE["positive"]))
            .when(label == "negative", F.lit(LABEL_BASE_SCORE["negative"]))
            .otherwise(F.lit(LABEL_BASE_SCORE["neutral"])))


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k")


def posts(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One post per event: ids, platform, topic, hashtags, counts, label, score, time, viral flag.

    ``events`` overrides the scan (e.g. a bronze read); its bookkeeping columns ('_' prefix) pass through.
    """
    e = events if events is not None else read_table(spark, sf_dir, "events")
    meta = [c for c in e.columns if c.startswith("_")]
    x = e.select(
        *meta,
        "event_id", "user_id", "ts",
        _k(F.col("props")).cast("int").alias("k"),
        F.floor(F.col("value") * 20).cast("bigint").alias("likes"),
        F.when(F.col("event_type").isin(POSITIVE_EVENTS), "positive")
         .when(F.col("event_type").isin(NEGATIVE_EVENTS), "negative")
         .otherwise("neutral").alias("label"),
    )
    eid, k, likes = F.col("event_id"), F.col("k"), F.col("likes")
    shares = F.floor(likes * (F.lit(5) + eid % 36) / F.lit(100.0)).cast("bigint")
    comments = F.floor(likes * (F.lit(2) + eid % 29) / F.lit(100.0)).cast("bigint")
    t10 = (k % 10).cast("string")
    return x.select(
        F.format_string("POST%08d", eid).alias("post_id"),
        eid.alias("event_id"),
        F.col("user_id"),
        platform_of(F.col("user_id")).alias("platform"),
        F.concat(F.lit("topic_"), t10).alias("topic"),
        F.concat(F.lit("#t"), t10, F.lit("_"), (k % 5).cast("string"),
                 F.lit("|#t"), t10, F.lit("_"), ((k + 2) % 5).cast("string")).alias("hashtags"),
        likes.alias("likes"),
        shares.alias("shares"),
        comments.alias("comments"),
        F.col("label").alias("sentiment_label"),
        (label_base_score(F.col("label")) + ((eid * 7919) % 6001 - 3000) / F.lit(10000.0)).alias("sentiment_score"),
        F.col("ts").alias("posted_at"),
        ((likes + shares) > 5000).alias("is_viral"),
        *meta,
    )


def users(spark: SparkSession, sf_dir: str, customer: DataFrame | None = None) -> DataFrame:
    """One user per customer; nation is a fixed 25-row dimension, so broadcasting it is bounded.

    ``customer`` overrides the scan (e.g. a bronze read); its bookkeeping columns ('_' prefix) pass through.
    """
    c = customer if customer is not None else read_table(spark, sf_dir, "customer")
    meta = [F.col(x) for x in c.columns if x.startswith("_")]
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "inner")
    uid = F.col("c_custkey")
    return j.select(
        uid.alias("user_id"),
        F.col("c_name").alias("username"),
        platform_of(uid).alias("platform"),
        F.when(uid % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("location"),
        F.floor(F.col("c_acctbal") * F.col("c_acctbal") / F.lit(500.0)).cast("bigint").alias("followers"),
        (F.lit(50) + (uid * 37) % 4951).alias("following"),
        (uid % 20 == 0).alias("verified"),
        (F.lit(30) + uid % 3620).alias("account_age_days"),
        F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (uid % len(LANGUAGES) + 1).cast("int")).alias("language"),
        F.concat(F.lower(F.regexp_replace("c_name", "[^A-Za-z0-9]", "")), F.lit("@"),
                 F.lower(F.col("c_mktsegment")), F.lit(".com")).alias("email"),
        *meta,
    )


def api_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    m7 = eid % 7
    return e.select(
        eid.alias("log_id"),
        F.col("ts").alias("log_ts"),
        F.when(F.col("user_id") % 2 == 0, "Twitter").otherwise("Reddit").alias("source"),
        F.concat(F.lit("/api/"), F.col("event_type")).alias("endpoint"),
        F.when(m7 == 4, 429).when(m7 == 5, 404).when(m7 == 6, 500).otherwise(200).cast("bigint").alias("status_code"),
        F.col("value").alias("response_time_ms"),
        _k(F.col("props")).cast("bigint").alias("records_fetched"),
        (eid % 11 == 3).alias("rate_limited"),  # a draw of its own, independent of the status
    )


def explode_hashtags(df: DataFrame, col: str = "hashtags", out: str = "hashtag") -> DataFrame:
    """Pipe-separated tags -> one row per tag. Spark ``split`` takes a regex, so the pipe goes in a class."""
    return df.withColumn(out, F.explode(F.split(F.col(col), "[|]")))


def hashtag_trends_from(p: DataFrame) -> DataFrame:
    """date x hashtag x topic trend table (partial + final hash aggregate; the group key space is small)."""
    x = explode_hashtags(p.select("posted_at", "hashtags", "topic", "likes", "shares",
                                  "sentiment_score", "is_viral"))
    return (x.groupBy(F.to_date("posted_at").alias("trend_date"), "hashtag", "topic")
             .agg(F.count(F.lit(1)).alias("post_count"),
                  F.sum("likes").cast("bigint").alias("total_likes"),
                  F.sum("shares").cast("bigint").alias("total_shares"),
                  avg_round("sentiment_score", 4, 4).alias("avg_sentiment"),
                  F.sum(F.col("is_viral").cast("int")).cast("bigint").alias("viral_count")))


def hashtag_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashtag_trends_from(posts(spark, sf_dir))


def trend_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    eid = F.col("event_id")
    return e.select(
        eid.alias("event_id"),
        F.concat(F.lit("#trend"), (_k(F.col("props")).cast("int") % 12).cast("string")).alias("hashtag"),
        (F.lit(50) + (eid * 31) % 4951).alias("velocity"),
        F.col("ts").alias("event_time"),
    )


ROW_GROUP = 64 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a small table over all cores before costly expressions.

    A table of fewer than one 64 MB piece a core may be a single row group, hence a single task, and costs little to move; a larger
    one has row groups for every core and stays where it is. Rows and results are the same.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores, key) if size < cores * ROW_GROUP else df


def docs(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Documents with a stored label from ``labels`` (quality 1/0 -> positive/negative, unlabelled -> neutral).

    ``dealt``: rows spread over all cores, for work on the texts.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    d = spread(d, "doc_id") if dealt else d
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
         .otherwise("neutral").alias("sentiment_label"),
    )


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens per document, straight from the documents scan (no label join needed)."""
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return d.select("doc_id", tokenize(F.col("text")).alias("tokens"))


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read_table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), tokenize(F.col("text")).alias("tokens"))


def posts_with_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as delivered at-least-once: every 97th event is delivered twice (input for dedup checks)."""
    p = posts(spark, sf_dir)
    return p.unionByName(p.where(F.col("event_id") % 97 == 0))


def users_missing_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with every 37th id absent (input for orphan / referential checks)."""
    u = users(spark, sf_dir)
    return u.where(F.col("user_id") % 37 != 0)
