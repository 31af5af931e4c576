"""Catalog: row-level operators (dedup, sampling, joins, defaults, parsing), bronze ingest, outputs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import gold
from tidepool.operators.dedup import keep_first, sample_fraction, sample_n
from tidepool.plans.common import s_api_logs, s_hashtag_trends, s_posts, s_users
from tidepool.plans.registry import query
from tidepool.session import scratch_path
from tidepool.sources import bronze, views
from tidepool.sources import warehouse as W
from tidepool.sources.tables import read_table


@query("dedup_posts", """
select * exclude (rn) from (select *, row_number() over (partition by post_id order by posted_at, event_id) as rn
                            from posts_with_replays) where rn = 1""")
def q_dedup_posts(spark, sf):
    return keep_first(views.posts_with_replays(spark, sf), ["post_id"], ["posted_at", "event_id"])


@query("sample_frac", """
select * from posts
where cast(('0x' || substring(md5('42:' || post_id), 1, 8)) as bigint) < 85899346""")
def q_sample_frac(spark, sf):
    return sample_fraction(views.posts(spark, sf), "post_id", 0.02)


@query("sample_n", """
select * from posts order by md5('42:' || post_id), post_id limit 5000""")
def q_sample_n(spark, sf):
    return sample_n(views.posts(spark, sf), "post_id", 5000)


@query("join_left_users", """
select p.post_id, p.user_id, u.username, u.followers, u.follower_tier, u.verified, u.location
from posts p left join s_users u on p.user_id = u.user_id""")
def q_join_left_users(spark, sf):
    u = s_users(spark, sf).select("user_id", "username", "followers", "follower_tier", "verified", "location")
    return views.posts(spark, sf).select("post_id", "user_id").join(u, "user_id", "left")


@query("join_lookup_default", """
select p.post_id, p.user_id, coalesce(u.platform, 'Twitter') as user_platform
from posts p left join users u on p.user_id = u.user_id""")
def q_join_lookup_default(spark, sf):
    u = views.users(spark, sf).select("user_id", F.col("platform").alias("_up"))
    j = views.posts(spark, sf).select("post_id", "user_id").join(u, "user_id", "left")
    return j.select("post_id", "user_id", F.coalesce(F.col("_up"), F.lit("Twitter")).alias("user_platform"))


_EVENT_SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType()), T.StructField("topic", T.StringType()),
    T.StructField("platform", T.StringType()), T.StructField("sentiment_label", T.StringType()),
    T.StructField("sentiment_score", T.DoubleType()), T.StructField("likes", T.LongType()),
    T.StructField("is_viral", T.BooleanType())])


@query("event_defaults", """
select event_id, event_type, cast(json_extract_string(props, '$.k') as integer) as k,
  coalesce(json_extract_string(props, '$.topic'), 'Unknown') as topic,
  coalesce(json_extract_string(props, '$.platform'), 'Unknown') as platform,
  coalesce(json_extract_string(props, '$.sentiment_label'), 'neutral') as sentiment_label,
  coalesce(cast(json_extract_string(props, '$.sentiment_score') as double), 0.0) as sentiment_score,
  coalesce(cast(json_extract_string(props, '$.likes') as bigint), 0) as likes,
  coalesce(cast(json_extract_string(props, '$.is_viral') as boolean), false) as is_viral
from events""")
def q_event_defaults(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", "event_type",
                                               F.from_json("props", _EVENT_SCHEMA).alias("m"))
    return e.select("event_id", "event_type", F.col("m.k").alias("k"),
                    F.coalesce("m.topic", F.lit("Unknown")).alias("topic"),
                    F.coalesce("m.platform", F.lit("Unknown")).alias("platform"),
                    F.coalesce("m.sentiment_label", F.lit("neutral")).alias("sentiment_label"),
                    F.coalesce("m.sentiment_score", F.lit(0.0)).alias("sentiment_score"),
                    F.coalesce("m.likes", F.lit(0).cast("bigint")).alias("likes"),
                    F.coalesce("m.is_viral", F.lit(False)).alias("is_viral"))


@query("parse_timestamps", """
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as raw_ts,
  strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as parsed_ts, true as is_valid
from events""")
def q_parse_timestamps(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("raw_ts"))
    parsed = F.try_to_timestamp(F.col("raw_ts"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return e.select("event_id", "raw_ts", parsed.alias("parsed_ts"), parsed.isNotNull().alias("is_valid"))


@query("bronze_ingest", """
select *, 'events.parquet' as source_name, '1.0' as _pipeline_version, true as stamped from events""")
def q_bronze_ingest(spark, sf):
    """Land the raw event rows unchanged, stamped; a source that is missing is recorded and skipped."""
    root = scratch_path(spark, "bronze")
    landed, status = bronze.ingest(spark, sf, ["events", "no_such_source"], root)
    assert {r["source"]: r["landed"] for r in status.collect()} == {"events": True, "no_such_source": False}
    e = spark.read.parquet(landed["events"])
    return e.select(*read_table(spark, sf, "events").columns,
                    F.regexp_extract("_source_file", r"/([^/]*[.]parquet)(?:/[^/]*)?$", 1).alias("source_name"),
                    "_pipeline_version", F.col("_ingested_at").isNotNull().alias("stamped"))


_LAYER_TABLES = {
    ("silver", "users"): "s_users", ("silver", "posts"): "s_posts",
    ("silver", "hashtag_trends"): "s_hashtag_trends", ("silver", "api_logs"): "s_api_logs",
}
_GOLD_SQL = {
    "topic_sentiment": "select count(*) from (select 1 from s_posts group by topic, sentiment_label)",
    "daily_trend": "select count(*) from (select 1 from s_posts group by post_date, topic)",
    "platform_perf": "select count(*) from (select 1 from s_posts group by platform)",
    "hourly_pattern": "select count(*) from (select 1 from s_posts group by post_hour, platform)",
}


def _write_outputs(spark, sf):
    root = scratch_path(spark, "outputs")
    sp = s_posts(spark, sf)
    silver = {"users": s_users(spark, sf), "posts": sp, "hashtag_trends": s_hashtag_trends(spark, sf),
              "api_logs": s_api_logs(spark, sf)}
    goldt = {"topic_sentiment": gold.topic_sentiment(sp), "daily_trend": gold.daily_trend(sp),
             "platform_perf": gold.platform_perf(sp), "hourly_pattern": gold.hourly_pattern(sp)}
    paths = {}
    for layer, tables in (("silver", silver), ("gold", goldt)):
        for name, p in W.write_layer(tables, f"{root}/{layer}").items():
            paths[(layer, name)] = p
    paths[("gold", "missing_example")] = f"{root}/gold/never_written"
    return paths


_INV_SQL = "\nunion all ".join(
    [f"select '{l}' as layer, '{t}' as \"table\", true as present, (select count(*) from {v}) as rows"
     for (l, t), v in _LAYER_TABLES.items()]
    + [f"select 'gold', '{t}', true, ({q})" for t, q in _GOLD_SQL.items()]
    + ["select 'gold', 'missing_example', false, 0"])


@query("table_inventory", _INV_SQL)
def q_table_inventory(spark, sf):
    inv = W.table_inventory(spark, _write_outputs(spark, sf))
    return inv.select("layer", "table", "present", "rows")


@query("validate_outputs", """
select * from (values ('silver', 'posts', true), ('gold', 'topic_sentiment', true),
                      ('gold', 'missing_example', false)) t(layer, "table", present)""")
def q_validate_outputs(spark, sf):
    inv = W.table_inventory(spark, _write_outputs(spark, sf))
    required = spark.createDataFrame([("silver", "posts"), ("gold", "topic_sentiment"), ("gold", "missing_example")],
                                     "layer string, table string")
    missing = W.missing_outputs(required, inv).withColumn("_missing", F.lit(True))
    return required.join(missing, ["layer", "table"], "left").select(
        "layer", "table", F.col("_missing").isNull().alias("present"))
