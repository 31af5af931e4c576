"""Materialise the layers: bronze -> silver -> gold -> warehouse -> named views, each layer written to the
shared folder and read back by the next (so every layer is a durable, re-readable table and lineage is
cut at each boundary). This is the batch flow of the reference as a sequence of Spark writes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidepool.operators import analytics as A
from tidepool.operators import gold, silver
from tidepool.session import scratch_path
from tidepool.sources import bronze, views
from tidepool.sources import warehouse as W

REQUIRED = [("bronze", "events"), ("bronze", "customer"), ("silver", "posts"), ("silver", "users"),
            ("gold", "topic_sentiment"), ("warehouse", "fact_posts"), ("warehouse", "dim_users"),
            ("warehouse", "vw_influencer_impact")]


def materialize_layers(spark: SparkSession, sf_dir: str, root: str | None = None):
    """Write every layer under ``root`` (default: a new folder under spark.checkpoint.dir).

    Returns ({(layer, table): path}, view_status DataFrame).
    """
    root = (root or scratch_path(spark, "layers")).rstrip("/")
    paths: dict[tuple[str, str], str] = {}

    # Bronze: raw rows + ingest stamp, append-only, partitioned by ingest date.
    for name in ("events", "customer"):
        p = f"{root}/bronze/{name}"
        bronze.write_bronze(bronze.stamp(bronze.read_raw(spark, sf_dir, name)), p)
        paths[("bronze", name)] = p
    b_events = spark.read.parquet(paths[("bronze", "events")]).drop("_ingest_date")
    b_customer = spark.read.parquet(paths[("bronze", "customer")]).drop("_ingest_date")

    # Silver: cleaned and enriched, from the bronze tables; posts partitioned by day.
    posts = views.posts(spark, sf_dir, events=b_events)
    s = {"posts": silver.silver_posts(posts),
         "users": silver.silver_users(views.users(spark, sf_dir, customer=b_customer)),
         "hashtag_trends": silver.silver_hashtag_trends(views.hashtag_trends_from(posts)),
         "api_logs": silver.silver_api_logs(views.api_logs(spark, sf_dir))}
    for name, p in W.write_layer(s, f"{root}/silver", partition_by={"posts": ["post_date"]}).items():
        paths[("silver", name)] = p
    sp = spark.read.parquet(paths[("silver", "posts")])
    su = spark.read.parquet(paths[("silver", "users")])
    sh = spark.read.parquet(paths[("silver", "hashtag_trends")])
    sl = spark.read.parquet(paths[("silver", "api_logs")])

    # Gold: aggregates over silver.
    g = {"topic_sentiment": gold.topic_sentiment(sp), "daily_trend": gold.daily_trend(sp),
         "platform_perf": gold.platform_perf(sp), "top_influencers": gold.top_influencers(sp, su),
         "hourly_pattern": gold.hourly_pattern(sp)}
    for name, p in W.write_layer(g, f"{root}/gold").items():
        paths[("gold", name)] = p

    # Warehouse: star schema, then the named analytic views over it.
    wh = {"fact_posts": W.fact_posts(sp), "dim_users": W.dim_users(su), "stg_api_logs": W.stg_api_logs(sl),
          "fact_hashtag_trends": W.fact_hashtag_trends(sh), "dim_date": W.dim_date(sp),
          "dim_topics": W.dim_topics(sp)}
    for name, p in W.write_layer(wh, f"{root}/warehouse", partition_by={"fact_posts": ["post_date"]}).items():
        paths[("warehouse", name)] = p
    tables = {n: spark.read.parquet(paths[("warehouse", n)])
              for n in ("fact_posts", "dim_users", "stg_api_logs", "fact_hashtag_trends")}
    results, status = A.run_named_views(spark, tables, out_root=f"{root}/warehouse")
    for name in results:
        paths[("warehouse", name)] = f"{root}/warehouse/{name}"
    return paths, status
