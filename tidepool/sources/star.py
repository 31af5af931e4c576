"""The star schema as catalog tables: facts and dimensions bucketed by the join key, so that fact and dimension join in place."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import scratch_path

PREFIX = "star_"
BUCKETS = 16
#: The tables, their key, the key they are bucketed by, and the dimension a column refers to.
KEYS = {"fact_posts": "post_id", "fact_hashtag_trends": None, "dim_users": "user_id", "dim_date": "date_id",
        "dim_topics": "topic_id", "stg_api_logs": "log_id"}
BUCKETED = {"fact_posts": "user_id", "dim_users": "user_id"}
REFERS = {"fact_posts": ("user_id", "dim_users")}


def create_tables(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = PREFIX, buckets: int = BUCKETS,
                  root: str | None = None) -> dict[str, str]:
    """Write each table under ``root`` and register it as ``prefix`` + name, replacing one of that name. Returns the catalog names.

    Tables of ``BUCKETED`` are clustered by their key before the write, so a bucket is one file, sorted.
    """
    root = (root or scratch_path(spark, "star")).rstrip("/")
    out = {}
    for name, df in tables.items():
        out[name] = full = f"{prefix}{name}"
        spark.sql(f"drop table if exists {full}")
        key = BUCKETED.get(name)
        rows = df.repartition(buckets, key) if key else df
        writer = rows.write.mode("overwrite").format("parquet").option("path", f"{root}/{name}")
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(full)
    return out


def describe(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """(table, columns, rows, key_violations, orphans) of each catalog table: null or repeated keys, references without a row."""
    parts = []
    for name, full in names.items():
        df = spark.table(full)
        listed = F.lit(",".join(df.columns))
        key = KEYS.get(name)
        if key is None:
            held = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("key_violations"))
        else:
            per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            held = per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
                           F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n")).otherwise(F.col("n") - 1)), F.lit(0))
                           .cast("long").alias("key_violations"))
        if name in REFERS:
            col, dim = REFERS[name]
            lost = df.join(spark.table(names[dim]), col, "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
            held = held.crossJoin(lost)  # one row each
        else:
            held = held.withColumn("orphans", F.lit(0).cast("long"))
        parts.append(held.select(F.lit(name).alias("table"), listed.alias("columns"), "rows", "key_violations", "orphans"))
    return reduce(DataFrame.unionByName, parts)


def posts_with_users(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """Fact joined to dimension on the key both are bucketed by: no exchange."""
    return spark.table(names["fact_posts"]).join(spark.table(names["dim_users"]), "user_id")
