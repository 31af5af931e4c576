"""Star-schema tables (facts, dimensions), layer sinks, output inventory and validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.ranking import global_row_number

# The columns of the star schema.
FACT_POST_COLUMNS = ["post_id", "user_id", "platform", "topic", "sentiment_label", "sentiment_score", "likes",
                     "shares", "comments", "engagement_score", "is_viral", "is_prime_time", "post_date",
                     "post_hour", "post_month", "post_year"]
DIM_USER_COLUMNS = ["user_id", "username", "location", "followers", "following", "follower_tier",
                    "is_influencer", "verified", "account_age_days", "language"]
STG_API_COLUMNS = ["log_id", "log_ts", "source", "endpoint", "status_code", "response_time_ms",
                   "records_fetched", "is_error", "is_rate_limited", "hour"]


def _bool_as_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("int").alias(c) if c in cols else F.col(c) for c in df.columns])


def fact_posts(silver_posts: DataFrame) -> DataFrame:
    return _bool_as_int(silver_posts.select(*FACT_POST_COLUMNS), ["is_viral", "is_prime_time"])


def dim_users(silver_users: DataFrame) -> DataFrame:
    return _bool_as_int(silver_users.select(*DIM_USER_COLUMNS), ["is_influencer", "verified"])


def stg_api_logs(silver_logs: DataFrame) -> DataFrame:
    return _bool_as_int(silver_logs.select(*STG_API_COLUMNS), ["is_error", "is_rate_limited"])


def fact_hashtag_trends(silver_trends: DataFrame) -> DataFrame:
    return silver_trends


def dim_date(dates: DataFrame, col: str = "post_date") -> DataFrame:
    """Calendar dimension covering [min, max] of ``col`` (one row per day, generated from a one-row range)."""
    rng = dates.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    d = rng.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    return d.select(
        F.date_format("d", "yyyy-MM-dd").alias("date_id"),
        F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"),
        F.date_format("d", "EEEE").alias("weekday"),
        (F.weekday("d") >= 5).cast("int").alias("is_weekend"),
    )


def dim_topics(posts: DataFrame) -> DataFrame:
    """Topic dimension: surrogate ids in topic-name order, category unknown (null)."""
    t = posts.select(F.col("topic").alias("topic_name")).where(F.col("topic_name").isNotNull()).distinct()
    numbered = global_row_number(t, [F.col("topic_name")], out="topic_id")
    return numbered.select("topic_id", "topic_name", F.lit(None).cast("string").alias("category"))


def write_layer(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet",
                partition_by: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Overwrite one folder per table under ``root`` (Parquet by default, headered CSV on request).

    ``partition_by`` names Hive-style partition columns per table (e.g. a date), so later date filters
    prune whole folders.
    """
    out = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        keys = list(partition_by.get(name, ())) if partition_by else []
        if keys:  # rows of a folder meet in a few tasks (rebalanced by size), not one small file from every task
            df = df.hint("rebalance", *keys)
        w = df.write.mode("overwrite")
        if keys:
            w = w.partitionBy(*keys)
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.parquet(path)
        out[name] = path
    return out


def read_csv_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with a declared schema; a malformed row is kept, with its text in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))


def table_inventory(spark: SparkSession, tables: Mapping[tuple[str, str], str]) -> DataFrame:
    """(layer, table, exists, files, bytes, rows) for Parquet outputs, computed by Spark from the files.

    Row counts come from the Parquet footers (a metadata-only count); sizes from the file metadata column.
    """
    parts = []
    for (layer, name), path in tables.items():
        try:
            df = spark.read.parquet(path)
        except Exception:  # noqa: BLE001 - a missing output is reported, not fatal
            parts.append(spark.createDataFrame([(layer, name, False, 0, 0, 0)],
                                               "layer string, table string, present boolean, files long, "
                                               "bytes long, rows long"))
            continue
        files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
        agg = files.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.first("s").alias("s")).agg(
            F.count(F.lit(1)).alias("files"), F.sum("s").alias("bytes"), F.sum("n").alias("rows"))
        parts.append(agg.select(F.lit(layer).alias("layer"), F.lit(name).alias("table"),
                                F.lit(True).alias("present"), F.col("files").cast("long"),
                                F.col("bytes").cast("long"), F.col("rows").cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_outputs(required: DataFrame, inventory: DataFrame) -> DataFrame:
    """Required (layer, table) pairs that are absent from the inventory."""
    present = inventory.where("present").select("layer", "table")
    return required.join(present, ["layer", "table"], "left_anti")


def validate_outputs(required: DataFrame, inventory: DataFrame) -> None:
    """Raise listing every missing output (the check itself runs in Spark; only the missing list returns)."""
    missing = missing_outputs(required, inventory)
    rows = missing.collect()  # a subset of the fixed list of required outputs
    if rows:
        raise FileNotFoundError(f"Missing outputs: {[(r.layer, r.table) for r in rows]}")
