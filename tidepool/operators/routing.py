"""Topic partitions as data: routing, per-partition offsets, bounded consumer reads, lag and stats.

A topic is a DataFrame of messages with a ``partition`` and an ``offset`` column (what a Kafka source
exposes). Offsets are global row numbers over (partition, order) minus the partition's start, so no
window ever holds a whole partition in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.hashing import keyless_partition, md5_mod
from tidepool.operators.ranking import global_row_number


def route(df: DataFrame, key: str, n: int, out: str = "partition") -> DataFrame:
    """Partition by the md5 of the key; messages without a key are spread by their content."""
    return df.withColumn(out, F.when(F.col(key).isNotNull(), md5_mod(F.col(key), n))
                         .otherwise(keyless_partition(n, *[F.col(c) for c in df.columns])))


def with_offsets(df: DataFrame, order: Sequence[Column | str], part: str = "partition",
                 out: str = "offset") -> DataFrame:
    """0-based, gap-free offsets within each partition in ``order`` (append order of the log)."""
    cols = [F.col(part)] + [F.col(c) if isinstance(c, str) else c for c in order]
    numbered = global_row_number(df, cols, out="_g")
    counts = df.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    starts = counts.select(part, F.coalesce(F.sum("_n").over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    j = numbered.join(F.broadcast(starts), part)
    return j.withColumn(out, F.col("_g") - F.col("_start") - 1).drop("_g", "_start")


def end_offsets(topic: DataFrame, part: str = "partition") -> DataFrame:
    """Next offset to be written per partition (= messages in the partition)."""
    return topic.groupBy(part).agg(F.count(F.lit(1)).alias("end_offset"))


def read_range(topic: DataFrame, start: int, limit: int, part: str = "partition", offset: str = "offset") -> DataFrame:
    """The messages of every partition from offset ``start`` on, at most ``limit`` of each."""
    return topic.where((F.col(offset) >= start) & (F.col(offset) < start + limit))


def consumer_lag(ends: DataFrame, commits: DataFrame, part: str = "partition") -> DataFrame:
    """Lag = end offset - committed offset; a partition without a commit counts from 0."""
    j = ends.join(commits, part, "left")
    return j.select(part, "end_offset", F.coalesce(F.col("committed"), F.lit(0)).cast("bigint").alias("committed"),
                    (F.col("end_offset") - F.coalesce(F.col("committed"), F.lit(0))).cast("bigint").alias("lag"))


def topic_stats(topic: DataFrame, part: str = "partition") -> DataFrame:
    """Messages per partition and the topic total (the total is a window over one row per partition)."""
    c = end_offsets(topic, part).withColumnRenamed("end_offset", "messages")
    return c.withColumn("total_messages", F.sum("messages").over(Window.partitionBy()))


def kafka_records(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows in the shape a Kafka sink takes: string key, JSON value, and the md5-routed partition."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
                     md5_mod(F.col(key), n).alias("partition"))


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Batch write of ``kafka_records`` output (needs the Kafka connector on the classpath; untested here)."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
