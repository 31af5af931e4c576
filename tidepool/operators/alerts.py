"""Batch (replay) forms of the stream's windowed sentiment checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.ranking import trailing_mean_global

ALERT_TYPE = "NEGATIVE_SENTIMENT_SPIKE"
ALERT_WINDOW = 20
ALERT_THRESHOLD = -0.5
LAST_N = 100
ALERT_SCHEMA = T.StructType([T.StructField("alert_type", T.StringType()), T.StructField("post_id", T.StringType()),
                             T.StructField("topic", T.StringType()), T.StructField("window_avg", T.DoubleType()),
                             T.StructField("trigger_time", T.TimestampNTZType())])


def negative_spikes(events: DataFrame, by: Sequence[str] = ("topic",), threshold: float = ALERT_THRESHOLD,
                    width: int = ALERT_WINDOW, order: Sequence[str] = ("posted_at", "event_id"),
                    bucket_rows: int = 1 << 16, keep: Sequence[str] = ()) -> DataFrame:
    """One alert per event whose trailing ``width`` scores (full window only) average strictly below
    ``threshold``. ``by=()`` is one global window, as a single consumer sees the stream. A missing score counts
    as 0; ``keep`` names further columns to return."""
    # Scores carry 4 decimals; averaging them as decimals keeps the mean exact, so the threshold test
    # and the 4-place rounding do not depend on the order of floating-point additions.
    # Only what the window needs crosses the range shuffle and the checkpoint (pruning stops at an
    # eager checkpoint, so project first).
    cols = list(dict.fromkeys(["post_id", "topic", "posted_at", *order, *by, *keep]))
    ev = events.select(*cols, F.coalesce("sentiment_score", F.lit(0.0)).cast("decimal(18,4)").alias("_s"))
    t = trailing_mean_global(ev, "_s", list(order), width, partition_by=list(by),
                             bucket_rows=bucket_rows, out="_m", count_out="_c")
    hit = t.where((F.col("_c") == width) & (F.col("_m") < F.lit(threshold).cast("decimal(18,4)")))
    return hit.select(F.lit(ALERT_TYPE).alias("alert_type"), "post_id", "topic",
                      F.round("_m", 4).cast("double").alias("window_avg"), F.col("posted_at").alias("trigger_time"),
                      *keep)


def last_n_mean(events: DataFrame, n: int = LAST_N, order: Sequence[str] = ("posted_at", "event_id")) -> DataFrame:
    """Mean of the newest ``n`` scores (0.0 when empty), rounded to 4; newest-n is a top-k per task."""
    top = events.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return top.agg(F.round(F.coalesce(F.avg("sentiment_score"), F.lit(0.0)), 4).alias("window_sentiment"),
                   F.count(F.lit(1)).alias("window_size"))
