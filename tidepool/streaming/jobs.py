"""Structured Streaming jobs over the post and trend streams.

Sources are file streams over the driver's ``events`` table, one file or a folder of any number of files
(a Kafka source takes the same transforms: see ``kafka_source``). Every job runs with a checkpoint under the
shared checkpoint folder, so a restart continues from the last committed batch; sinks are Parquet (exactly-once
file sink) or ``foreachBatch`` writes into one folder per batch id, so a replayed batch replaces only itself.

Event time decides, not arrival: rows are sealed by Spark's watermark, whose delay is measured from the files' own
disorder (``measured_delay``), so a folder in time order keeps little state and a shuffled one loses nothing. Windows over the last N rows
are native batch windows over the sealed rows of each micro-batch and a small carried table, the newest rows of each key, written
per batch id: a hot key is split over tasks like any other rows, and no Python runs. State is kept on disk (RocksDB).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidepool.operators import alerts as AL
from tidepool.session import scratch_path
from tidepool.sources import views
from tidepool.sources.tables import SCHEMAS

MAX_FILES_CONF = "spark.tidepool.maxFilesPerTrigger"
MAX_FILES = 64
POST_EVENT = "post_created"
VIRAL_LIKES_STREAM = 5000  # stream messages flag virality on likes alone (the batch rule adds shares)


# ---- sources -----------------------------------------------------------------------------------------

def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None,
                 end: str | None = None) -> DataFrame:
    """Streaming scan of the ``events`` table, stored as one file or as a folder of files.

    The path is written as a glob of itself because a plain single-file path cannot stream. ``end`` is a folder
    for an end-of-input marker (see ``open_end``, ``write_end``): a marker row moves the watermark past all data.
    """
    files = max_files_per_trigger or int(spark.conf.get(MAX_FILES_CONF, str(MAX_FILES)))

    def scan(path: str) -> DataFrame:
        return spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", files).parquet(path)

    events = scan(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return events.unionByName(scan(end)) if end else events


END_OF_TIME = dt.datetime(9999, 1, 1)
SLACK = dt.timedelta(minutes=10)


def open_end(spark: SparkSession) -> str:
    """An empty folder that a stream watches for its end-of-input marker."""
    folder = scratch_path(spark, "end-of-input")
    spark.createDataFrame([], SCHEMAS["events"]).write.parquet(folder)
    return folder


def write_end(spark: SparkSession, folder: str, at: dt.datetime = END_OF_TIME) -> None:
    """The marker: one row of the time ``at``, which moves the watermark past all data less the delay."""
    spark.createDataFrame([(-1, at, -1, "end_of_input", 0.0, '{"k": 0}')], SCHEMAS["events"]).write.mode("append").parquet(folder)


def disorder(events: DataFrame) -> tuple[dt.timedelta, dt.datetime | None]:
    """How far a file's oldest row lies behind the newest row of the files read before it, at most; and the newest time of all.

    A file source reads files by their time of writing; files of equal time count as read in either order. One pass over
    the time column alone, to one row per file (the window runs over these). Zero where files follow one another in time.
    """
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    written = F.unix_millis("_metadata.file_modification_time")
    files = events.groupBy(F.col("_metadata.file_path").alias("file"), written.alias("written")).agg(
        F.min(us).alias("low"), F.max(us).alias("top"))
    earlier = Window.orderBy("written").rangeBetween(Window.unboundedPreceding, -1)
    peers = Window.partitionBy("written").orderBy(F.col("top").desc(), "file")
    seen = files.select(
        "low", "top", F.max("top").over(earlier).alias("earlier"),
        F.when(F.row_number().over(peers) == 1, F.lead("top").over(peers)).otherwise(F.first("top").over(peers)).alias("peer"))
    got = seen.agg(F.max(F.greatest("earlier", "peer") - F.col("low")).alias("back"), F.max("top").alias("top")).first()
    newest = None if got["top"] is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=got["top"])
    return dt.timedelta(microseconds=max(got["back"] or 0, 0)), newest


def delay_of(back: dt.timedelta, slack: dt.timedelta = SLACK) -> str:
    return f"{(back + slack) // dt.timedelta(microseconds=1)} microseconds"


def measured_delay(spark: SparkSession, sf_dir: str, slack: dt.timedelta = SLACK) -> str:
    """A watermark delay that no row of the ``events`` table is behind: the measured disorder of its files and ``slack``."""
    from tidepool.sources.tables import read_table

    return delay_of(disorder(read_table(spark, sf_dir, "events"))[0], slack)


def post_messages(events: DataFrame) -> DataFrame:
    """social-posts messages: the canonical post row, event type, stream viral rule, event time as timestamp.

    ``withWatermark`` needs TIMESTAMP (the driver's columns are TIMESTAMP_NTZ), hence the cast.
    """
    p = views.posts(events.sparkSession, "", events=events)
    return p.select(
        F.lit(POST_EVENT).alias("event_type"), "post_id", "event_id", "user_id", "platform", "topic",
        "sentiment_label", "sentiment_score", "likes", "shares", "comments",
        (F.col("likes") > VIRAL_LIKES_STREAM).alias("is_viral"),
        F.col("posted_at").cast("timestamp").alias("event_time"),
        F.col("posted_at"))


def trend_messages(events: DataFrame) -> DataFrame:
    """hashtag-trends messages derived from 'view' events."""
    e = events.where(F.col("event_type") == "view")
    eid = F.col("event_id")
    return e.select(
        eid.alias("event_id"),
        F.concat(F.lit("#trend"), (F.get_json_object("props", "$.k").cast("int") % 12).cast("string")).alias("hashtag"),
        (F.lit(50) + (eid * 31) % 4951).alias("velocity"),
        F.col("ts").cast("timestamp").alias("event_time"))


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int = 200) -> DataFrame:
    """Kafka form of a source (needs the Kafka connector on the classpath; not available in tests).

    ``maxOffsetsPerTrigger`` bounds each micro-batch, the back-pressure knob of a bounded poll.
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("maxOffsetsPerTrigger", max_offsets_per_trigger).load())


# ---- running the jobs ---------------------------------------------------------------------------------

@dataclass
class RunResult:
    path: str
    checkpoint: str


STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(writer, checkpoint: str):
    """Start over the available input. State goes to RocksDB unless the session names a store itself."""
    conf = SparkSession.active().conf
    named = conf.get(STORE_CONF, None)
    if named is None or named.endswith("HDFSBackedStateStoreProvider"):
        conf.set(STORE_CONF, ROCKSDB)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class ProgressLog(StreamingQueryListener):
    """What Spark reports of every micro-batch while the log is open: input rows, state rows, rows dropped as late.

    A listener hears of each batch, where ``recentProgress`` forgets all but the last ones.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.batches, self._begun, self._ended = spark, [], set(), set()

    def onQueryStarted(self, event) -> None:
        self._begun.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append({"run": str(p.runId), "batch": p.batchId, "rows": p.numInputRows,
                             "state_rows": max((s.numRowsTotal for s in p.stateOperators), default=0),
                             "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
                             "observed": {k: r.asDict() for k, r in p.observedMetrics.items()}})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.runId))

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        until = time.monotonic() + 30  # events come behind the queries' own end
        while (not self._begun or self._begun - self._ended) and time.monotonic() < until:
            time.sleep(0.02)
        self.spark.streams.removeListener(self)


def _batches(spark: SparkSession, root: str) -> list[int]:
    """Ids of the batches completely written under ``root`` (one folder ``batch=<id>`` each)."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    names = [f.getPath() for f in fs.listStatus(top) if f.isDirectory()]
    return sorted(int(p.getName().split("=")[1]) for p in names
                  if p.getName().startswith("batch=")
                  and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of all batches under ``root``."""
    if not _batches(spark, root):
        return spark.createDataFrame([], schema)
    kept = [f"{root}/batch={b}" for b in _batches(spark, root)]
    return spark.read.schema(schema).parquet(*kept)


def _state(spark: SparkSession, root: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The table that the last batch (before ``before``) left under ``root``; empty if there is none."""
    done = [b for b in _batches(spark, root) if before is None or b < before]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/batch={done[-1]}")


def run_batches(df: DataFrame, name: str, step: Callable[[DataFrame, int, str], None], mode: str = "append",
                checkpoint: str | None = None, path: str | None = None) -> RunResult:
    """``step(batch, batch_id, path)`` for every micro-batch of the available input."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    q = _start(df.writeStream.outputMode(mode).foreachBatch(lambda b, i: step(b, i, path)), checkpoint)
    q.awaitTermination()
    return RunResult(path, checkpoint)


def run_snapshot(df: DataFrame, name: str, finish: Callable[[DataFrame], DataFrame] | None = None,
                 checkpoint: str | None = None, path: str | None = None) -> RunResult:
    """Complete-mode aggregate; each batch writes a snapshot of the (small, keyed) result to its own folder."""
    def step(batch: DataFrame, batch_id: int, to: str) -> None:
        write_batch(finish(batch) if finish else batch, to, batch_id)

    return run_batches(df, name, step, "complete", checkpoint, path)


def read_snapshot(spark: SparkSession, r: RunResult) -> DataFrame:
    """The last complete snapshot."""
    return spark.read.parquet(f"{r.path}/batch={_batches(spark, r.path)[-1]}")


def run_append(df: DataFrame, name: str, checkpoint: str | None = None, path: str | None = None,
               end: str | None = None, until: dt.datetime = END_OF_TIME) -> RunResult:
    """Append-mode job into the exactly-once Parquet file sink.

    With ``end`` (the folder given to ``event_stream``) the input is bounded: after its last file the end marker, of time ``until``,
    is written and the job runs on, so that windows still open behind the watermark come out too.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    for last in ([False, True] if end else [False]):
        if last:
            write_end(spark, end, until)
        q = _start(df.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)
        q.awaitTermination()
    return RunResult(path, checkpoint)


def read_result(spark: SparkSession, r: RunResult, schema: T.StructType | None = None) -> DataFrame:
    rd = spark.read.schema(schema) if schema is not None else spark.read
    return rd.parquet(r.path)


# ---- running aggregates -------------------------------------------------------------------------------

def topic_counts(posts: DataFrame) -> DataFrame:
    """Running topic x label counts over the whole stream (state: one row per key)."""
    named = posts.where(F.col("event_type") == POST_EVENT).select(
        F.coalesce("topic", F.lit("Unknown")).alias("topic"), F.coalesce("sentiment_label", F.lit("neutral")).alias("sentiment_label"))
    return named.groupBy("topic", "sentiment_label").agg(F.count(F.lit(1)).alias("count"))


def platform_stats(posts: DataFrame) -> DataFrame:
    """Running per-platform posts, likes, virals and sentiment sum (avg is derived at read time)."""
    p = posts.where(F.col("event_type") == POST_EVENT)
    return p.groupBy(F.coalesce("platform", F.lit("Unknown")).alias("platform")).agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum(F.coalesce("likes", F.lit(0))).cast("bigint").alias("total_likes"),
        F.sum(F.coalesce("is_viral", F.lit(False)).cast("int")).cast("bigint").alias("viral_posts"),
        F.sum(F.coalesce("sentiment_score", F.lit(0.0)).cast("decimal(18,4)")).alias("sentiment_sum"))


def finish_platform_stats(snapshot: DataFrame) -> DataFrame:
    return snapshot.select("platform", "posts", "total_likes", "viral_posts",
                           F.round(F.col("sentiment_sum") / F.greatest(F.col("posts"), F.lit(1)).cast("decimal(38,0)"), 4)
                           .cast("double").alias("avg_sentiment"))


def hashtag_velocity(trends: DataFrame) -> DataFrame:
    return trends.groupBy(F.coalesce("hashtag", F.lit("")).alias("hashtag")).agg(
        F.sum(F.coalesce("velocity", F.lit(0))).cast("bigint").alias("velocity"),
        F.count(F.lit(1)).alias("messages"))


def leaderboard(snapshot: DataFrame, n: int = 10) -> DataFrame:
    return snapshot.select("hashtag", "velocity").orderBy(F.col("velocity").desc(), F.col("hashtag")).limit(n)


# ---- event-time windows -------------------------------------------------------------------------------

def tumbling_counts(posts: DataFrame, width: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    w = F.window("event_time", width)
    g = posts.withWatermark("event_time", delay).groupBy(w.alias("w"), "topic").agg(
        F.count(F.lit(1)).alias("posts"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "topic", "posts")


def sliding_stats(posts: DataFrame, width: str = "10 minutes", slide: str = "1 minute",
                  delay: str = "10 minutes") -> DataFrame:
    w = F.window("event_time", width, slide)
    g = posts.withWatermark("event_time", delay).groupBy(w.alias("w"), "topic").agg(
        F.count(F.lit(1)).alias("posts"), F.sum(F.col("likes")).cast("bigint").alias("likes"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "topic", "posts", "likes")


def dedup_within_watermark(posts: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """At-least-once input made unique by post_id; state for a key is kept only while within the delay."""
    return posts.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["post_id"])


# ---- windows over the last N rows ---------------------------------------------------------------------

_FIELDS = ["topic", "post_id", "event_id", "posted_at", "sentiment_score"]
_ROW = T.StructType([T.StructField("topic", T.StringType()), T.StructField("post_id", T.StringType()),
                     T.StructField("event_id", T.LongType()), T.StructField("posted_at", T.TimestampNTZType()),
                     T.StructField("sentiment_score", T.DoubleType())])
EVENT_ORDER = ("posted_at", "event_id")
SHARDS = 32


def _rows(posts: DataFrame) -> DataFrame:
    """What the windows need of the posts. A missing score counts as 0; end markers are left out."""
    return posts.where((F.col("event_type") == POST_EVENT) & (F.col("event_id") >= 0)).select(
        *_FIELDS[:-1], F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score"))


def _newest(rows: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """The ``n`` newest rows of each key; tasks cut their own rows to n per key first."""
    down = [F.col(c).desc() for c in EVENT_ORDER]
    if not by:
        return rows.orderBy(*down).limit(n)
    w = Window.partitionBy(*by).orderBy(*down)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def sealed(posts: DataFrame, delay: str, width: str = "1 minute", shards: int = SHARDS) -> DataFrame:
    """Rows in sealed pieces of event time: those of a ``width`` come out together once the watermark has passed it.

    Each micro-batch of the result is thus newer than all before it, whatever order rows arrive in. Until then Spark's state store holds them,
    a piece of time in ``shards`` rows, so that a busy minute is spread over tasks.
    """
    piece = F.struct(*_FIELDS[:-1], F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score"))
    held = (posts.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", width).alias("w"), F.pmod("event_id", F.lit(shards)).alias("shard"))
            .agg(F.collect_list(F.when(F.col("event_type") == POST_EVENT, piece)).alias("rows")))
    return held.select(F.explode("rows").alias("r")).select("r.*")


def spikes_step(by: Sequence[str] = ("topic",), width: int = 20, threshold: float = -0.5):
    """Alerts of one micro-batch of ``sealed`` rows: one per event whose last ``width`` scores average below ``threshold``.

    Carried per batch: the newest ``width - 1`` rows of each key.
    """
    def step(rows: DataFrame, batch_id: int, path: str) -> None:
        spark = rows.sparkSession
        rows = rows.persist()
        try:
            if rows.isEmpty():
                return
            before = _state(spark, f"{path}/carried", _ROW, batch_id)
            every = rows.withColumn("new", F.lit(True)).unionByName(before.withColumn("new", F.lit(False)))
            found = AL.negative_spikes(every, by=by, threshold=threshold, width=width, order=EVENT_ORDER, keep=("new",))
            write_batch(found.where("new").drop("new"), f"{path}/alerts", batch_id)
            write_batch(_newest(rows.unionByName(before), width - 1, by), f"{path}/carried", batch_id)
        finally:
            rows.unpersist()

    return step


def run_spikes(posts: DataFrame, name: str, delay: str, checkpoint: str | None = None, path: str | None = None,
               end: str | None = None, until: dt.datetime = END_OF_TIME, **options) -> RunResult:
    """Alerts in event-time order, released as the watermark passes; ``end`` and ``until`` close a bounded input as in ``run_append``."""
    rows = sealed(posts, delay)
    r = run_batches(rows, name, spikes_step(**options), "append", checkpoint, path)
    if end:
        write_end(posts.sparkSession, end, until)
        r = run_batches(rows, name, spikes_step(**options), "append", r.checkpoint, r.path)
    return r


def read_spikes(spark: SparkSession, r: RunResult) -> DataFrame:
    if not _batches(spark, f"{r.path}/alerts"):
        return spark.createDataFrame([], AL.ALERT_SCHEMA)
    return spark.read.schema(AL.ALERT_SCHEMA).parquet(f"{r.path}/alerts").select(*AL.ALERT_SCHEMA.names)


_SEEN = T.StructType([T.StructField("topic", T.StringType()), T.StructField("seen", T.LongType())])


def last_n_step(n: int = 100, by: Sequence[str] = ("topic",)):
    """Carry the newest ``n`` rows of each key by event time and how many rows it has had (``by=()``: one global window).

    The order of arrival plays no part: the newest n of new and carried rows are the newest n of all.
    """
    def step(posts: DataFrame, batch_id: int, path: str) -> None:
        spark = posts.sparkSession
        rows = _rows(posts)
        seen = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("seen"))
        total = seen.unionByName(_state(spark, f"{path}/seen", _SEEN, batch_id))
        write_batch(total.groupBy("topic").agg(F.sum("seen").cast("long").alias("seen")), f"{path}/seen", batch_id)
        before = _state(spark, f"{path}/newest", _ROW, batch_id)
        write_batch(_newest(rows.unionByName(before), n, by), f"{path}/newest", batch_id)

    return step


def run_last_n(posts: DataFrame, name: str, n: int = 100, by: Sequence[str] = ("topic",),
               checkpoint: str | None = None, path: str | None = None) -> RunResult:
    return run_batches(posts, name, last_n_step(n, by), "append", checkpoint, path)


def read_last_n(spark: SparkSession, r: RunResult, by: Sequence[str] = ("topic",)) -> DataFrame:
    """topic (unless global), seen, window_sentiment, window_size after the last batch."""
    score = F.col("sentiment_score").cast("decimal(18,4)")
    means = _state(spark, f"{r.path}/newest", _ROW).groupBy(*by).agg(
        F.round(F.avg(score), 4).cast("double").alias("window_sentiment"), F.count(F.lit(1)).alias("window_size"))
    seen = _state(spark, f"{r.path}/seen", _SEEN).groupBy(*by).agg(F.sum("seen").cast("long").alias("seen"))
    key = list(by) or ["_all"]
    if not by:
        means, seen = means.withColumn("_all", F.lit(0)), seen.withColumn("_all", F.lit(0))
    return seen.join(means, key).select(*by, "seen", "window_sentiment", "window_size")


# ---- multi-run scenarios: restart, late data, concurrent groups ---------------------------------------

def split_by_time(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events table as (older half, newer half) around the midpoint of its time range (in microseconds)."""
    from tidepool.sources.tables import read_table

    e = read_table(spark, sf_dir, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = e.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    old = us < F.lit(((ends["lo"] or 0) + (ends["hi"] or 0)) // 2)
    return e.where(old), e.where(~old)


def land(df: DataFrame, folder: str) -> None:
    """Append a batch of raw events as new files of the landing folder a file stream reads."""
    df.write.mode("append").parquet(folder)


def landing_stream(spark: SparkSession, folder: str, max_bytes: int | None = None) -> DataFrame:
    """Stream of a landing folder; ``max_bytes`` bounds what a micro-batch reads (one file at least)."""
    read = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "*.parquet")
    return (read.option("maxBytesPerTrigger", max_bytes) if max_bytes else read).parquet(folder)


def late_counts(log: ProgressLog, before: int = 0) -> tuple[int, int]:
    """Rows read, and rows that Spark dropped behind the watermark, over the batches of ``log`` from number ``before`` on."""
    seen = log.batches[before:]
    return sum(b["rows"] for b in seen), sum(b["late_rows"] for b in seen)


def state_rows(log: ProgressLog) -> int:
    """The most rows that a batch's state held."""
    return max((b["state_rows"] for b in log.batches), default=0)


def batch_sizes(spark: SparkSession, checkpoint: str, files: DataFrame) -> DataFrame:
    """batch, files, bytes: what each micro-batch took in, from the source's own log; ``files`` has path and bytes of every file."""
    entry = F.from_json("value", "path string, batchId long")
    log = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{")).select(entry.alias("e"))
    name = F.element_at(F.split(F.col("e.path"), "/"), -1)
    return (log.select(F.col("e.batchId").alias("batch"), name.alias("name")).distinct()
            .join(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes"), "name")
            .groupBy("batch").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")))


def exported_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys and values that a stateful query's last batch left in its state store (group by named columns)."""
    return spark.read.format("statestore").load(checkpoint).select("key.*", "value.*")


_COMMIT = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("committed", T.LongType())])


def commit_step(route: Callable[[DataFrame], DataFrame]):
    """Commit what a consumer group has read: the next offset of each partition, after every batch."""
    def step(batch: DataFrame, batch_id: int, path: str) -> None:
        spark = batch.sparkSession
        read = route(batch).groupBy("partition").agg(F.count(F.lit(1)).alias("committed"))
        every = read.unionByName(_state(spark, path, _COMMIT, batch_id))
        write_batch(every.groupBy("partition").agg(F.sum("committed").cast("long").alias("committed")), path, batch_id)

    return step


def commits(spark: SparkSession, r: RunResult) -> DataFrame:
    """The group's committed offsets: the commit table of its last batch."""
    return _state(spark, r.path, _COMMIT)


def run_concurrently(queries: dict[str, DataFrame], mode: str = "complete") -> dict[str, RunResult]:
    """Independent consumer groups over one source: one streaming query and one checkpoint per group."""
    started = {}
    for name, df in queries.items():
        spark = df.sparkSession
        path, ck = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
        q = _start(df.writeStream.outputMode(mode).queryName(f"group_{name}")
                   .foreachBatch(lambda batch, batch_id, to=path: write_batch(batch, to, batch_id)), ck)
        started[name] = (q, path, ck)
    out = {}
    for name, (q, path, ck) in started.items():
        q.awaitTermination()
        out[name] = RunResult(path, ck)
    return out
