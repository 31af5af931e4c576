"""Streaming behaviour that the oracle suite cannot show: out-of-order arrival, late rows."""

import datetime as dt
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tidepool.operators.alerts import negative_spikes
from tidepool.sources.tables import SCHEMAS
from tidepool.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)


def _events(spark, ids):
    # event types cycle so that labels (and so scores) vary; ts one minute apart
    types = ["error", "error", "error", "view", "error", "error", "error"]
    rows = [(i, T0 + dt.timedelta(minutes=i), 1, types[i % len(types)], 1.0, '{"k": 3}') for i in ids]
    return spark.createDataFrame(rows, SCHEMAS["events"])


def test_event_time_alerts_ignore_arrival_order(spark):
    folder, end = tempfile.mkdtemp(prefix="landing-"), J.open_end(spark)
    ck, out = tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-")
    held_back = list(range(52, 56))
    landings = [[i for i in range(60) if i not in held_back], held_back, list(range(60, 81))]

    def stream():
        ends = spark.readStream.schema(SCHEMAS["events"]).parquet(end)
        return J.post_messages(J.landing_stream(spark, folder).unionByName(ends))

    for ids in landings:
        J.land(_events(spark, ids), folder)
        r = J.run_spikes(stream(), "eo", "10 minutes", checkpoint=ck, path=out, threshold=-0.55)
    got = sorted(map(tuple, J.read_spikes(spark, r).collect()))

    # final watermark = max event time (minute 80) - 10 minutes: the minutes up to it are sealed
    posts = J.post_messages(_events(spark, range(81)))
    batch = negative_spikes(posts, by=("topic",), threshold=-0.55, bucket_rows=64)
    want = sorted(map(tuple, batch.where(F.col("trigger_time") < F.lit(T0 + dt.timedelta(minutes=70))).collect()))
    assert 0 < len(got) < 51 and got == want

    J.land(_events(spark, [81]), folder)
    r = J.run_spikes(stream(), "eo", "10 minutes", checkpoint=ck, path=out, threshold=-0.55, end=end)
    posts = J.post_messages(_events(spark, range(82)))
    whole = negative_spikes(posts, by=("topic",), threshold=-0.55, bucket_rows=64)
    assert sorted(map(tuple, J.read_spikes(spark, r).collect())) == sorted(map(tuple, whole.collect()))


def test_rows_behind_the_watermark_are_counted_and_dropped(spark):
    folder = tempfile.mkdtemp(prefix="landing-")
    ck, out = tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-")
    late_ck, late = tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-")
    counts = []
    for ids in (list(range(40, 80)), list(range(0, 40))):  # the older half arrives last
        J.land(_events(spark, ids), folder)
        posts = J.post_messages(J.landing_stream(spark, folder))
        J.run_append(J.tumbling_counts(posts), "late", checkpoint=ck, path=out)
        with J.ProgressLog(spark) as log:
            J.run_append(J.dedup_within_watermark(posts), "late-rows", checkpoint=late_ck, path=late)
        counts.append(J.late_counts(log))
    assert counts == [(40, 0), (40, 40)]
    windows = spark.read.parquet(out)
    assert windows.where(F.col("window_start") < F.lit(T0 + dt.timedelta(minutes=40))).count() == 0


def _landed(spark, slices):
    folder = tempfile.mkdtemp(prefix="landing-")
    for ids in slices:
        J.land(_events(spark, ids).coalesce(1), folder)
        time.sleep(0.02)
    return folder


@pytest.mark.parametrize("slices, minutes", [
    ([range(0, 50), range(50, 100)], 0), ([range(50, 100), range(0, 50)], 99), ([range(0, 90), range(80, 100)], 9),
    ([range(0, 30), range(60, 90), range(30, 60)], 59), ([range(7)], 0)])
def test_disorder_of_files(spark, slices, minutes):
    back, newest = J.disorder(spark.read.schema(SCHEMAS["events"]).parquet(_landed(spark, slices)))
    assert back == dt.timedelta(minutes=minutes) and newest == T0 + dt.timedelta(minutes=max(max(s) for s in slices))


def test_disorder_of_files_written_at_once_and_of_none(spark):
    folder = _landed(spark, [range(0, 40), range(40, 60)])
    for f in os.listdir(folder):
        os.utime(f"{folder}/{f}", (1_700_000_000, 1_700_000_000))
    assert J.disorder(spark.read.schema(SCHEMAS["events"]).parquet(folder))[0] == dt.timedelta(minutes=59)
    assert J.disorder(spark.read.schema(SCHEMAS["events"]).parquet(J.open_end(spark))) == (dt.timedelta(0), None)


def test_state_stays_near_the_window_on_ordered_files(spark):
    """Five files in time order, one a batch: open windows and keys of the delay alone are held; out of order, more, with the same result."""
    slices = [range(k * 100, k * 100 + 100) for k in range(5)]
    held, rows = {}, {}
    for name, order in (("ordered", slices), ("shuffled", slices[::-1])):
        folder = _landed(spark, order)
        delay = J.delay_of(J.disorder(spark.read.schema(SCHEMAS["events"]).parquet(folder))[0])

        def stream(end):
            files = spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1)
            return J.post_messages(files.parquet(folder).unionByName(files.parquet(end)))

        end = J.open_end(spark)
        with J.ProgressLog(spark) as log:
            r = J.run_append(J.tumbling_counts(stream(end), delay=delay), "state", end=end)
        rows[name] = sorted(map(tuple, spark.read.parquet(r.path).collect()))
        end = J.open_end(spark)
        with J.ProgressLog(spark) as keys:
            r = J.run_append(J.dedup_within_watermark(stream(end), delay), "state-keys")
        assert spark.read.parquet(r.path).count() == 500
        held[name] = J.state_rows(log), J.state_rows(keys)
    assert rows["ordered"] == rows["shuffled"] and len(rows["ordered"]) == 500
    # a file of 100 minutes and the slack of 10 before it, of 500 minutes in all (the tumbling state also has the marker)
    assert max(held["ordered"]) <= 130 and min(held["shuffled"]) > 450


def test_missing_scores_count_as_zero(spark):
    folder = tempfile.mkdtemp(prefix="landing-")
    J.land(_events(spark, range(30)), folder)
    posts = J.post_messages(J.landing_stream(spark, folder)).withColumn(
        "sentiment_score", F.when(F.col("event_id") != 7, F.col("sentiment_score")))
    ends = spark.readStream.schema(SCHEMAS["events"]).parquet(end := J.open_end(spark))
    closed = posts.unionByName(J.post_messages(ends))
    alerts = J.read_spikes(spark, J.run_spikes(closed, "nulls", "10 minutes", end=end, threshold=1.0))
    last = J.read_last_n(spark, J.run_last_n(posts, "nulls-last"))
    assert alerts.count() == 11 and last.first()["seen"] == 30


def test_last_rows_survive_a_restart(spark):
    folder = tempfile.mkdtemp(prefix="landing-")
    ck, out = tempfile.mkdtemp(prefix="ck-"), tempfile.mkdtemp(prefix="out-")
    for ids in (range(0, 50), range(50, 90), range(90, 130)):
        J.land(_events(spark, ids), folder)
        r = J.run_last_n(J.post_messages(J.landing_stream(spark, folder)), "restart-last", checkpoint=ck, path=out)
    got = J.read_last_n(spark, r).first()
    scores = [x[0] for x in J.post_messages(_events(spark, range(30, 130))).select("sentiment_score").collect()]
    assert (got["seen"], got["window_size"]) == (130, 100)
    assert abs(got["window_sentiment"] - sum(scores) / 100) < 1e-4


@pytest.fixture(scope="module")
def many_files(spark):
    """The small tables with ``events`` as a folder of six files, read one file a batch."""
    from tests.conftest import SF_SMALL

    sf = tempfile.mkdtemp(prefix="sf-")
    for name in os.listdir(SF_SMALL):
        if name != "events.parquet":
            os.symlink(f"{SF_SMALL}/{name}", f"{sf}/{name}")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(6).write.parquet(f"{sf}/events.parquet")
    spark.conf.set(J.MAX_FILES_CONF, "1")
    yield sf
    spark.conf.unset(J.MAX_FILES_CONF)


@pytest.mark.parametrize("key", [
    "stream_topic_counts", "stream_platform_stats", "trend_leaderboard", "stream_two_groups", "stream_last100",
    "stream_last100_global", "stream_report_sections", "consumer_lag", "stream_alerts", "stream_alerts_global",
    "stream_alerts_event_time", "stream_tumbling", "stream_sliding", "stream_dedup", "stream_state_export"])
def test_streams_of_shuffled_files_equal_the_oracle(spark, many_files, key):
    """Six shuffled files, one a batch: every column equals the oracle over the whole table."""
    import duckdb

    import __spark_entry__ as E
    from tests.test_oracle import TABLES, _rows
    con = duckdb.connect()
    for t in TABLES:
        path = f"{many_files}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    got = E.queries()[key](spark, many_files)
    rel = con.sql(E.oracle_sql()[key])
    want = rel.fetchall()
    assert want and _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(rel.columns, want)


def test_materialized_layers_are_complete_and_consistent(spark):
    from tests.conftest import SF_SMALL
    from tidepool.operators import gold
    from tidepool.plans.common import s_posts
    from tidepool.plans.materialize import REQUIRED, materialize_layers
    from tidepool.sources import warehouse as W

    paths, status = materialize_layers(spark, SF_SMALL)
    assert status.where("not ok").count() == 0
    inv = W.table_inventory(spark, paths)
    req = spark.createDataFrame(REQUIRED, "layer string, table string")
    W.validate_outputs(req, inv)  # raises on anything missing
    written = spark.read.parquet(paths[("gold", "topic_sentiment")])
    direct = gold.topic_sentiment(s_posts(spark, SF_SMALL))
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, direct.select(*written.columns).collect()))
    fact = spark.read.parquet(paths[("warehouse", "fact_posts")])
    assert fact.where("post_date = date'2024-01-02'").count() > 0  # date partitions prune and read
