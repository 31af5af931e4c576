"""Hand-computed rows for the edge cases of each operator (FIXTURES §4)."""

import math

import pytest
from pyspark.sql import functions as F

from tidepool.functions import columns as C
from tidepool.functions.hashing import md5_mod
from tidepool.functions.text import DEFAULT_NEGATIVE_WORDS, DEFAULT_POSITIVE_WORDS, tokenize, with_lexicon_sentiment
from tidepool.operators import analytics as A
from tidepool.operators import quality as Q
from tidepool.operators import ranking, routing, search
from tidepool.operators.alerts import negative_spikes
from tidepool.operators.gold import daily_trend


def _col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_follower_tier_right_closed(spark):
    got = _col(spark, [0, 1, 1000, 1001, 10000, 100000, 100001, None], "bigint", C.follower_tier)
    assert got == ["nan", "Nano", "Nano", "Micro", "Micro", "Macro", "Mega", "nan"]


def test_influencer_threshold(spark):
    assert _col(spark, [9999, 10000], "bigint", C.is_influencer) == [False, True]


def test_engagement_weights(spark):
    df = spark.createDataFrame([(10, 2, 3)], "l bigint, s bigint, c bigint")
    assert df.select(C.engagement_score(F.col("l"), F.col("s"), F.col("c"))).first()[0] == 22.0


def test_clip_keeps_null_and_nan(spark):
    got = _col(spark, [None, float("nan"), 2.0, -3.0, 0.4], "double", C.clip_unit)
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [1.0, -1.0, 0.4]


def test_prime_time_inclusive(spark):
    assert _col(spark, [17, 18, 22, 23], "int", C.is_prime_time) == [False, True, True, False]


def test_engagement_index_zero_count(spark):
    df = spark.createDataFrame([(10, 2, 0), (10, 2, 4)], "l bigint, s bigint, n bigint")
    got = [r[0] for r in df.select(C.engagement_index(F.col("l"), F.col("s"), F.col("n"))).collect()]
    assert got == [16.0, 4.0]


def test_mask_email(spark):
    vals = ["testuser@gmail.com", "a@b", "bad", "x@y@z", "@b", None]
    assert _col(spark, vals, "string", C.mask_email) == ["t***@gmail.com", "a***@b", None, None, None, None]


def test_mask_phone_keeps_last_two(spark):
    assert _col(spark, ["123-456-7890"], "string", C.mask_phone) == ["***-***-**90"]


def test_severity_band(spark):
    assert _col(spark, [20.0, 20.1, 10.0, 10.1], "double", C.severity_band) == ["warning", "critical", "ok", "warning"]


@pytest.mark.parametrize("text,label,score,conf", [
    ("This is great", "positive", 1.0, 1.0),
    ("great GREAT hate", "positive", 0.6667, 0.3333),
    ("love hate", "neutral", 0.05, 0.0),
    ("nothing", "neutral", 0.05, 0.0),
    ("", "neutral", 0.05, 0.0),
    ("Loving it", "neutral", 0.05, 0.0),
    ("great_ness, greatgreat; GREAT!love?", "positive", 1.0, 1.0),
    ("Élhate hate", "negative", -1.0, 1.0),
])
def test_lexicon_sentiment(spark, text, label, score, conf):
    df = spark.createDataFrame([(text,)], "t string")
    r = with_lexicon_sentiment(df, "t", DEFAULT_POSITIVE_WORDS, DEFAULT_NEGATIVE_WORDS, "label", "score", "confidence").first()
    assert (r.label, r.score, r.confidence) == (label, score, conf)


def test_tokenize_is_unicode(spark):
    df = spark.createDataFrame([("Élan déjà-vu x_1",)], "t string")
    assert df.select(tokenize(F.col("t"))).first()[0] == ["élan", "déjà", "vu", "x_1"]


def test_search_idf_and_repeats(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["c"])], "doc_id long, tokens array<string>")
    q = spark.createDataFrame([(1, ["a", "b", "a"])], "query_id long, tokens array<string>")
    hits = search.search(q, search.postings(docs), 3, k=10).orderBy("rank").collect()
    assert [(h.doc_id, h.relevance_score) for h in hits] == [(1, 3.4055), (2, 2.0)]


@pytest.mark.parametrize("task_rows,tasks", [(50, 37), (400, 8), (10 ** 6, 8)])
def test_search_deals_documents_by_counted_pairs(spark, monkeypatch, task_rows, tasks):
    import re
    monkeypatch.setattr(search, "TASK_ROWS", task_rows)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 8)
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.array(F.lit("all"), F.concat(F.lit("t"), F.col("id"))).alias("tokens"))
    # three queries have a term of every document, the fourth none; "none" has no posting
    q = spark.createDataFrame([(1, ["all", "t7"]), (2, ["all"]), (3, ["all", "all"]), (4, ["none"])], "query_id long, tokens array<string>")
    hits = search.search(q, search.postings(docs), 600, k=2)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"RepartitionByExpression \[doc_id#\d+L\], {tasks}\b", plan), plan
    assert sorted((h.query_id, h["rank"], h.doc_id) for h in hits.collect()) == [(1, 1, 7), (1, 2, 0), (2, 1, 0), (2, 2, 1), (3, 1, 0), (3, 2, 1)]


def test_quartiles_and_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "v double")
    q = Q.quartiles({"t": df}).first()
    assert (q.q1, q.q3, q.n) == (2.0, 4.0, 5)
    o = Q.outliers({"t": df}).collect()
    assert [(r.column_name, r.outliers) for r in o] == [("v", 1)]


def test_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert Q.duplicate_rows({"t": df}).first().duplicate_rows == 1


def test_viral_without_viral_rows_is_null(spark):
    df = spark.createDataFrame([("X", "t", "positive", 0, 10.0)],
                               "platform string, topic string, sentiment_label string, is_viral int, engagement_score double")
    r = A.run_view("vw_viral_content_analysis", {"fact_posts": df}).first()
    assert (r.viral_rate_pct, r.avg_viral_engagement) == (0.0, None)


def test_confidence_histogram_degenerate_range(spark):
    df = spark.createDataFrame([("neutral", 0.0)] * 3, "nlp_label string, nlp_confidence double")
    r = A.confidence_histogram(df).collect()
    assert [(x.bin, x.bin_lo, x.bin_hi, x["count"]) for x in r] == [(15, 0.0, 0.033333, 3)]


def test_rolling_mean_min_periods(spark):
    from datetime import date
    rows = [(date(2024, 1, d), "t", f"p{d}", s, 1.0) for d, s in [(1, 0.1), (2, 0.2), (3, 0.3)]]
    df = spark.createDataFrame(rows, "post_date date, topic string, post_id string, sentiment_score double, "
                                     "engagement_score double")
    got = [r.sentiment_7d_avg for r in daily_trend(df).orderBy("post_date").collect()]
    assert got == [0.1, 0.15, 0.2]


def test_engagement_7d_always_divides_by_seven(spark):
    from datetime import date
    df = spark.createDataFrame([(date(2024, 1, 1), "t", 0.0, 1, 0, 7.0), (date(2024, 1, 2), "t", 0.0, 1, 0, 14.0)],
                               "post_date date, topic string, sentiment_score double, likes int, is_viral int, "
                               "engagement_score double")
    got = [r.engagement_7d_avg for r in A.run_view("vw_daily_sentiment_trend", {"fact_posts": df})
           .orderBy("post_date").collect()]
    assert got == [1.0, 3.0]


def test_rank_has_gaps(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 3)], "id int, v int")
    got = sorted((r.id, r["rank"]) for r in ranking.global_rank(df, "v", tiebreak=["id"]).collect())
    assert got == [(1, 1), (2, 1), (3, 3)]


@pytest.mark.parametrize("n", [3, 4, 7])
def test_global_ntile_matches_builtin(spark, n):
    from pyspark.sql import Window
    df = spark.range(0, 103).select(F.col("id"), (F.col("id") % 5).alias("v"))
    ours = ranking.global_ntile(df, n, [F.col("v").desc(), F.col("id")], out="t")
    ref = df.withColumn("r", F.ntile(n).over(Window.orderBy(F.col("v").desc(), F.col("id"))))
    assert sorted((r.id, r.t) for r in ours.collect()) == sorted((r.id, r.r) for r in ref.collect())


def _spike_df(spark, scores):
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1)
    rows = [(f"P{i:03d}", i, t0 + timedelta(minutes=i), "t", s) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "post_id string, event_id long, posted_at timestamp_ntz, topic string, "
                                       "sentiment_score double")


@pytest.mark.parametrize("scores,expected", [([-0.6] * 19, 0), ([-0.5] * 20, 0), ([-0.6] * 22, 3)])
def test_spike_alert_rules(spark, scores, expected):
    assert negative_spikes(_spike_df(spark, scores), threshold=-0.5, bucket_rows=32).count() == expected


def test_halo_buckets_equal_single_window(spark):
    import random
    random.seed(7)
    scores = [round(random.uniform(-1, 0.3), 4) for _ in range(300)]
    small = negative_spikes(_spike_df(spark, scores), by=(), threshold=-0.3, bucket_rows=25)
    big = negative_spikes(_spike_df(spark, scores), by=(), threshold=-0.3, bucket_rows=1 << 16)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))


def test_leaderboard_sum_then_sort(spark):
    from tidepool.streaming.jobs import leaderboard
    df = spark.createDataFrame([("#a", 50), ("#b", 70), ("#a", 30)], "hashtag string, velocity long")
    agg = df.groupBy("hashtag").agg(F.sum("velocity").alias("velocity"))
    assert [(r.hashtag, r.velocity) for r in leaderboard(agg).collect()] == [("#a", 80), ("#b", 70)]


def test_consumer_lag_defaults_to_zero(spark):
    ends = spark.createDataFrame([(0, 5), (1, 3)], "partition int, end_offset long")
    commits = spark.createDataFrame([(0, 2)], "partition int, committed long")
    got = sorted((r.partition, r.lag) for r in routing.consumer_lag(ends, commits).collect())
    assert got == [(0, 3), (1, 3)]


@pytest.mark.parametrize("key,m2,m4,m7", [("LIVE00000001", 1, 1, 1), ("LIVE00000002", 0, 0, 4), ("#AI", 1, 1, 5)])
def test_md5_routing(spark, key, m2, m4, m7):
    df = spark.createDataFrame([(key,)], "k string")
    r = df.select(md5_mod(F.col("k"), 2), md5_mod(F.col("k"), 4), md5_mod(F.col("k"), 7)).first()
    assert tuple(r) == (m2, m4, m7)


def test_offsets_gap_free_per_partition(spark):
    df = spark.range(0, 500).select(F.col("id"), (F.col("id") % 3).cast("int").alias("partition"))
    got = routing.with_offsets(df, ["id"]).groupBy("partition").agg(
        F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.countDistinct("offset").alias("d")).collect()
    for r in got:
        assert r.lo == 0 and r.hi == r.n - 1 and r.d == r.n


def test_api_status_flags(spark):
    from tidepool.operators.silver import silver_api_logs
    df = spark.createDataFrame([(s, dt) for s, dt in [(200, None), (404, None), (429, None), (500, None)]],
                               "status_code bigint, log_ts timestamp_ntz")
    got = [(r.is_error, r.is_rate_limited) for r in silver_api_logs(df).orderBy("status_code").collect()]
    assert got == [(False, False), (True, False), (True, True), (True, False)]


def test_viral_rule_batch_vs_stream(spark):
    from tidepool.streaming.jobs import VIRAL_LIKES_STREAM
    likes, shares = 4900, 200
    assert (likes + shares > 5000) is True        # batch rule: likes + shares
    assert (likes > VIRAL_LIKES_STREAM) is False  # stream rule: likes only


def test_unmatched_post_absent_from_top_influencers(spark):
    from tidepool.operators.gold import top_influencers
    posts = spark.createDataFrame(
        [("p1", 1, "Reddit", 10.0, 0.1, False), ("p2", 99, "Reddit", 500.0, 0.2, True)],
        "post_id string, user_id long, platform string, engagement_score double, sentiment_score double, "
        "is_viral boolean")
    users = spark.createDataFrame([(1, "u1", 5, "Nano", False, "X")],
                                  "user_id long, username string, followers long, follower_tier string, "
                                  "verified boolean, location string")
    assert [r.user_id for r in top_influencers(posts, users).collect()] == [1]


def test_tier_boundary_influencer_is_micro(spark):
    df = spark.createDataFrame([(10000,)], "f bigint")
    r = df.select(C.is_influencer(F.col("f")), C.follower_tier(F.col("f"))).first()
    assert tuple(r) == (True, "Micro")


@pytest.mark.parametrize("accuracy", [100, 1000, 10_000])
def test_banded_quartiles_are_exact(spark, accuracy):
    import numpy as np
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.integers(0, 50, 4000), rng.normal(0, 1000, 3000).round(2), [7.0] * 3000])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    q = Q.quartiles({"t": df}, accuracy=accuracy).first()
    assert q.n == len(vals)
    assert q.q1 == pytest.approx(float(np.percentile(vals, 25)), abs=1e-9)
    assert q.q3 == pytest.approx(float(np.percentile(vals, 75)), abs=1e-9)


def test_csv_layer_round_trip_with_declared_schema(spark):
    import tempfile
    from pyspark.sql import types as T
    from tidepool.sources import warehouse as W
    schema = T.StructType([T.StructField("post_id", T.StringType()), T.StructField("likes", T.LongType()),
                           T.StructField("sentiment_score", T.DoubleType()), T.StructField("_pipeline_version", T.StringType())])
    df = spark.createDataFrame([("POST00000001", 5, 0.65, "1.0"), ("POST00000002", None, -0.1, "1.0")], schema)
    root = tempfile.mkdtemp(prefix="csv-")
    path = W.write_layer({"posts": df}, root, fmt="csv")["posts"]
    back = W.read_csv_layer(spark, path, schema)
    assert all(r._corrupt_record is None for r in back.collect())
    whole = back.drop("_corrupt_record")
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert dict(back.dtypes)["_pipeline_version"] == "string"  # stays "1.0", not a float
    with open(f"{root}/bad.csv", "w") as f:
        f.write("post_id,likes,sentiment_score,_pipeline_version\nP,notanumber,0.1,1.0\n")
    bad = W.read_csv_layer(spark, f"{root}/bad.csv", schema).first()
    assert bad.likes is None and bad._corrupt_record == "P,notanumber,0.1,1.0"  # kept, with its text


def test_persisted_index_matches_in_memory(spark):
    import tempfile
    from tests.conftest import SF_SMALL
    from tidepool.sources import views
    dt = views.doc_tokens(spark, SF_SMALL)
    post = search.postings(dt)
    idx = search.write_index(post, tempfile.mkdtemp(prefix="index-"), buckets=8)
    stored = spark.read.parquet(idx["postings"]).select("term", "doc_id")
    n = dt.count()
    q = views.search_queries(spark, SF_SMALL)
    a = sorted(map(tuple, search.search(q, stored, n).collect()))
    b = sorted(map(tuple, search.search(q, post, n).collect()))
    assert a and a == b
    got = search.lookup(spark, idx, ["the", "de"], buckets=8)
    want = post.where(F.col("term").isin("the", "de"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("term", "doc_id").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"PartitionFilters: \[bucket#\d+ IN \(", plan), plan  # only the terms' buckets are read


def test_kafka_records_shape_and_routing(spark):
    import json
    df = spark.createDataFrame([("LIVE00000001", 3), ("LIVE00000002", 5)], "post_id string, likes int")
    rows = {r.key: r for r in routing.kafka_records(df, "post_id", 4).collect()}
    assert rows["LIVE00000001"].partition == 1 and rows["LIVE00000002"].partition == 0
    assert json.loads(rows["LIVE00000002"].value) == {"post_id": "LIVE00000002", "likes": 5}


def test_failing_named_view_is_recorded_and_others_run(spark):
    from datetime import date
    fact = spark.createDataFrame(
        [("p1", 1, "Reddit", "t", "positive", 0.5, 10, 1, 0, 13.0, 0, 1, date(2024, 1, 1), 18, 1, 2024)],
        "post_id string, user_id long, platform string, topic string, sentiment_label string, "
        "sentiment_score double, likes long, shares long, comments long, engagement_score double, is_viral int, "
        "is_prime_time int, post_date date, post_hour int, post_month int, post_year int")
    users = spark.createDataFrame([(1, "u", 5, "Nano")], "user_id long, username string, followers long, follower_tier string")
    # stg_api_logs is missing on purpose: vw_platform_health must fail, the other views must still run
    results, status = A.run_named_views(spark, {"fact_posts": fact, "dim_users": users})
    st = {r.view: r.ok for r in status.collect()}
    assert st["vw_platform_health"] is False
    assert all(v for k, v in st.items() if k != "vw_platform_health")
    assert results["vw_topic_sentiment_rank"].count() == 1


def test_results_come_in_report_order(spark):
    """Every view, report and panel that the reports sort, checked on the rows as they come."""
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    desc = lambda c: lambda r: -r[c]
    order = {"vw_topic_sentiment_rank": desc("post_count"), "vw_influencer_impact": desc("total_engagement"),
             "vw_daily_sentiment_trend": lambda r: (r["post_date"], r["topic"]), "vw_platform_health": desc("error_rate_pct"),
             "vw_viral_content_analysis": desc("viral_rate_pct"), "hashtag_velocity": desc("total_posts"),
             "user_segment": desc("avg_engagement"), "primetime": lambda r: (r["post_hour"], r["platform"]),
             "panel_daily_trend": lambda r: r["post_date"], "panel_platform": desc("avg_eng"),
             "panel_hourly": lambda r: r["post_hour"], "panel_api_health": desc("error_pct")}
    for key, by in order.items():
        got = [by(r) for r in E.queries()[key](spark, SF_SMALL).collect()]
        assert got and got == sorted(got), key


@pytest.mark.parametrize("spread", [1, 3, 400])
def test_global_rank_on_tied_values(spark, spread):
    from tidepool.operators.ranking import global_rank
    rows = [(i, None if i % 50 == 7 else i % spread) for i in range(600)]
    got = {r["i"]: r["rank"] for r in global_rank(spark.createDataFrame(rows, "i long, v long"), "v", True, ["i"]).collect()}
    key = lambda v: (v is None, -(v or 0))
    ranked = sorted(key(v) for _, v in rows)
    assert got == {i: ranked.index(key(v)) + 1 for i, v in rows}


def test_read_range_and_keyless_routing(spark):
    topic = spark.createDataFrame([(p, o) for p in range(2) for o in range(9)], "partition int, offset long")
    got = routing.read_range(topic, 3, 4).groupBy("partition").count().collect()
    assert {r["partition"]: r["count"] for r in got} == {0: 4, 1: 4}
    keyless = routing.route(spark.createDataFrame([(None, i) for i in range(200)], "k string, i int"), "k", 4)
    assert {r["partition"] for r in keyless.collect()} == {0, 1, 2, 3}
