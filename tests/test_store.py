"""CSV inference, repeatable loads, catalog tables, SQL text and the growing index: cases the oracle rows do not show."""

import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from tidepool.operators import search as S
from tidepool.operators import sql as Q
from tidepool.operators.index import Index
from tidepool.plans import catalog_store as C
from tidepool.sources import csv_scan, loads, star, views


def _csv(text: str) -> str:
    folder = tempfile.mkdtemp(prefix="csv-")
    with open(f"{folder}/a.csv", "w") as f:
        f.write(text)
    return folder


def test_csv_types_cover_all_rows(spark):
    """The last row decides as much as the first; empty cells decide nothing."""
    scan = csv_scan.read_csv(spark, _csv(
        "a,b,c,d,e,f,g,h\n"
        "1,1,true,2024-01-02 03:04:05,,x,1e3,99999999999999999999\n"
        "2,2.5,False,2024-01-02T03:04:05.25,,,.5,1\n"
        ",,,,,\"a, \"\"b\"\"\",-7,\n"))
    assert [f.dataType.simpleString() for f in scan.schema] == [
        "bigint", "double", "boolean", "timestamp_ntz", "string", "string", "double", "double"]
    rows = sorted(map(tuple, scan.rows.collect()), key=repr)
    assert scan.quarantine.count() == 0 and len(rows) == 3
    assert rows[2][0] is None and rows[2][5] == 'a, "b"' and rows[2][6] == -7.0
    assert rows[0][1:3] == (1.0, True) and rows[1][5] is None


def test_csv_bad_rows_are_set_aside_or_widen_the_type(spark):
    path = _csv("id,n\n" + "".join(f"{k},{k}\n" for k in range(50)) + "50,none\n51\n52,1,2\n")
    strict = csv_scan.read_csv(spark, path)
    assert strict.schema["n"].dataType == T.StringType()
    assert sorted(r["bad_columns"] for r in strict.quarantine.collect()) == ["_corrupt_record"] * 2
    loose = csv_scan.read_csv(spark, path, tolerance=0.05)
    assert loose.schema["n"].dataType == T.LongType() and loose.rows.count() == 50
    assert sorted(tuple(r) for r in loose.quarantine.collect()) == [
        ("50,none", "n"), ("51", "_corrupt_record"), ("52,1,2", "_corrupt_record")]


def test_csv_of_a_header_alone(spark):
    scan = csv_scan.read_csv(spark, _csv("a,b\n"))
    assert scan.rows.count() == 0 and scan.schema.names == ["a", "b"]


def test_failed_loads_leave_the_table(spark):
    root = tempfile.mkdtemp(prefix="load-")
    rows = spark.range(20).select(F.col("id"), (F.col("id") % 4).cast("string").alias("day"))
    bad = rows.withColumn("id", F.when(F.col("id") == 13, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        loads.replace_table(bad, root, ["day"])
    with pytest.raises(FileNotFoundError):
        loads.read_table(spark, root)
    loads.replace_table(rows, root, ["day"])
    with pytest.raises(PySparkException):
        loads.replace_table(bad, root, ["day"])
    with pytest.raises(PySparkException):
        loads.replace_partitions(bad, root, ["day"])
    assert loads.read_table(spark, root).count() == 20
    loads.replace_partitions(rows.where("day = '1'").limit(2), root, ["day"])
    assert {r["day"]: r["count"] for r in loads.read_table(spark, root).groupBy("day").count().collect()} == {0: 5, 1: 2, 2: 5, 3: 5}
    for _ in range(3):
        loads.replace_table(rows, root)
    loads.expire(spark, root)
    assert loads.versions(spark, root) == [2, 3] and len(os.listdir(root)) == 2
    assert loads.read_table(spark, root).count() == 20


def test_fact_and_dimension_join_without_exchange(spark):
    names = C.star_tables(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.posts_with_users(spark, names).groupBy("user_id").agg(F.sum("likes"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert joined.count() > 0


def test_star_violations_are_found(spark):
    users = spark.createDataFrame([(1,), (1,), (None,)], "user_id long")
    posts = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "post_id string, user_id long")
    names = star.create_tables(spark, {"fact_posts": posts, "dim_users": users}, prefix="broken_")
    got = {r["table"]: (r["rows"], r["key_violations"], r["orphans"]) for r in star.describe(spark, names).collect()}
    assert got == {"fact_posts": (3, 1, 1), "dim_users": (3, 2, 0)}


def test_markers_are_values_not_text(spark):
    Q.register(spark, {"named": spark.createDataFrame([("a",), ("x' or '1' = '1",)], "name string")})
    find = "select name from named where name = :name"
    frames, record = Q.run_statements(spark, {
        "hit": Q.Statement(find, {"name": "x' or '1' = '1"}), "none": Q.Statement(find, {"name": "b"}),
        "no marker": Q.Statement(find), "no sql": Q.Statement("selct 1")})
    assert {k: f.count() for k, f in frames.items()} == {"hit": 1, "none": 0}
    status = {r["statement"]: r["ok"] for r in record.collect()}
    assert status == {"hit": True, "none": True, "no marker": False, "no sql": False}


@pytest.fixture(scope="module")
def index(spark):
    from tidepool.session import scratch_path

    tokens = views.doc_tokens(spark, SF_SMALL)
    own = Index(spark, scratch_path(spark, "test-index"), buckets=16)
    for k in range(3):
        own.add(tokens.where(F.col("doc_id") % 3 == k))
    return own


def _hits(index, spark):
    return sorted(map(tuple, index.search(views.search_queries(spark, SF_SMALL), k=5).collect()))


def test_index_prunes_buckets_and_merges_frequencies(spark, index):
    asked = spark.createDataFrame([("the",), ("and",), ("",), ("no-such-term",)], "term string")
    pruned = index.pruned(asked)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    want = S.postings(views.doc_tokens(spark, SF_SMALL)).where(F.col("term").isin("the", "and", "no-such-term"))
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, want.select("term", "doc_id").collect()))
    df = index.terms().groupBy("term").agg(F.sum("df").alias("df"))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, S.document_frequency(S.postings(views.doc_tokens(spark, SF_SMALL))).collect()))


def test_index_ignores_known_documents_and_unfinished_segments(spark, index):
    before = _hits(index, spark)
    assert index.add(views.doc_tokens(spark, SF_SMALL)) is None and index.segments() == [0, 1, 2]
    lost = spark.createDataFrame([("the", 10 ** 9, 0)], "term string, doc_id long, bucket int")
    lost.write.partitionBy("bucket").parquet(f"{index.root}/postings/segment=3")  # a writer that died before the manifest
    assert _hits(index, spark) == before and index.postings().where(F.col("doc_id") == 10 ** 9).count() == 0


def test_compaction_keeps_the_results(spark, index):
    before = _hits(index, spark)
    assert index.compact() == 3 and index.segments() == [3]
    assert _hits(index, spark) == before


def test_shuffled_search_beyond_the_broadcast_bound(spark, index, monkeypatch):
    before = _hits(index, spark)
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert _hits(index, spark) == before


def test_index_deals_postings_by_counted_rows(spark, monkeypatch):
    """A bucket's postings go to as many tasks as its rows fill, a file each; documents that come twice are united."""
    from tidepool.session import scratch_path

    monkeypatch.setattr(S, "TASK_ROWS", 100)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.array(F.lit("all"), F.concat(F.lit("t"), F.col("id") % 5)).alias("tokens"))
    again = docs.where(F.col("doc_id") < 500).select("doc_id", F.array(F.lit("all"), F.lit("new")).alias("tokens"))
    for batch, rows in ((docs, 2000), (docs.unionByName(again), 2500)):
        own = Index(spark, scratch_path(spark, "dealt-index"), buckets=4)
        own.add(batch.where(F.col("doc_id") % 2 == 0))
        own.add(batch)
        stored = own.postings()
        assert stored.count() == stored.select("term", "doc_id").distinct().count() == rows and own.docs().count() == 1000
        files = stored.groupBy("segment", "bucket", F.input_file_name().alias("f")).count().collect()
        assert max(f["count"] for f in files) <= 200 and len(files) >= rows / 100
        counts = {r["term"]: r["df"] for r in own.terms().groupBy("term").agg(F.sum("df").alias("df")).collect()}
        assert counts["all"] == 1000 and counts["t3"] == 200 and counts.get("new", 0) == rows - 2000


def test_index_leaves_known_documents_unsorted(spark, monkeypatch):
    from tidepool.session import scratch_path

    own, plans = Index(spark, scratch_path(spark, "known-index")), []
    tokens = views.doc_tokens(spark, SF_SMALL)
    own.add(tokens.where(F.col("doc_id") % 2 == 0))
    monkeypatch.setattr(S, "postings", lambda d, f=S.postings: plans.append(d._jdf.queryExecution().executedPlan().toString()) or f(d))
    own.add(tokens)
    assert "ShuffledHashJoin" in plans[0] and "Sort" not in plans[0].replace("SortMerge", ""), plans[0]
    assert own.docs().count() == tokens.count()


def test_index_of_nothing(spark):
    from tidepool.session import scratch_path

    own = Index(spark, scratch_path(spark, "empty-index"))
    queries = spark.createDataFrame([(1, ["a"])], "query_id long, tokens array<string>")
    assert own.search(queries).count() == 0
    own.add(spark.createDataFrame([(5, []), (6, [""])], "doc_id long, tokens array<string>"))
    assert own.docs().count() == 2 and own.search(queries).count() == 0


@pytest.mark.parametrize("key", ["dq_nulls", "dq_duplicates", "dq_quartiles", "dq_outliers", "dq_range", "dq_summary", "dq_pk",
                                 "dq_orphans", "dq_report_lines"])
def test_quality_of_empty_tables(spark, key, empty_sf):
    import __spark_entry__ as E
    got = E.queries()[key](spark, empty_sf).collect()
    want = {"dq_duplicates": 4, "dq_range": 1, "dq_summary": 4, "dq_pk": 3, "dq_report_lines": 8}.get(key, 0)
    assert len(got) == want


@pytest.fixture(scope="module")
def empty_sf(spark):
    from tidepool.sources.tables import SCHEMAS

    sf = tempfile.mkdtemp(prefix="sf-empty-")
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{sf}/{name}.parquet")
    return sf
