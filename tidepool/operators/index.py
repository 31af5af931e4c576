"""A stored inverted index that takes new documents: segments of postings and of document frequencies, live ones named by a manifest.

A segment holds the postings of one batch of documents and their document frequencies, both in folders by term bucket, and the ids of
its documents. The manifest (a versioned list of live segments) is written last, so a segment is seen whole or not at all and a
repeated batch changes nothing: documents that are indexed already are left out. A search adds up the document frequencies of the
live segments for the asked terms and reads only the buckets those terms hash to (the join's filter reaches the scan as dynamic
partition pruning).

A batch's postings are stored as they are found, counted by bucket, and then dealt to tasks of ``search.TASK_ROWS`` rows of one
bucket each: what a task sorts or tells apart in memory does not grow with the batch.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators import search as S
from tidepool.sources import loads

BUCKETS = 64
POSTING = T.StructType([T.StructField("term", T.StringType()), T.StructField("doc_id", T.LongType()),
                        T.StructField("segment", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
TERM = T.StructType([T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
                     T.StructField("segment", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("segment", T.IntegerType())])


class Index:
    """The index under ``root``; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def segments(self) -> list[int]:
        """The live segments (the manifest's rows: one per segment)."""
        if not loads.versions(self.spark, f"{self.root}/live"):
            return []
        return sorted(r["segment"] for r in loads.read_table(self.spark, f"{self.root}/live").collect())

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        live = self.segments()
        if not live:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{part}").where(F.col("segment").isin(live))

    def postings(self) -> DataFrame:
        return self._read("postings", POSTING)

    def terms(self) -> DataFrame:
        return self._read("terms", TERM)

    def docs(self) -> DataFrame:
        return self._read("docs", DOC)

    def _next(self) -> int:
        return max(self.segments(), default=-1) + 1

    def _dealt(self, post: DataFrame, repeated: bool) -> DataFrame:
        """Stored postings with their bucket, in tasks of ``search.TASK_ROWS`` rows of one bucket each; ``repeated`` rows once."""
        post = post.select("term", "doc_id", S.term_bucket(F.col("term"), self.buckets).alias("bucket"))
        tasks, deal = 0, F.lit(0)
        for bucket, rows in sorted(post.groupBy("bucket").count().collect()):  # a row per bucket
            parts = math.ceil(rows / S.TASK_ROWS)
            deal = F.when(F.col("bucket") == bucket, F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int") + tasks).otherwise(deal)
            tasks += parts
        dealt = post.withColumn("task", deal).repartitionById(max(1, tasks), F.col("task"))
        return (dealt.distinct() if repeated else dealt).drop("task")

    def _write(self, post: DataFrame, docs: DataFrame, segment: int, live: list[int], repeated: bool = False) -> int:
        self._dealt(post, repeated).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/postings/segment={segment}")
        written = self.spark.read.schema(POSTING).parquet(f"{self.root}/postings").where(F.col("segment") == segment)
        (written.groupBy("term", "bucket").agg(F.count(F.lit(1)).alias("df")).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/terms/segment={segment}"))
        docs.select("doc_id").write.mode("overwrite").parquet(f"{self.root}/docs/segment={segment}")
        loads.replace_table(self.spark.createDataFrame([(s,) for s in [*live, segment]], "segment int"), f"{self.root}/live")
        return segment

    def add(self, doc_tokens: DataFrame) -> int | None:
        """Index the documents (doc_id, tokens) that are not indexed yet as a new segment; its number, None if there are none.

        Of rows with one id, the tokens are united.
        """
        live = self.segments()
        new = doc_tokens.select("doc_id", "tokens")
        if live:
            # the known ids are the hashed side: the documents are not sorted
            new = new.join(self.docs().select("doc_id").hint("shuffle_hash"), "doc_id", "left_anti")
        ids = new.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
        size = ids.agg(F.count(F.lit(1)).alias("ids"), F.max("rows").alias("most")).first()
        if not size["ids"]:
            return None
        segment = self._next()
        found = f"{self.root}/found/segment={segment}"
        S.postings(new).select("term", "doc_id").write.mode("overwrite").parquet(found)
        post = self.spark.read.schema("term string, doc_id long").parquet(found)
        return self._write(post, ids, segment, live, repeated=size["most"] > 1)

    def compact(self) -> int | None:
        """Merge all live segments into one; the old ones stay on disk for readers that still see them."""
        live = self.segments()
        if len(live) < 2:
            return None
        return self._write(self.postings(), self.docs(), self._next(), [])

    def pruned(self, asked: DataFrame) -> DataFrame:
        """Postings of the terms of ``asked`` (term), reading only their buckets."""
        return self._of(self.postings(), asked).select("term", "doc_id")

    def _of(self, stored: DataFrame, asked: DataFrame) -> DataFrame:
        wanted = asked.select("term").where(F.length("term") > 0).distinct().select(
            "term", S.term_bucket(F.col("term"), self.buckets).alias("bucket"))
        return stored.join(F.broadcast(wanted), ["term", "bucket"])

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        """Top ``k`` documents per query (query_id, tokens), as ``search.search`` over all live segments.

        Terms beyond ``search.BROADCAST_ROWS`` are not sent to every task; the buckets are then read whole.
        """
        asked = queries.select(F.explode("tokens").alias("term")).where(F.length("term") > 0).distinct()
        few = asked.count() <= S.BROADCAST_ROWS
        terms = self._of(self.terms(), asked) if few else self.terms().join(asked, "term")
        df = terms.groupBy("term").agg(F.sum("df").cast("long").alias("df"))
        post = self.pruned(asked) if few else self.postings().select("term", "doc_id")
        return S.search(queries, post, self.docs().count(), k=k, df=df)
