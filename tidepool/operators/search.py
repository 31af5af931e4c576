"""Lexicon sentiment over documents and an inverted-index search, as Spark jobs.

The index is a postings table (term, doc_id) with one row per distinct term per document. Search runs
many queries in one job: query terms join the postings, a document's scores ``qtf * idf(term)`` with
idf = ln(N / (df + 1)) + 1 add up in one task, and the top k per query come from a
``row_number() <= k`` filter, which the planner turns into a partial per-task group limit before the
shuffle and a final one after it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.functions.text import with_lexicon_sentiment


def score_documents(docs: DataFrame, positive: list[str], negative: list[str], text_col: str = "text") -> DataFrame:
    """Append nlp_label / nlp_score / nlp_confidence (native expressions; no Python UDF)."""
    return with_lexicon_sentiment(docs, text_col, positive, negative, "nlp_label", "nlp_score", "nlp_confidence")


def agreement(scored: DataFrame, truth: str = "sentiment_label", pred: str = "nlp_label") -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(F.col(truth) == F.col(pred)).alias("agreeing"),
        F.round(F.count_if(F.col(truth) == F.col(pred)).cast("decimal(38,0)")
                / F.count(F.lit(1)).cast("decimal(38,0)"), 4).cast("double").alias("agreement_rate"))


def confusion(scored: DataFrame, truth: str = "sentiment_label", pred: str = "nlp_label") -> DataFrame:
    return scored.groupBy(truth, pred).agg(F.count(F.lit(1)).alias("docs"))


def label_domain_violations(scored: DataFrame, allowed: list[str], col: str = "nlp_label") -> DataFrame:
    """Count of labels outside the allowed domain (anti join against a fixed 3-row domain table)."""
    spark = scored.sparkSession
    dom = spark.createDataFrame([(x,) for x in allowed], f"{col} string")
    bad = scored.select(col).join(F.broadcast(dom), col, "left_anti")
    return bad.agg(F.count(F.lit(1)).alias("violations"))


def postings(doc_tokens: DataFrame) -> DataFrame:
    """(term, doc_id): each distinct token of each document once."""
    return doc_tokens.select("doc_id", F.explode(F.array_distinct("tokens")).alias("term"))


def document_frequency(post: DataFrame) -> DataFrame:
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def index_stats(post: DataFrame, doc_tokens: DataFrame) -> DataFrame:
    """Long form (stat, value): doc_count, unique_terms, postings."""
    d = doc_tokens.agg(F.count(F.lit(1)).alias("value")).select(F.lit("doc_count").alias("stat"), "value")
    t = document_frequency(post).agg(F.count(F.lit(1)).alias("value")).select(F.lit("unique_terms").alias("stat"), "value")
    p = post.agg(F.count(F.lit(1)).alias("value")).select(F.lit("postings").alias("stat"), "value")
    return d.unionByName(t).unionByName(p)


def top_terms(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` terms in most documents, from a document-frequency table."""
    return df.orderBy(F.col("df").desc(), F.col("term")).limit(n)


BROADCAST_ROWS = 1_000_000
TASK_ROWS = 500_000  # rows that one task holds in memory: tasks are counted by it, so a task's memory does not follow the tables


def tasks_for(rows: int, spark: SparkSession) -> int:
    """How many tasks hold ``rows``, ``TASK_ROWS`` in each; one for every core at least."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def search(queries: DataFrame, post: DataFrame, doc_count: int, k: int = 10, df: DataFrame | None = None) -> DataFrame:
    """Top ``k`` documents per query: (query_id, rank, doc_id, relevance_score).

    ``queries`` is (query_id, tokens); repeated query tokens count again (qtf weight). Ties go to the
    smaller doc_id. ``doc_count`` is N, the number of indexed documents; ``df`` the stored document frequencies.

    Only the postings of asked terms move, dealt by document, so all scores of a document add up in one task and
    just the k best rows per query and task are exchanged. A task holds its documents' (query, document) pairs, of which
    there are at most the postings counted once per asking query, and at most one per query and document: documents
    are dealt to as many tasks as that number fills. All this needs the query terms on every task: they are
    counted, and beyond ``BROADCAST_ROWS`` the (query, document) pairs are dealt out instead.
    """
    qt = (queries.select("query_id", F.explode("tokens").alias("term"))
                 .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf")))
    df = df if df is not None else document_frequency(post)
    idf = df.select("term", "df", (F.log(F.lit(float(doc_count)) / (F.col("df") + 1)) + 1).alias("idf"))
    size = qt.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("query_id").alias("queries")).first()
    if size["rows"] <= BROADCAST_ROWS:
        asked = F.broadcast(qt.select("term").distinct())
        wanted = idf.join(F.broadcast(qt), "term")
        pairs = min(wanted.agg(F.sum("df")).first()[0] or 0, doc_count * size["queries"])
        wanted = F.broadcast(wanted.drop("df"))
        post = post.join(asked, "term", "left_semi").repartition(tasks_for(pairs, post.sparkSession), "doc_id")
    else:
        wanted = qt.join(idf.drop("df"), "term")
    hits = post.join(wanted, "term").groupBy("query_id", "doc_id").agg(
        F.sum(F.col("qtf") * F.col("idf")).alias("score"))
    # Scores are sums of floats whose order of addition is not fixed: rank on 9 decimals so equal
    # scores tie (and fall to doc_id) whatever the summation order was.
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), F.col("doc_id"))
    top = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id",
                      F.round("score", 4).alias("relevance_score"))


def term_bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(post: DataFrame, path: str, buckets: int = 64) -> dict[str, str]:
    """Persist the index: postings partitioned by a term-hash bucket, and the document-frequency table.

    A lookup of a few terms reads only their buckets (partition pruning on ``bucket``); a batch search
    reads the postings once. Returns the two table paths.
    """
    root = path.rstrip("/")
    out = {"postings": f"{root}/postings", "df": f"{root}/df"}
    (post.withColumn("bucket", term_bucket(F.col("term"), buckets))
         .hint("rebalance", "bucket")  # a bucket's rows meet in a few tasks: few files, none from every task
         .write.mode("overwrite").partitionBy("bucket").parquet(out["postings"]))
    document_frequency(post).write.mode("overwrite").parquet(out["df"])
    return out


def lookup(spark, index: dict[str, str], terms: list[str], buckets: int = 64) -> DataFrame:
    """Postings of the given terms, reading only the buckets they hash to."""
    q = spark.createDataFrame([(t,) for t in sorted(set(terms))], "term string")
    bks = [r[0] for r in q.select(term_bucket(F.col("term"), buckets)).distinct().collect()]  # <= len(terms)
    post = spark.read.parquet(index["postings"]).where(F.col("bucket").isin(bks))
    return post.join(F.broadcast(q), "term").select("term", "doc_id")
