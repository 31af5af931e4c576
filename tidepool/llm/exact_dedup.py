"""Exact dedup by deterministic block naming.

Every text is cut into fixed-size blocks. A naming round gives equal values one integer name and different
values different names: the distinct values of a bucket (a 64-bit hash) are sorted, and the name is
(bucket, position in that sorted list). Position 0 is the rule; a larger one occurs only where two different
values share a bucket. Adjacent names are then paired and the pairs named again, until one name is left. Two
documents with the same number of blocks and the same last name are equal; no digest decides.

Scale: the text crosses the network once, after map-side combining (copies of a block leave a task once);
every later round moves 32-byte pairs, at most half as many each time. No group's rows meet in one task:
rounds aggregate with partial sums, and rows learn their group through a join that adaptive execution splits.

Edge cases: null text equals the empty text. Null ids are smaller than any other id. Rows that repeat both id
and text count in ``group_size``, and exactly one of them stays. Only ``doc_id`` and ``text`` are read, so other
columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import pin, row_key, text_or_empty

BLOCK_CHARS = 4096


def _bucket(value: Column, bits: int) -> Column:
    h = F.xxhash64(value)
    return h if bits >= 64 else F.shiftrightunsigned(h, 64 - bits)


def _named(rows: DataFrame, bits: int, label: str) -> DataFrame:
    """Replace ``value`` by its integer name: columns ``bucket`` and ``rank``."""
    rows = rows.withColumn("bucket", _bucket(F.col("value"), bits))
    clashes = pin(
        rows.groupBy("bucket").agg(F.sort_array(F.collect_set("value")).alias("sorted"))
        .filter(F.size("sorted") > 1)
        .select("bucket", F.posexplode("sorted").alias("rank", "value")),
        f"{label}-clashes",
    )
    return (rows.join(clashes, ["bucket", "value"], "left")
            .withColumn("rank", F.coalesce("rank", F.lit(0))).drop("value"))


def block_names(docs: DataFrame, block_chars: int = BLOCK_CHARS, bucket_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: row (a number of its own), doc_id, text_sha256, n_blocks, bucket, rank.

    (n_blocks, bucket, rank) is the identity of the text. ``bucket_bits`` below 64 forces shared buckets (tests).
    """
    text = F.col("text")
    cut = F.when(F.length(text) <= block_chars, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0)))
    rows = (docs.select(F.col("doc_id"), text_or_empty().alias("text"))
            .select(F.monotonically_increasing_id().alias("row"),
                    F.struct("doc_id", F.unhex(F.sha2(text, 256)).alias("sha")).alias("doc"),
                    cut.alias("blocks"))
            .select("row", "doc", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("pos", "value"))
            .withColumn("doc", F.when(F.col("pos") == 0, F.col("doc")))
            .withColumn("n", F.col("n_blocks")))
    level = pin(_named(rows, bucket_bits, "blocks"), "names-0")
    most = level.agg(F.max("n_blocks")).first()[0] or 1
    done = []
    depth = 0
    while True:
        done.append(level.filter("n = 1"))
        if most <= 1:
            break
        most, depth = (most + 1) // 2, depth + 1
        name = F.struct("bucket", "rank")
        pairs = (level.filter("n > 1")
                 .groupBy("row", F.shiftright("pos", 1).alias("pos"), "n_blocks",
                          F.shiftright(F.col("n") + 1, 1).alias("n"))
                 .agg(F.max("doc").alias("doc"),
                      F.max(F.when(F.col("pos") % 2 == 0, name)).alias("a"),
                      F.max(F.when(F.col("pos") % 2 == 1, name)).alias("b"))
                 .withColumn("value", F.struct(
                     F.col("a.bucket").alias("a"), F.col("a.rank").alias("i"),
                     F.coalesce("b.bucket", F.lit(0)).alias("b"), F.coalesce("b.rank", F.lit(-1)).alias("j")))
                 .drop("a", "b"))
        pairs = pin(pairs, f"pairs-{depth}")
        level = pin(_named(pairs, bucket_bits, f"pairs-{depth}"), f"names-{depth}")
    out = [d.select("row", F.col("doc.doc_id").alias("doc_id"), F.lower(F.hex("doc.sha")).alias("text_sha256"),
                    "n_blocks", "bucket", "rank") for d in done]
    all_rows = out[0]
    for d in out[1:]:
        all_rows = all_rows.unionByName(d)
    return all_rows


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS, bucket_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``; the largest doc_id stays."""
    names = block_names(docs, block_chars, bucket_bits)
    identity = ["n_blocks", "bucket", "rank"]
    groups = pin(names.groupBy(*identity)
                 .agg(F.max(F.struct("doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size"))
                 .filter("group_size > 1"), "groups")
    return (names.join(groups, identity, "left")
            .select("doc_id",
                    F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    (F.col("top").isNull() | (F.col("top.row") == F.col("row"))).alias("kept"),
                    "text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = "__exact_key"
    kept = exact_dedup(docs).filter("kept").select(row_key("doc_id", "text_sha256").alias(key))
    keyed = docs.withColumn(key, row_key("doc_id", F.sha2(text_or_empty(), 256)))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
