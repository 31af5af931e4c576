"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet in the
shared folder and reads them again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, exact_dedup, mix, quality, simhash
from tidepool.llm.common import pin
from tidepool.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines they remove."""
    return quality.clean(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates (4-word shingles, at most 4 bits), the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document taken n times is n rows."""
    return mix.mixed(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (token ids) and the digests of ids and decoded bytes for each row of the mix."""
    both = bpe.encode(docs, decoded="decoded", keep=["doc_id", "source"])
    return both.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("byte-level bpe", bpe_stage),
]

#: Line frequencies, XXH64 fingerprints and BPE merges are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
