"""Warehouse loads that can fail and be repeated: full replacement by version, replacement of single partitions.

A table is a folder of versions. A full load writes a new version to its own folder and is seen once Spark has committed it
(``_SUCCESS``); a failed load leaves readers on the version before. A partial load overwrites the partitions its rows belong to within the current version
(dynamic partition overwrite: files are staged and moved at commit), so a repeated load replaces only these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DONE = "_SUCCESS"


def _folder(spark: SparkSession, path: str):
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    return top.getFileSystem(spark._jsc.hadoopConfiguration()), top


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions under ``root``."""
    fs, top = _folder(spark, root)
    if not fs.exists(top):
        return []
    named = [f.getPath() for f in fs.listStatus(top) if f.isDirectory() and f.getPath().getName().startswith("version=")]
    return sorted(int(p.getName().split("=")[1]) for p in named if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, DONE)))


def current_path(spark: SparkSession, root: str) -> str:
    done = versions(spark, root)
    if not done:
        raise FileNotFoundError(f"no committed version under {root}")
    return f"{root.rstrip('/')}/version={done[-1]}"


def replace_table(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the next version; on failure the version before stays the current one. Its number is used again."""
    spark = df.sparkSession
    done = versions(spark, root)
    path = f"{root.rstrip('/')}/version={done[-1] + 1 if done else 0}"
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def replace_partitions(df: DataFrame, root: str, partition_by: Sequence[str]) -> str:
    """Replace those partitions of the current version that ``df`` has rows of; the others stay as they are."""
    path = current_path(df.sparkSession, root)
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return path


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The current version."""
    return spark.read.parquet(current_path(spark, root))


def expire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all versions but the newest ``keep`` committed ones and what failed loads left behind the newest."""
    fs, top = _folder(spark, root)
    stay = {f"version={n}" for n in versions(spark, root)[-keep:]}
    for f in fs.listStatus(top):
        if f.isDirectory() and f.getPath().getName().startswith("version=") and f.getPath().getName() not in stay:
            fs.delete(f.getPath(), True)
