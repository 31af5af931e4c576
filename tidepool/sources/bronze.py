"""Bronze ingest: raw rows, unchanged, stamped with ingest metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.sources.tables import read_table, table_path

PIPELINE_VERSION = "1.0"


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table plus ``_source_file`` taken from the scan's file metadata (per row, no extra pass)."""
    return read_table(spark, sf_dir, name).withColumn("_source_file", F.col("_metadata.file_path"))


def stamp(df: DataFrame, version: str = PIPELINE_VERSION) -> DataFrame:
    """Add ``_ingested_at`` (one timestamp per query), ``_pipeline_version`` (kept a string)."""
    out = df.withColumn("_ingested_at", F.current_timestamp()).withColumn("_pipeline_version", F.lit(version))
    if "_source_file" not in out.columns:
        out = out.withColumn("_source_file", F.lit(None).cast("string"))
    return out


def write_bronze(df: DataFrame, path: str) -> None:
    """Append-only landing zone, partitioned by ingest date so re-runs add a partition, never rewrite."""
    (df.withColumn("_ingest_date", F.to_date("_ingested_at"))
       .write.mode("append").partitionBy("_ingest_date").parquet(path))


def ingest(spark: SparkSession, sf_dir: str, names: list[str], root: str) -> tuple[dict[str, str], DataFrame]:
    """Land each named table raw and stamped under ``root``; a missing source is recorded and the rest go on.

    Returns the landed folders and a status table (source, landed, error).
    """
    landed, status = {}, []
    for name in names:
        path = table_path(sf_dir, name)
        source = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not source.getFileSystem(spark._jsc.hadoopConfiguration()).exists(source):
            status.append((name, False, f"no such source: {path}"))
            continue
        landed[name] = f"{root.rstrip('/')}/{name}"
        write_bronze(stamp(read_raw(spark, sf_dir, name)), landed[name])
        status.append((name, True, None))
    return landed, spark.createDataFrame(status, "source string, landed boolean, error string")
