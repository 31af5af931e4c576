"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import scratch_path

# Whitespace of the word class [^\x20\x09-\x0D]+.
WORD = r"[^\x20\x09-\x0D]+"


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts lineage without depending on any executor's disk, and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def row_key(*cols: str | Column) -> Column:
    """One string key of several columns in which nulls are equal to each other and to nothing else."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts])


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the CRC-32 of an ASCII string expression, half a byte at a time."""
    steps = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        steps.append(c)
    halves = f"flatten(list_transform(str_split({text}, ''), lambda c: [ord(c) & 15, ord(c) >> 4]))"
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, {halves}::bigint[]), "
            f"lambda c, n: xor(({steps}::bigint[])[(xor(c, n) & 15) + 1], c >> 4)), 4294967295::bigint)")


def small_slices(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of about ``max_bytes`` (one row at least), so a task's memory stays bounded."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared storage as a full address, for Spark and ``pyarrow.fs`` alike."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()


def arrow_columns(df: DataFrame, cols: list[Column], source: Column, make: Callable[[pa.Array], list[pa.Array]],
                  outs: dict[str, str], max_bytes: int) -> DataFrame:
    """``cols`` and, for each name of ``outs`` (name: type), a column that ``make`` derives from slices of ``source``.

    Rows travel as one struct, so names that clash do no harm.
    """
    names = [f"__out{k}" for k in range(len(outs))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, max_bytes):
            yield pa.RecordBatch.from_arrays([batch.column("__row"), *make(batch.column("__in"))], ["__row", *names])

    rows = df.select(F.struct(*cols).alias("__row"), source.alias("__in"))
    kinds = [f"__row {rows.schema['__row'].dataType.simpleString()}", *(f"{n} {k}" for n, k in zip(names, outs.values()))]
    made = rows.mapInArrow(run, ", ".join(kinds))
    return made.select("__row.*", *[F.col(n).alias(o) for n, o in zip(names, outs)])
