"""SQL text over registered views, with parameter markers; a statement that fails is recorded and the others run on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Statement:
    """A statement and the values of its ``:name`` markers, which are never spliced into the text."""

    text: str
    args: Mapping[str, object] = field(default_factory=dict)


def register(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def scan(spark: SparkSession, statement: Statement) -> DataFrame:
    return spark.sql(statement.text, args=dict(statement.args))


def run_statements(spark: SparkSession, statements: Mapping[str, Statement]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The frames of the statements that hold, and the record (statement, ok, error) of all.

    A statement fails here if it cannot be parsed or planned; what fails in a task later fails the query that reads it.
    """
    frames, record = {}, []
    for name, statement in statements.items():
        try:
            frames[name] = scan(spark, statement)
            record.append((name, True, None))
        except PySparkException as e:
            record.append((name, False, e.getCondition() or type(e).__name__))
    return frames, spark.createDataFrame(record, "statement string, ok boolean, error string")


def with_counts(frames: Mapping[str, DataFrame], record: DataFrame) -> DataFrame:
    """The record with the rows of each statement (null where it failed)."""
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("statement"), "rows")
        out = part if out is None else out.unionByName(part)
    counted = record.withColumn("rows", F.lit(None).cast("long")) if out is None else record.join(out, "statement", "left")
    return counted.select("statement", "ok", "error", "rows")
