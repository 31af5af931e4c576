"""Headered CSV without a declared schema: types inferred over all rows, bad rows set aside.

One pass reads every cell as text and counts, per column, how many filled cells each type can hold; a column takes the narrowest type
that holds all of them but the tolerated share. A second read casts; a row with a cell that its column's type cannot hold, or with
too few or too many cells, goes to the quarantine with its text and the columns at fault. Empty cells are null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: Narrowest first; what none holds stays text.
KINDS: list[tuple[str, T.DataType]] = [("boolean", T.BooleanType()), ("bigint", T.LongType()), ("double", T.DoubleType()),
                                       ("timestamp_ntz", T.TimestampNTZType())]


@dataclass
class CsvScan:
    """``schema`` as inferred; ``rows`` that fit it; ``quarantine`` (record, bad_columns) that do not."""

    schema: T.StructType
    rows: DataFrame
    quarantine: DataFrame


def _filled(name: str) -> Column:
    cell = F.trim(F.col(f"`{name}`"))
    return F.when(cell != "", cell)


def _as(cell: Column, kind: str) -> Column:
    """The cell as ``kind``, null where it is none: words for booleans, digits alone for numbers, dates with a time."""
    if kind == "boolean":
        return F.when(F.lower(cell).isin("true", "false"), F.lower(cell) == "true")
    if kind == "bigint":
        return F.when(cell.rlike(r"^[+-]?\d+$"), cell.try_cast("bigint"))
    if kind == "double":
        return F.when(cell.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), cell.try_cast("double"))
    if kind == "timestamp_ntz":
        return F.when(cell.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d"), cell.try_cast("timestamp_ntz"))
    return cell


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """Every cell as text. The header is read from the files' own first line, all files alike."""
    names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    kinds = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return (spark.read.schema(kinds).option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
            .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False).csv(path))


def infer_types(texts: DataFrame, tolerance: float = 0.0) -> T.StructType:
    """The narrowest type of each column over all rows, of which a share of ``tolerance`` filled cells may not fit.

    A column without filled cells is text. One aggregate over all columns, whatever their number; rows of the wrong length do not count.
    """
    names = [c for c in texts.columns if c != CORRUPT]
    whole = texts.where(F.col(CORRUPT).isNull()) if CORRUPT in texts.columns else texts
    aggs = [F.count(_filled(n)).alias(f"n{k}") for k, n in enumerate(names)]
    aggs += [F.count(_as(_filled(n), kind)).alias(f"n{k}_{kind}") for k, n in enumerate(names) for kind, _ in KINDS]
    got = whole.agg(*aggs).first()
    fields = []
    for k, n in enumerate(names):
        need = got[f"n{k}"] - int(tolerance * got[f"n{k}"])
        fits = [t for kind, t in KINDS if got[f"n{k}"] and got[f"n{k}_{kind}"] >= max(need, 1)]
        fields.append(T.StructField(n, fits[0] if fits else T.StringType()))
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, tolerance: float = 0.0) -> CsvScan:
    texts = _texts(spark, path)
    schema = infer_types(texts, tolerance)
    cells = {f.name: _as(_filled(f.name), f.dataType.simpleString()) for f in schema.fields}
    wrong = [F.when(_filled(n).isNotNull() & c.isNull(), F.lit(n)) for n, c in cells.items()]
    judged = texts.select("*", F.array_compact(F.array(
        F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT)), *[F.when(F.col(CORRUPT).isNull(), w) for w in wrong])).alias("_bad"))
    record = F.coalesce(CORRUPT, F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields])))
    return CsvScan(schema, judged.where(F.size("_bad") == 0).select(*[c.alias(n) for n, c in cells.items()]),
                   judged.where(F.size("_bad") > 0).select(record.alias("record"), F.concat_ws(",", "_bad").alias("bad_columns")))
