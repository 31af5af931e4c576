"""Data-quality checks, in long form: one row per (dataset, check, column).

Every check is a distributed aggregate over the whole dataset; only per-column result rows (a table
bounded by the number of columns) are ever small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.ranking import global_cumsum

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_FLOATS = (T.FloatType, T.DoubleType)
OUTLIER_IQR_FACTOR = 3.0
RANGE_COLUMN, RANGE_LO, RANGE_HI = "sentiment_score", -1.0, 1.0


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric data columns; booleans are not numeric here."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and not f.name.startswith("_")]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, column_name, null_count) for columns with at least one null (NaN counts as null)."""
    parts = []
    for name, df in datasets.items():
        types = {f.name: f.dataType for f in df.schema.fields}
        cols = data_columns(df)
        aggs = []
        for c in cols:
            miss = F.col(c).isNull()
            if isinstance(types[c], _FLOATS):
                miss = miss | F.isnan(F.col(c))
            aggs.append(F.count_if(miss).alias(c))
        wide = df.agg(*aggs)
        long = wide.unpivot([], cols, "column_name", "null_count")
        parts.append(long.select(F.lit(name).alias("dataset"), "column_name",
                                 F.col("null_count").cast("bigint").alias("null_count")))
    return _union(parts).where(F.col("null_count") > 0)


def duplicate_rows(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, duplicate_rows): full-row copies beyond the first (nulls equal nulls).

    Grouping by every column is a partial + final aggregate, so a row repeated a billion times costs one
    buffer per task, not a billion shuffled rows.
    """
    parts = []
    for name, df in datasets.items():
        g = df.groupBy(*data_columns(df)).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))
                      .select(F.lit(name).alias("dataset"), "duplicate_rows"))
    return _union(parts)


DATASETS_AT_ONCE = 8
APPROX_ACCURACY = 10_000    # sketch accuracy: rank error at most N / accuracy


def _valid(col: str) -> Column:
    """The column as a double; NaN counts as missing."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def _one_row(df: DataFrame, aggs: list[Column]) -> list:
    """One wide aggregate of a dataset: a single row with a value per column."""
    return list(df.agg(*aggs).first())


def quartile_rows(datasets: Mapping[str, DataFrame], probs=(0.25, 0.75),
                  accuracy: int = APPROX_ACCURACY) -> list[tuple]:
    """Exact linear-interpolated quantiles: (dataset, column, quantiles, n) of every numeric column with values.

    Wide passes over each dataset, all columns at once: counts; mergeable sketches that bracket the target
    ranks in a band of values; how many values lie below each band; and the band's own values, counted before
    they are exchanged and ordered by a range-partitioned running count. The same passes at every size: with n
    values the band is widened by 2 / n, so in a small column it is simply the whole column.
    What comes back is a few numbers per column.
    """
    def bracket(item: tuple[str, DataFrame]) -> tuple[str, DataFrame, list[tuple[str, int]], list[tuple], list[int]]:
        """A dataset's columns with their counts, the bands (column, quantile, from, to), and the values below each band."""
        name, df = item
        cols = numeric_columns(df)
        sized = [(c, n) for c, n in zip(cols, _one_row(df, [F.count(_valid(c)) for c in cols])) if n] if cols else []
        if not sized:
            return name, df, [], [], []
        sketches = _one_row(df, [F.percentile_approx(_valid(c), [
            f for p in probs for f in (max(0.0, p - 3.0 / accuracy - 2.0 / n), min(1.0, p + 3.0 / accuracy + 2.0 / n))],
            accuracy) for c, n in sized])
        own = [(c, b, sketches[k][2 * b], sketches[k][2 * b + 1]) for k, (c, _) in enumerate(sized) for b in range(len(probs))]
        return name, df, sized, own, _one_row(df, [F.count_if(_valid(c) < F.lit(lo)) for c, _, lo, _ in own])

    columns: list[tuple[str, str, int]] = []          # dataset, column, values
    bands: list[tuple[int, int, int]] = []            # column, quantile, values below the band
    parts = []
    with ThreadPoolExecutor(max(1, min(len(datasets), DATASETS_AT_ONCE))) as pool:  # the driver waits; the passes share the cores
        bracketed = list(pool.map(bracket, datasets.items()))
    for name, df, sized, own, below in bracketed:
        if not sized:
            continue
        place = {c: len(columns) + k for k, (c, _) in enumerate(sized)}
        hits = F.array_compact(F.array(*[
            F.when(_valid(c).between(lo, hi),
                   F.struct(F.lit(place[c]).alias("k"), F.lit(b).alias("b"), _valid(c).alias("value")))
            for c, b, lo, hi in own]))
        parts.append(df.select(F.explode(hits).alias("h")).select("h.*"))
        columns += [(name, c, n) for c, n in sized]
        bands += [(place[c], b, under) for (c, b, _, _), under in zip(own, below)]
    if not columns:
        return []
    counted = _union(parts).groupBy("k", "b", "value").agg(F.count(F.lit(1)).alias("n"))
    along = global_cumsum(counted, ["k", "b", "value"], "n", "cum")
    # Running counts go over all bands; a band starts where the ones before it end.
    ends = {(r["k"], r["b"]): r["cum"] for r in along.groupBy("k", "b").agg(F.max("cum").alias("cum")).collect()}
    start, wanted = 0, []
    for k, b, under in bands:
        h = (columns[k][2] - 1) * probs[b]
        low = int(h)
        for side, pos in ((0, low), (1, min(low + 1, columns[k][2] - 1))):
            wanted.append((k, b, side, h - low, start + pos - under))
        start = ends[k, b]
    spots = parts[0].sparkSession.createDataFrame(wanted, "k int, b int, side int, frac double, spot long")
    found = along.join(F.broadcast(spots), ["k", "b"]).where(
        (F.col("cum") - F.col("n") <= F.col("spot")) & (F.col("spot") < F.col("cum")))
    got = {(r["k"], r["b"], r["side"]): (r["value"], r["frac"])
           for r in found.select("k", "b", "side", "value", "frac").collect()}
    if len(got) != len(wanted):
        raise RuntimeError("a quantile band missed a rank")
    out = []
    for k, (name, c, n) in enumerate(columns):
        ends_of = [(got[k, b, 0], got[k, b, 1][0]) for b in range(len(probs))]
        out.append((name, c, [lo + (hi - lo) * frac for (lo, frac), hi in ends_of], n))
    return out


def quartiles(datasets: Mapping[str, DataFrame], probs=(0.25, 0.75), accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """(dataset, column_name, q1, q3, n), one row per numeric column."""
    spark = next(iter(datasets.values())).sparkSession
    return spark.createDataFrame([(d, c, *q, n) for d, c, q, n in quartile_rows(datasets, probs, accuracy)],
                                 "dataset string, column_name string, q1 double, q3 double, n long")


def outliers(datasets: Mapping[str, DataFrame], factor: float = OUTLIER_IQR_FACTOR) -> DataFrame:
    """(dataset, column_name, outliers): values strictly beyond [Q1 - f*IQR, Q3 + f*IQR]; only > 0 rows.

    One more wide pass per dataset, with each column's bounds in the plan.
    """
    bounds: dict[str, list[tuple[str, float, float]]] = {}
    for name, col, (q1, q3), _ in quartile_rows(datasets):
        bounds.setdefault(name, []).append((col, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)))
    parts = []
    for name, cols in bounds.items():
        wide = datasets[name].agg(*[F.count_if((_valid(c) < F.lit(lo)) | (_valid(c) > F.lit(hi))).alias(c)
                                    for c, lo, hi in cols])
        parts.append(wide.unpivot([], [c for c, _, _ in cols], "column_name", "outliers")
                     .select(F.lit(name).alias("dataset"), "column_name", F.col("outliers").cast("bigint")))
    if not parts:  # no column has a value
        spark = next(iter(datasets.values())).sparkSession
        return spark.createDataFrame([], "dataset string, column_name string, outliers long")
    return _union(parts).where(F.col("outliers") > 0)


def range_violations(datasets: Mapping[str, DataFrame], column: str = RANGE_COLUMN,
                     lo: float = RANGE_LO, hi: float = RANGE_HI) -> DataFrame:
    """(dataset, column_name, violations) for datasets that have ``column``."""
    parts = []
    for name, df in datasets.items():
        if column not in df.columns:
            continue
        v = df.agg(F.count_if((F.col(column) < lo) | (F.col(column) > hi)).cast("bigint").alias("violations"))
        parts.append(v.select(F.lit(name).alias("dataset"), F.lit(column).alias("column_name"), "violations"))
    return _union(parts)


def primary_key_violations(datasets: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """(dataset, key_column, duplicate_keys, extra_rows) for declared single-column keys."""
    parts = []
    for name, k in keys.items():
        g = datasets[name].groupBy(k).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        parts.append(g.agg(F.count(F.lit(1)).cast("bigint").alias("duplicate_keys"),
                           F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("extra_rows"))
                      .select(F.lit(name).alias("dataset"), F.lit(k).alias("key_column"),
                              "duplicate_keys", "extra_rows"))
    return _union(parts)


def orphans(child: DataFrame, parent: DataFrame, key: str, child_id: str) -> DataFrame:
    """Child rows whose key has no parent (anti join; the planner picks broadcast or shuffle at runtime)."""
    return child.select(child_id, key).join(parent.select(key), key, "left_anti")


def issues(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Long-form issue table (dataset, check, column_name, n), only checks that found something."""
    parts = [
        null_counts(datasets).select("dataset", F.lit("nulls").alias("check"), "column_name",
                                     F.col("null_count").alias("n")),
        duplicate_rows(datasets).where(F.col("duplicate_rows") > 0).select(
            "dataset", F.lit("duplicates").alias("check"), F.lit(None).cast("string").alias("column_name"),
            F.col("duplicate_rows").alias("n")),
        outliers(datasets).select("dataset", F.lit("outliers").alias("check"), "column_name",
                                     F.col("outliers").alias("n")),
        range_violations(datasets).where(F.col("violations") > 0).select(
            "dataset", F.lit("sentiment_range_violation").alias("check"), "column_name",
            F.col("violations").alias("n")),
    ]
    return _union(parts)


def issue_summary(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, issue_types): number of distinct check kinds that found something (0 when clean)."""
    found = issues(datasets).groupBy("dataset").agg(F.countDistinct("check").alias("issue_types"))
    spark = next(iter(datasets.values())).sparkSession
    all_ds = spark.createDataFrame([(n,) for n in datasets], "dataset string")
    return all_ds.join(found, "dataset", "left").select(
        "dataset", F.coalesce(F.col("issue_types"), F.lit(0)).cast("bigint").alias("issue_types"))


def report_lines(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Human-readable report as (dataset, line_no, line): a header line per dataset, one line per issue."""
    iss = issues(datasets)
    detail = iss.select(
        "dataset",
        F.concat(F.lit("  WARN  "), F.col("check"),
                 F.when(F.col("column_name").isNotNull(), F.concat(F.lit("."), F.col("column_name"))).otherwise(F.lit("")),
                 F.lit(": "), F.col("n").cast("string")).alias("line"))
    spark = next(iter(datasets.values())).sparkSession
    heads = spark.createDataFrame([(n, f"[{n.upper()}]") for n in datasets], "dataset string, line string")
    clean = heads.join(iss.select("dataset").distinct(), "dataset", "left_anti").select(
        "dataset", F.lit("  OK    No issues found.").alias("line"))
    body = detail.unionByName(clean)
    w = Window.partitionBy("dataset").orderBy("line")
    return heads.withColumn("line_no", F.lit(0)).unionByName(
        body.withColumn("line_no", F.row_number().over(w))).select("dataset", "line_no", "line")
